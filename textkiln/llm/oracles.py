"""DuckDB SQL for the queries that SQL can express, written from their definitions and not from the Spark plans."""

from __future__ import annotations

from textkiln.llm.quality import STOP_WORDS

_W = "[^\\x20\\x09-\\x0D]+"

OP1 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_W}') AS w FROM documents),
l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS win FROM t WHERE len(w) >= 8),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM d, unnest(range(8)) r(j) WHERE n > 1 GROUP BY doc_id),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, greatest(len(w), 1) AS n, greatest(len(lines), 1) AS nl,
 length(text) - length(replace(text, '!', '')) AS bangs, len(list_filter(w, lambda x: lower(x) IN ({', '.join(repr(x) for x in sorted(set(STOP_WORDS)))}))) AS stops,
 len(list_filter(lines, lambda x: ends_with(rtrim(x), '...') OR ends_with(rtrim(x), '…'))) AS dots FROM l LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND word_chars / n >= 2.5 AND word_chars / n <= 12 AND n_symbols / n <= 0.10 AND bangs / n <= 0.30 AND (n_words < 30 OR stops / n >= 0.03) AND n_dup_lines / nl <= 0.50 AND dots / nl <= 0.50 AS kept FROM b
"""

OP2 = f"""
WITH RECURSIVE s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_W}'))::BIGINT AS size, md5('7:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s GROUP BY source),
wt AS (SELECT *, ([5.0, 2.0, 1.0])[(rank - 1) % 3 + 1]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM src),
tot AS (SELECT sum(source_size)::BIGINT AS total, 8 * greatest(512, 8 * count(*)) AS n FROM wt),
fill(step, fixed) AS (SELECT 0, []::BIGINT[] UNION ALL
 SELECT step + 1, list_concat(fixed, o) FROM (SELECT step, fixed, (SELECT list(rank) FROM wt WHERE NOT list_contains(fixed, rank) AND
  ((SELECT total FROM tot) - coalesce((SELECT sum(cap) FROM wt WHERE list_contains(fixed, rank)), 0)) * weight / (SELECT sum(weight) FROM wt WHERE NOT list_contains(fixed, rank)) >= cap) AS o FROM fill) WHERE len(o) > 0),
fx AS (SELECT arg_max(fixed, step) AS fixed FROM fill),
tg AS (SELECT wt.*, CASE WHEN list_contains(fixed, rank) THEN cap ELSE ((SELECT total FROM tot) - coalesce((SELECT sum(cap) FROM wt, fx WHERE list_contains(fixed, rank)), 0)) * weight / (SELECT sum(weight) FROM wt, fx WHERE NOT list_contains(fixed, rank)) END AS target FROM wt, fx),
seat AS (SELECT rank, row_number() OVER (ORDER BY target / (2 * j - 1) DESC, rank) AS p FROM tg, tot, unnest(range(1, ceil(target * tot.n / (SELECT sum(target) FROM tg))::BIGINT + 3)) u(j) WHERE target > 0),
q AS (SELECT tg.*, least(coalesce(c, 0) * total // n, 3 * source_size) AS want, greatest(1, (total + n - 1) // n) AS block FROM tg LEFT JOIN (SELECT rank, count(*) AS c FROM seat WHERE p <= (SELECT n FROM tot) GROUP BY rank) USING (rank), tot),
q2 AS (SELECT *, CASE WHEN source_size > 0 THEN want // source_size ELSE 0 END AS passes, CASE WHEN source_size > 0 THEN want % source_size ELSE 0 END AS rest FROM q),
blk AS (SELECT rank, rest, b, least(block, source_size - b * block) AS len, md5('7:' || rank || ':' || b) AS key FROM q2, unnest(range(0, source_size // block + 1)) u(b) WHERE source_size > 0),
pick AS (SELECT rank, b, greatest(0, least(len, rest - coalesce(sum(len) OVER (PARTITION BY rank ORDER BY key, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS take FROM blk),
cum AS (SELECT rank, b, take, coalesce(sum(take) OVER (PARTITION BY rank ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pick),
tape AS (SELECT s.*, q2.rank, q2.block, q2.passes, q2.source_size, q2.target, coalesce(sum(size) OVER (PARTITION BY q2.rank ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo FROM s JOIN q2 ON s.source IS NOT DISTINCT FROM q2.source)
SELECT doc_id, size, t.source_size, target, (passes * size + coalesce(h.before + least((lo + size) % block, h.take), 0) - coalesce(l.before + least(lo % block, l.take), 0))::BIGINT AS taken
FROM tape t LEFT JOIN cum l ON l.rank = t.rank AND l.b = lo // block LEFT JOIN cum h ON h.rank = t.rank AND h.b = (lo + size) // block
"""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{_UP}', '{_LOW}') AS key FROM l),
m AS (SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""

OP6 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, b.r AS br, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.q) = len(b.q))
SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br)::INT AS rank FROM s) WHERE rank <= 5
"""

#: CRC-32 byte by byte, with its table made by eight steps for each of 256 values.
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(x)), '..'), lambda h: ('0x' || h)::BIGINT)), lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1])), 4294967295::BIGINT)"
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"

OP9 = f"""
WITH RECURSIVE steps(i, k, c) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT i, k + 1, {_CRC_STEP} FROM steps WHERE k < 8), crc AS (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS x, (strlen(coalesce(text, '')) + 1)::BIGINT AS size, sha256(coalesce(text, '')) AS digest FROM documents),
o AS (SELECT *, (sum(size) OVER (ORDER BY digest, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS lo, row_number() OVER (ORDER BY digest, doc_id NULLS FIRST) AS n FROM d),
g AS (SELECT *, min(lo) OVER (PARTITION BY digest) AS glo, max(lo + size) OVER (PARTITION BY digest) AS ghi FROM o), t AS (SELECT sum(size)::BIGINT AS total FROM d),
s AS (SELECT total * j // 8 AS x, CASE WHEN ghi - glo <= floor(0.05 * total / 8) THEN glo ELSE lo END AS a, CASE WHEN ghi - glo <= floor(0.05 * total / 8) THEN ghi ELSE lo + size END AS b FROM t, range(1, 8) r(j), g WHERE lo <= total * j // 8 AND total * j // 8 < lo + size),
c AS (SELECT list(CASE WHEN x - a <= b - x THEN a ELSE b END) AS cuts FROM s), h AS (SELECT *, len(list_filter(cuts, lambda v: v <= lo))::INT AS shard FROM o, c)
SELECT doc_id, size, {_CRC} AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY n) - 1 AS slot, NULL::INT AS grown_shard FROM h, crc
"""


def op10(lures: list[str], places: list[str], tops: list[str]) -> str:
    """``lures-places.example.tops``: the listed hosts."""
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    rules = [("www.example.com", "/en/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("com", "/", "allow")]
    return f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host, regexp_extract(substring(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
listed AS (SELECT a || '-' || b || '.example.' || c AS name FROM unnest({lures}) t(a), unnest({places}) u(b), unnest({tops}) v(c)),
bad AS (SELECT DISTINCT host FROM h WHERE EXISTS (SELECT 1 FROM listed WHERE host = name OR ends_with(host, '.' || name)))
SELECT page_id, host, path, CASE {' '.join(f"WHEN {fits(x, p)} THEN '{x}{p}'" for x, p, _ in rules)} END AS rule,
 CASE {' '.join(f"WHEN {fits(x, p)} THEN '{v}'" for x, p, v in rules)} WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict FROM h
"""

OP11 = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{_UP}', '{_LOW}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
f1 AS (SELECT lang, x, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
f2 AS (SELECT lang, g[1] AS x, g[2] AS y, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) AS g FROM w) GROUP BY ALL HAVING f >= 10),
f3 AS (SELECT lang, g[1] AS x, g[2] AS y, g[3] AS z, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS g FROM w) GROUP BY ALL HAVING f >= 10),
c2 AS (SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, u.f AS l, v.f AS r FROM f2 JOIN f1 u ON u.lang = f2.lang AND u.x = f2.x JOIN f1 v ON v.lang = f2.lang AND v.x = f2.y
 WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f AND f3.x = f2.x AND f3.y = f2.y) AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f AND f3.y = f2.x AND f3.z = f2.y)),
k3 AS (SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z AS phrase, f3.f AS a, u.f AS l1, q.f AS r1, o.f AS l2, v.f AS r2, (1000000 * f3.f * f3.f) // (u.f * q.f) AS s1, (1000000 * f3.f * f3.f) // (o.f * v.f) AS s2 FROM f3
 JOIN f1 u ON u.lang = f3.lang AND u.x = f3.x JOIN f1 v ON v.lang = f3.lang AND v.x = f3.z JOIN f2 o ON o.lang = f3.lang AND o.x = f3.x AND o.y = f3.y JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z),
c AS (SELECT lang, phrase, a, l, r, (1000000 * a * a) // (l * r) AS score FROM c2 UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM k3),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM o JOIN total USING (lang) WHERE rank <= 2000
"""

_NAMES = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

OP12 = f"""
WITH b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '{_NAMES}') AS w FROM benchmark WHERE text IS NOT NULL),
ph AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS p FROM (SELECT item, w, least(10, len(w)) AS l FROM b WHERE len(w) > 0) x, unnest(range(1, len(w) - l + 2)) t(i)),
ls AS (SELECT DISTINCT l FROM ph),
d AS (SELECT row_number() OVER () AS r, doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '{_NAMES}') END AS w FROM documents),
g AS (SELECT r, i, l, array_to_string(w[i:i + l - 1], ' ') AS p FROM (SELECT r, w, l FROM d JOIN ls ON len(w) >= l) x, unnest(range(1, len(w) - l + 2)) t(i)),
o AS (SELECT r, i, l, item FROM g JOIN ph USING (l, p)),
h AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, l FROM o) x, unnest(range(l)) t(k) GROUP BY r),
m AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM o GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN m USING (r)
"""
