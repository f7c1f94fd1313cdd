"""Queries over document texts: hashes, counts, repetition, relevance, retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textkiln.functions import text as X
from textkiln.operators import quality, repetition, retrieval
from textkiln.session import settled
from textkiln.sources.tables import table


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def body_hashes(spark, sf):
    return _docs(spark, sf).select("doc_id", X.body_hash(F.col("text")).alias("sha256"))


_NORMAL = X.normalize_body_sql("text")


def token_counts(spark, sf):
    t = X.tokens(F.col("text"))
    return _docs(spark, sf).select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


def estimated_tokens(spark, sf):
    return _docs(spark, sf).select("doc_id", X.estimated_tokens(F.col("text")).alias("estimated"))


def boilerplate_blocks(spark, sf):
    """Blocks between blank lines; in these tables mostly whole texts."""
    return repetition.boilerplate(_docs(spark, sf))


def boilerplate_lines(spark, sf):
    return repetition.boilerplate(_docs(spark, sf), separator="\n")


def block_repetition(spark, sf):
    """Structural blocks of documents as Markdown that three documents or more hold."""
    return repetition.block_repetition(_markdown(_docs(spark, sf)), "doc_id", "body")


def exact_repetition(spark, sf):
    return repetition.exact_repetition(_docs(spark, sf))


def near_repetition(spark, sf):
    """Case is folded away in half of the documents first, so that several forms exist."""
    docs = _docs(spark, sf).withColumn("text", F.when(F.col("source") < "src5", F.lower("text")).otherwise(F.col("text")))
    return repetition.near_repetition(docs)


def canonical_candidates(spark, sf):
    return repetition.canonical_candidates(_docs(spark, sf).withColumn("key", F.sha2(F.lower("text"), 256)), "key")


def per_source_totals(spark, sf):
    return _docs(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(X.estimated_tokens(F.col("text"))).alias("estimated_tokens"))


def token_recall(spark, sf):
    """Each turn of a conversation against the turn before it."""
    turns = table(spark, sf, "conversations")
    pairs = turns.withColumn("earlier", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("earlier is not null")
    return quality.token_recall(pairs, ["conv_id", "turn"], "text", "earlier").select("conv_id", "turn", "common", "total", "recall")


def metadata_relevance(spark, sf):
    """First line as title, second as description."""
    line = lambda n: F.get(F.split("text", "\n"), F.lit(n))
    return _docs(spark, sf).select("doc_id", *[c.alias(k) for k, c in quality.metadata_relevance(line(0), line(1), F.col("text")).items()])


def _markdown(docs: DataFrame) -> DataFrame:
    """``doc_id, body, text``: texts as Markdown; the first line is the heading, the length of others says what they become."""
    def line(x, i):
        n = F.length(x)
        return (
            F.when(i == 0, F.concat(F.lit("# "), x)).when(n % 13 == 0, F.lit("- [Learn more](https://h/x).")).when(n < 60, F.concat(F.lit("- "), x)).when(n < 120, F.concat(F.lit("> "), x))
            .when(n % 5 == 0, F.concat(F.lit("![f](img/"), n, F.lit(".png) "), x)).when(n % 7 == 0, F.concat(F.lit("[l](https://h/"), n, F.lit(") "), x)).when(n % 11 == 0, F.concat(F.lit("| "), n, F.lit(" | "), x)).otherwise(x))

    return docs.select("doc_id", F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line), "\n").alias("body"), "text")


def structure_counts(spark, sf):
    return quality.page_structure(_markdown(_docs(spark, sf)), "doc_id", "body")


def page_comparison(spark, sf):
    """Each document, as Markdown, against the one before it with the same first line."""
    earlier = F.lag("body").over(Window.partitionBy(F.split_part("text", F.lit("\n"), F.lit(1))).orderBy("doc_id"))
    pairs = _markdown(_docs(spark, sf)).withColumn("reference", earlier).select("doc_id", "body", "reference")
    return quality.compared_pages(settled(pairs), ["doc_id"], "body", "reference")


def quality_summary(spark, sf):
    return quality.quality_summary(page_comparison(spark, sf))


def _questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), "text")


def retrieval_topk(spark, sf):
    docs, asked = _docs(spark, sf), retrieval.asked_words(_questions(spark, sf))
    return retrieval.best(settled(retrieval.term_counts(docs, asked)), docs.count(), asked)


def retrieval_evaluation(spark, sf):
    """Before: English documents only; after: all. Wanted: what the question finds first among all. Both runs read one table of counts."""
    docs, asked = _docs(spark, sf), retrieval.asked_words(_questions(spark, sf))
    tf = settled(retrieval.term_counts(docs, asked, "lang"))
    n = docs.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("lang") == "en").alias("en")).first()
    after = settled(retrieval.best(tf, n["all"], asked))
    before = retrieval.best(tf.where("lang = 'en'"), n["en"], asked)
    wanted = after.where("rank = 1").select("question_id", "doc_id")
    return retrieval.evaluate(before, after, wanted)


def anchor_slugs(spark, sf):
    """Lines as headings: the second of a slug in a document ends in -1, and so on."""
    lines = repetition.pieces(_docs(spark, sf)).where(F.trim("piece") != "").select("doc_id", "line", X.heading_slug(F.col("piece")).alias("slug"))
    n = F.row_number().over(Window.partitionBy("doc_id", "slug").orderBy("line")) - 1
    return lines.select("doc_id", "line", F.when(n == 0, F.col("slug")).otherwise(F.concat("slug", F.lit("-"), n)).alias("anchor"))


def address_occurrences(spark, sf):
    lines = repetition.pieces(_docs(spark, sf)).select("doc_id", "line", F.substring(F.sha2("piece", 256), 1, 12).alias("address"))
    n = F.row_number().over(Window.partitionBy("doc_id", "address").orderBy("line"))
    return lines.select("doc_id", "line", F.when(n == 1, F.col("address")).otherwise(F.concat("address", F.lit(":occurrence:"), n)).alias("address"))


def line_offsets(spark, sf):
    """Character offset of every line: a running sum inside the row, so no shuffle."""
    lens = F.transform(F.split("text", "\n"), lambda x: F.length(x) + 1)
    offsets = F.aggregate(lens, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    return _docs(spark, sf).select("doc_id", F.slice(offsets, F.lit(1), F.size(lens)).alias("offsets")).select("doc_id", F.posexplode("offsets").alias("line", "offset"))


def multiset_diff(spark, sf):
    """Technical tokens (with a digit) of each conversation's first turn that its last turn lacks, with multiplicity."""
    turns = table(spark, sf, "conversations")
    ends = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("a"), F.max_by("text", "turn").alias("b"))
    words = lambda c: ends.select("conv_id", F.explode(F.split(c, r"\s+")).alias("token")).where("token != ''")
    return words("a").exceptAll(words("b")).groupBy("conv_id", "token").agg(F.count(F.lit(1)).alias("missing"))


QUERIES = {f.__name__: f for f in (
    body_hashes, token_counts, estimated_tokens, boilerplate_blocks, boilerplate_lines, block_repetition, exact_repetition, near_repetition, canonical_candidates, per_source_totals, token_recall,
    metadata_relevance, structure_counts, page_comparison, quality_summary, retrieval_topk, retrieval_evaluation, anchor_slugs, address_occurrences, line_offsets, multiset_diff)}

_LINES = "SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS piece, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM documents"
_T = X.tokens_sql
_FLAT = X.folded_sql("trim(regexp_replace(piece, '\\s+', ' ', 'g'))")
_SIGNIFICANT = f"list_distinct(list_filter({_T('text')}, lambda t: length(t) >= 5 AND t NOT IN ({', '.join(repr(x) for x in quality.COMMON)})))"
_RECALL_SQL = f"""WITH p AS (SELECT * FROM (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS earlier FROM conversations) WHERE earlier IS NOT NULL),
w AS (SELECT conv_id, turn, token, count(*) AS want FROM (SELECT conv_id, turn, unnest({_T('earlier')}) AS token FROM p) GROUP BY ALL),
h AS (SELECT conv_id, turn, token, count(*) AS have FROM (SELECT conv_id, turn, unnest({_T('text')}) AS token FROM p) GROUP BY ALL),
m AS (SELECT conv_id, turn, sum(least(want, coalesce(have, 0)))::BIGINT AS common, sum(want)::BIGINT AS total FROM w LEFT JOIN h USING (conv_id, turn, token) GROUP BY ALL)
SELECT conv_id, turn, coalesce(common, 0) AS common, coalesce(total, 0) AS total, CASE WHEN coalesce(total, 0) = 0 THEN 1.0::DOUBLE ELSE round(common / total, 6) END AS recall FROM p LEFT JOIN m USING (conv_id, turn)"""


_BODY = """array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: CASE WHEN i = 1 THEN '# ' || x WHEN length(x) % 13 = 0 THEN '- [Learn more](https://h/x).' WHEN length(x) < 60 THEN '- ' || x
 WHEN length(x) < 120 THEN '> ' || x WHEN length(x) % 5 = 0 THEN '![f](img/' || length(x) || '.png) ' || x WHEN length(x) % 7 = 0 THEN '[l](https://h/' || length(x) || ') ' || x WHEN length(x) % 11 = 0 THEN '| ' || length(x) || ' | ' || x ELSE x END), chr(10))"""


def _structure_sql(body: str) -> dict[str, str]:
    """Counts of structures, without look-around."""
    count = lambda p: f"len(regexp_extract_all({body}, '{p}'))"
    out = {k: f"(len(list_filter(string_split({body}, chr(10)), lambda x: regexp_matches(x, '{p}'))) // {n})::BIGINT" for k, (p, n) in X.LINE_STRUCTURES.items()}
    image = r"!\[[^\]]*\]\("
    return out | {
        "figures": f"{count(image + '[^)]+' + chr(92) + ')')}::BIGINT", "links": f"{count('(?:^|[^!])' + chr(92) + '[[^' + chr(92) + ']]+' + chr(92) + ']' + chr(92) + '([^)]+' + chr(92) + ')')}::BIGINT",
        "assets": f"({count(image + '[^)]+' + chr(92) + ')')} - {count(image + 'https?://[^)]*' + chr(92) + ')')})::BIGINT"}


def _promotional_sql(body: str) -> str:
    return f"len(list_filter(string_split({body}, chr(10)), lambda x: regexp_matches(x, '{quality.PROMOTIONAL}') OR regexp_matches(x, '{quality.CALL_TO_ACTION}')))::BIGINT"


def _titles_sql(body: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({body}, '(?m)^#{{1,6}}[ ' || chr(9) || ']+([^ ].*?) *$', 1), lambda t: {X.folded_sql('t')}))"


_CHROME_SQL = f"len(list_filter([{', '.join(repr(c.lower()) for c in quality.CHROME)}], lambda c: list_contains(list_transform(string_split(lower(body), chr(10)), lambda x: trim(x)), c)))::BIGINT"
_COMPARED_SQL = f"""(WITH d AS (SELECT doc_id, {_BODY} AS body, split_part(text, chr(10), 1) AS line FROM documents), p AS (SELECT doc_id, body, lag(body) OVER (PARTITION BY line ORDER BY doc_id) AS reference FROM d),
 w AS (SELECT doc_id, token, count(*) AS want FROM (SELECT doc_id, unnest({_T('reference')}) AS token FROM p WHERE reference IS NOT NULL) GROUP BY ALL),
 h AS (SELECT doc_id, token, count(*) AS have FROM (SELECT doc_id, unnest({_T('body')}) AS token FROM p WHERE reference IS NOT NULL) GROUP BY ALL),
 m AS (SELECT doc_id, sum(least(want, coalesce(have, 0))) / sum(want) AS part FROM w LEFT JOIN h USING (doc_id, token) GROUP BY doc_id),
 e AS (SELECT doc_id, reference IS NOT NULL AS compared, {_CHROME_SQL} AS chrome, {_promotional_sql('body')} AS promotional,
  CASE WHEN reference IS NULL THEN 0 ELSE len(list_filter({_titles_sql('reference')}, lambda u: NOT list_contains({_titles_sql('body')}, u))) END::BIGINT AS lost_headings,
  {', '.join(f"coalesce(greatest(0, {_structure_sql('reference')[k]} - {_structure_sql('body')[k]}), 0)::BIGINT AS lost_{k}" for k in _structure_sql('body') if k != 'headings')},
  CASE WHEN reference IS NOT NULL THEN coalesce(round(part, 6), 1.0) END::DOUBLE AS recall FROM p LEFT JOIN m USING (doc_id))
 SELECT *, CASE WHEN NOT compared THEN CASE WHEN chrome > 0 THEN 'regressed' ELSE 'not_compared' END WHEN recall < 0.98 OR chrome > 0 OR lost_headings > 0 OR lost_tables > 0 OR lost_code_blocks > 0 OR lost_callouts > 0 OR lost_figures > 0
  THEN 'regressed' ELSE 'passed' END AS status FROM e)"""


def _scores_sql(docs: str) -> str:
    return f"""(WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_]+') AS w FROM documents WHERE {docs}),
 q AS (SELECT item_id AS question_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9_]+'))) AS word FROM benchmark),
 tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM d) WHERE word IN (SELECT word FROM q) GROUP BY ALL),
 idf AS (SELECT word, ln(1 + (SELECT count(*) FROM d) / (1 + count(*))) AS idf FROM tf GROUP BY word)
 SELECT question_id, rank, doc_id FROM (SELECT question_id, doc_id, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM (
  SELECT question_id, doc_id, sum(round(idf * least(tf, 5) * 1e9)::BIGINT) AS score FROM q JOIN idf USING (word) JOIN tf USING (word) GROUP BY ALL)) WHERE rank <= 5)"""


ORACLE_SQL = {
    "body_hashes": f"SELECT doc_id, sha256({_NORMAL}) AS sha256 FROM documents",
    "token_counts": f"SELECT doc_id, len({_T('text')}) AS n_tokens, len(list_distinct({_T('text')})) AS n_distinct FROM documents",
    "estimated_tokens": "SELECT doc_id, ((length(text) + 3) // 4)::BIGINT AS estimated FROM documents",
    **{f"boilerplate_{name}": f"""SELECT block, count(*) AS n_docs, min(doc_id) AS first_doc FROM (SELECT DISTINCT doc_id, array_to_string(t, ' ') AS block
 FROM (SELECT doc_id, {_T('piece')} AS t FROM ({pieces}) WHERE NOT regexp_matches(piece, '^[ \\n\\t\\x0b\\f\\r]*#')) WHERE len(t) >= 8) GROUP BY block HAVING count(*) >= 3"""
       for name, pieces in (("lines", _LINES), ("blocks", f"SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '{X.BLANK_LINE.replace(chr(10), chr(92) + 'n')}')) AS piece FROM documents"))},
    "exact_repetition": f"SELECT sha256(piece) AS sha256, count(*) AS occurrences, count(DISTINCT doc_id) AS n_docs, min(doc_id) AS first_doc FROM ({_LINES}) WHERE trim(piece) <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3",
    "near_repetition": f"""SELECT sha256(flat) AS normalized_sha256, count(*) AS occurrences, count(DISTINCT doc_id) AS n_docs, count(DISTINCT piece) AS n_forms FROM (
 SELECT doc_id, piece, {_FLAT} AS flat FROM (
 SELECT doc_id, unnest(string_split(CASE WHEN source < 'src5' THEN lower(text) ELSE text END, chr(10))) AS piece FROM documents))
 WHERE length(flat) >= 80 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2 AND count(DISTINCT piece) > 1""",
    "canonical_candidates": f"SELECT sha256(lower(text)) AS key, count(*) AS documents, min(doc_id) AS first_doc, count(DISTINCT {_NORMAL}) = 1 AS substantive_match FROM documents GROUP BY 1 HAVING count(*) > 1",
    "per_source_totals": "SELECT source, count(*) AS documents, sum((length(text) + 3) // 4)::BIGINT AS estimated_tokens FROM documents GROUP BY source",
    "token_recall": _RECALL_SQL,
    "metadata_relevance": f"""SELECT doc_id, th AS title_hits, tn AS title_tokens, CASE WHEN has THEN dh END AS description_hits, CASE WHEN has THEN dn END AS description_tokens,
 tn > 0 AND th < 0.5 * tn AS weak_title, has AND dh < 0.3 * greatest(dn, 1) AS weak_description FROM (
 SELECT doc_id, len(list_intersect(t, s)) AS th, len(t) AS tn, len(list_intersect(d, s)) AS dh, len(d) AS dn, has FROM (
 SELECT doc_id, list_distinct({_T("split_part(text, chr(10), 1)")}) AS t, list_distinct({_T("split_part(text, chr(10), 2)")}) AS d, split_part(text, chr(10), 2) <> '' AS has, {_SIGNIFICANT} AS s FROM documents))""",
    "structure_counts": f"SELECT doc_id, {', '.join(f'{e} AS {k}' for k, e in _structure_sql('body').items())}, {_promotional_sql('body')} AS promotional FROM (SELECT doc_id, {_BODY} AS body FROM documents)",
    "page_comparison": f"SELECT * FROM {_COMPARED_SQL}",
    "quality_summary": f"""SELECT page_count, compared_pages, greatest(0, compared_pages - regressed_pages) AS passed_pages, regressed_pages, chrome_fragments, promotional_fragments,
 CASE WHEN regressed_pages > 0 THEN 'regressed' WHEN compared_pages > 0 THEN 'passed' ELSE 'not_compared' END AS quality_status FROM (SELECT count(*) AS page_count, count(*) FILTER (compared) AS compared_pages,
 count(*) FILTER (status = 'regressed') AS regressed_pages, sum(chrome)::BIGINT AS chrome_fragments, sum(promotional)::BIGINT AS promotional_fragments FROM {_COMPARED_SQL})""",
    "retrieval_topk": f"SELECT * FROM {_scores_sql('true')}",
    "retrieval_evaluation": f"""WITH a AS {_scores_sql('true')}, b AS {_scores_sql("lang = 'en'")}
 SELECT w.question_id, b.rank AS baseline_rank, w.rank AS enriched_rank, CASE WHEN b.rank IS NULL THEN 'gained' ELSE 'kept' END AS verdict
 FROM a w LEFT JOIN b ON b.question_id = w.question_id AND b.doc_id = w.doc_id WHERE w.rank = 1""",
    "anchor_slugs": f"""SELECT doc_id, line, CASE WHEN n = 0 THEN slug ELSE slug || '-' || n END AS anchor FROM (SELECT doc_id, line, slug, row_number() OVER (PARTITION BY doc_id, slug ORDER BY line) - 1 AS n FROM (
 SELECT doc_id, line, replace(regexp_replace(lower(piece), '[^\\p{{L}}\\p{{N}}_\\- ]', '', 'g'), ' ', '-') AS slug FROM ({_LINES}) WHERE trim(piece) <> ''))""",
    "address_occurrences": f"""SELECT doc_id, line, CASE WHEN n = 1 THEN a ELSE a || ':occurrence:' || n END AS address FROM (SELECT doc_id, line, a, row_number() OVER (PARTITION BY doc_id, a ORDER BY line) AS n FROM (
 SELECT doc_id, line, substring(sha256(piece), 1, 12) AS a FROM ({_LINES})))""",
    "line_offsets": f"SELECT doc_id, line::INT AS line, coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS offset FROM ({_LINES})",
    "multiset_diff": """WITH e AS (SELECT conv_id, arg_min(text, turn) AS a, arg_max(text, turn) AS b FROM conversations GROUP BY conv_id)
 SELECT conv_id, token, count(*) AS missing FROM (SELECT conv_id, unnest(list_filter(regexp_split_to_array(a, '\\s+'), lambda x: x <> '')) AS token FROM e
 EXCEPT ALL SELECT conv_id, unnest(list_filter(regexp_split_to_array(b, '\\s+'), lambda x: x <> '')) FROM e) GROUP BY ALL""",
}
