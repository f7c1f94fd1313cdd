"""Queries over relations between documents: links, aliases, catalogs, packing, spans, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions.text import sorted_tags
from textkiln.operators import graph as G
from textkiln.operators import resolution as R
from textkiln.sources.tables import table


def link_closure(spark, sf):
    """Parts as pages: a part depends on the part with half its key; one brand is excluded, one size is repaired."""
    p = table(spark, sf, "part")
    links = p.where("p_partkey > 1").select(F.col("p_partkey").alias("src"), F.expr("p_partkey div 2").alias("dst"))
    return G.closure_omitted(links, p.where("p_brand = 'Brand#23' and p_partkey > 20").select(F.col("p_partkey").alias("node")), p.where("p_size < 10").select(F.col("p_partkey").alias("node")))


_CLOSURE_SQL = """WITH RECURSIVE r(node, depth) AS (SELECT p_partkey, 0 FROM part WHERE p_brand = 'Brand#23' AND p_partkey > 20
 UNION SELECT p.p_partkey, r.depth + 1 FROM r JOIN part p ON p.p_partkey // 2 = r.node AND p.p_partkey > 1 WHERE p.p_size >= 10 OR p.p_size IS NULL)
SELECT node, min(depth)::INT AS depth FROM r GROUP BY node"""


def alias_resolution(spark, sf):
    """Orders as paths: an odd key points to half of it; a few more form a cycle, have two targets, or lead there."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    chain = o.where("k > 3 and k % 2 = 1").select(F.concat(F.lit("p"), "k").alias("path"), F.concat(F.lit("p"), F.expr("k div 2")).alias("target"))
    loop = spark.createDataFrame([("x1", "x2"), ("x2", "x3"), ("x3", "x1"), ("y", "x1"), ("z", "p3"), ("z", "p1"), ("zz", "z")], "path string, target string")
    return G.resolve_aliases(chain.unionByName(loop))


_ALIAS_SQL = """WITH RECURSIVE a AS (SELECT 'p' || o_orderkey AS path, 'p' || (o_orderkey // 2) AS target FROM orders WHERE o_orderkey > 3 AND o_orderkey % 2 = 1),
r(path, target, hops) AS (SELECT path, target, 1 FROM a UNION ALL SELECT r.path, a.target, hops + 1 FROM r JOIN a ON a.path = r.target)
SELECT path, arg_max(target, hops) AS target, max(hops)::BIGINT AS hops, false AS cycle, NULL::VARCHAR AS error FROM r GROUP BY path
UNION ALL SELECT path, NULL, NULL, error = 'cycle', error FROM (VALUES ('x1', 'cycle'), ('x2', 'cycle'), ('x3', 'cycle'), ('y', 'cycle'), ('z', 'several targets'), ('zz', 'leads to several targets')) v(path, error)"""


def link_discovery(spark, sf):
    """Pages and routes by steps from every fiftieth page: along the links of a page, and from a route to the pages whose heading begins with its word."""
    p = table(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("page"), "html", "page_id")
    out = p.select(F.col("page").alias("src"), F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("dst"))
    back = p.select(F.concat(F.lit("/"), F.regexp_extract("html", "<h1>([^ <]+)", 1)).alias("src"), F.col("page").alias("dst"))
    return G.reachable(out.unionByName(back), p.where("page_id % 50 = 0").select(F.col("page").alias("node")))


_DISCOVERY_SQL = """WITH RECURSIVE e AS (SELECT DISTINCT 'p' || page_id AS src, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS dst FROM pages UNION SELECT '/' || regexp_extract(html, '<h1>([^ <]+)', 1), 'p' || page_id FROM pages),
s(node, depth) AS (SELECT 'p' || page_id, 0 FROM pages WHERE page_id % 50 = 0 UNION SELECT dst, depth + 1 FROM s JOIN e ON src = node WHERE depth < 40) SELECT node, min(depth)::INT AS depth FROM s GROUP BY node"""


def api_resolution(spark, sf):
    """Parts as an API catalog, line items as legacy references."""
    p = table(spark, sf, "part")
    catalog = p.select(
        F.concat(F.lit("op"), F.col("p_partkey") % 500).alias("operation_id"), F.concat(F.lit("res-"), F.col("p_partkey") % 300).alias("resource"), F.col("p_brand").alias("domain"),
        F.concat(F.lit("https://api/"), F.col("p_partkey") % 700).alias("url"), F.concat(F.lit("https://api/o/"), F.col("p_partkey") % 300).alias("overview_url"),
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("https://old/"), F.col("p_partkey"))).alias("legacy_url"))
    l = table(spark, sf, "lineitem")
    refs = l.select(F.col("l_partkey").alias("k"), (F.col("l_suppkey") % 4).alias("m")).distinct().select(
        F.concat_ws("/", F.lit("ref"), "k", "m").alias("ref"), F.concat(F.lit("https://old/"), "k").alias("canonical"),
        F.when(F.col("m") == 0, F.concat(F.lit("op"), F.col("k") + 400)).otherwise(F.lit("")).alias("fragment"),
        F.when(F.col("m") == 1, F.concat(F.lit("RES_"), F.col("k") + 200)).when(F.col("m") == 2, F.concat(F.lit("op"), F.col("k") % 600)).otherwise(F.lit("none")).alias("leaf"))
    over = spark.createDataFrame([("ref/7/0", "https://api/x"), ("https://old/11", "https://api/y")], "legacy_url string, destination string")
    return R.resolve_reference(refs, catalog, over, "https://api/fallback")


_API_SQL = """WITH c AS (SELECT 'op' || (p_partkey % 500) AS op, 'res-' || (p_partkey % 300) AS res, p_brand AS domain, 'https://api/' || (p_partkey % 700) AS url, 'https://api/o/' || (p_partkey % 300) AS over, CASE WHEN p_partkey % 5 = 0 THEN 'https://old/' || p_partkey END AS legacy FROM part),
r AS (SELECT 'ref/' || k || '/' || m AS ref, 'https://old/' || k AS canon, CASE WHEN m = 0 THEN 'op' || (k + 400) ELSE '' END AS frag, CASE WHEN m = 1 THEN 'RES_' || (k + 200) WHEN m = 2 THEN 'op' || (k % 600) ELSE 'none' END AS leaf
 FROM (SELECT DISTINCT l_partkey AS k, l_suppkey % 4 AS m FROM lineitem)),
h AS (SELECT ref, 0 AS p, 'https://api/x' AS t, '' AS i FROM r WHERE ref = 'ref/7/0' UNION ALL SELECT ref, 1, 'https://api/y', '' FROM r WHERE canon = 'https://old/11'
 UNION ALL SELECT ref, 2, url, res || domain FROM r JOIN c ON frag <> '' AND op = frag UNION ALL SELECT ref, 3, url, res || domain FROM r JOIN c ON op = leaf UNION ALL SELECT ref, 4, url, res || domain FROM r JOIN c ON legacy = canon
 UNION ALL SELECT ref, 5, url, res || domain FROM r JOIN c ON frag <> '' AND res || '#' || lower(op) = replace(replace(lower(leaf), '_', '-'), '.', '-') || '#' || lower(frag)
 UNION ALL SELECT ref, 6, over, res || domain FROM r JOIN c ON res = replace(replace(lower(leaf), '_', '-'), '.', '-')),
g AS (SELECT ref, p, count(DISTINCT t) AS n, count(DISTINCT i) AS m, min(t) AS t FROM h GROUP BY ALL), b AS (SELECT ref, arg_min(g, p) AS g FROM g GROUP BY ref)
SELECT ref, CASE WHEN g IS NULL THEN 'https://api/fallback' WHEN g.p <= 1 THEN g.t WHEN g.p = 6 AND g.m = 1 THEN g.t WHEN g.p < 6 AND g.n = 1 THEN g.t ELSE 'https://api/fallback' END AS destination,
 CASE WHEN g IS NULL THEN 'unmatched' WHEN g.p <= 1 THEN 'explicit_override' WHEN g.p = 6 THEN CASE WHEN g.m = 1 THEN 'exact_resource' ELSE 'ambiguous_resource' END WHEN g.n = 1 THEN 'exact_operation' ELSE 'ambiguous_operation' END AS reason
FROM r LEFT JOIN b USING (ref)"""


def strongest_ledgers(spark, sf):
    l = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag", "l_orderkey")
    return R.strongest(l, "l_suppkey", [F.desc("l_quantity"), F.desc("l_returnflag")]).groupBy("l_suppkey").agg(F.max("l_quantity").alias("l_quantity"), F.max("l_returnflag").alias("l_returnflag"), F.bool_or("tied").alias("tied"))


def earliest_observation(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.when(F.col("event_type") != "click", F.col("ts").cast("string")).alias("observed"), "event_id").where("user_id is not null")
    return R.earliest(e, "user_id", "observed").select("user_id", "observed")


def question_documents(spark, sf):
    asked = table(spark, sf, "benchmark").select(F.concat(F.lit("d"), "item_id").alias("path"))
    alias = table(spark, sf, "part").select(F.concat(F.lit("d"), F.expr("p_partkey div 2")).alias("path"), F.concat(F.lit("t"), F.when(F.col("p_partkey") % 6 < 2, F.lit(0)).otherwise(F.col("p_partkey"))).alias("target"))
    return R.cardinality_checked(asked, alias, "path", "target")


def batch_packing(spark, sf):
    """Orders of each customer in batches of at most 500,000 and five orders."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.round("o_totalprice").cast("long").alias("size"))
    return R.pack(o, "o_custkey", "o_orderkey", "size", 500_000, 5)


_PACK_SQL = """WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, round(o_totalprice)::BIGINT AS size, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
r AS (SELECT o_custkey, o_orderkey, size, i, 0::BIGINT AS bin, size AS s, 1 AS n FROM o WHERE i = 1
 UNION ALL SELECT o.o_custkey, o.o_orderkey, o.size, o.i, r.bin + (r.s + o.size > 500000 OR r.n >= 5)::INT, CASE WHEN r.s + o.size > 500000 OR r.n >= 5 THEN o.size ELSE r.s + o.size END, CASE WHEN r.s + o.size > 500000 OR r.n >= 5 THEN 1 ELSE r.n + 1 END
 FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.i = r.i + 1)
SELECT o_custkey, o_orderkey, size, bin FROM r"""


def fact_groups(spark, sf):
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("section"))
    return R.limited_groups(l, "l_orderkey", "section", "l_linenumber", 2)


_FACTS_SQL = """WITH a AS (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS section FROM lineitem GROUP BY ALL), b AS (SELECT *, coalesce(section <> lag(section) OVER w, true)::INT AS nw FROM a WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)),
c AS (SELECT *, sum(nw) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS run FROM b), d AS (SELECT *, ((row_number() OVER (PARTITION BY l_orderkey, run ORDER BY l_linenumber) - 1) % 2 = 0)::INT AS cut FROM c)
SELECT l_orderkey, l_linenumber, section, (sum(cut) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1)::BIGINT AS part FROM d"""


def usage_rollup(spark, sf):
    """Model usage: line items counted once for each (order, part), summed by flag and priced by rate."""
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", F.col("l_quantity").cast("long").alias("q")).groupBy("l_orderkey", "l_partkey").agg(F.min("l_returnflag").alias("model"), F.min("q").alias("tokens"))
    rates = spark.createDataFrame([("A", 3), ("N", 1), ("X", 2)], "model string, rate long")
    return l.groupBy("model").agg(F.count(F.lit(1)).alias("requests"), F.sum("tokens").alias("tokens")).join(F.broadcast(rates), "model", "left").select("model", "requests", "tokens", (F.col("tokens") * F.col("rate")).alias("cost"))


def _edits(spark, sf):
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.max("l_partkey").alias("l_partkey"))
    return l.select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") * 100).cast("long").alias("start"), (F.col("l_linenumber") * 100 + F.col("l_quantity").cast("int")).cast("long").alias("end"), (F.col("l_partkey") % 80).cast("long").alias("new_length"))


def running_offsets(spark, sf):
    return R.running_delta(_edits(spark, sf), "doc")


def projected_ranges(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc"), (F.col("o_custkey") % 400).cast("long").alias("start"), (F.col("o_custkey") % 400 + 60).cast("long").alias("end"))
    changes = _edits(spark, sf).withColumn("end", F.when(F.col("new_length") % 7 == 0, F.col("start")).otherwise(F.col("end")))  # one in seven inserts
    return R.project_range(o, changes, "doc")


_EDITS = "(SELECT l_orderkey AS doc, l_linenumber * 100 AS s, l_linenumber * 100 + max(l_quantity)::INT AS e, max(l_partkey) % 80 AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def interval_containment(spark, sf):
    """Spans inside nested blocks: the smallest block that encloses each."""
    blocks = _edits(spark, sf).select("doc", (F.col("start") - 50 * (F.col("new_length") % 3)).alias("start"), (F.col("end") + 40 * (F.col("new_length") % 5)).alias("end"))
    spans = _edits(spark, sf).where("end - start > 4").select("doc", (F.col("start") + 1).alias("start"), (F.col("start") + 4).alias("end"))
    return R.smallest_enclosing(spans, blocks, "doc")


_CONTAIN_SQL = f"""WITH b AS (SELECT doc, s - 50 * (n % 3) AS bs, e + 40 * (n % 5) AS be FROM {_EDITS}), p AS (SELECT DISTINCT doc, s + 1 AS s, s + 4 AS e FROM {_EDITS} WHERE e - s > 4)
SELECT doc, s AS start, e AS "end", bs AS b_start, be AS b_end FROM (SELECT *, row_number() OVER (PARTITION BY doc, s, e ORDER BY be - bs, bs) AS r FROM p JOIN b USING (doc) WHERE bs <= s AND e <= be) WHERE r = 1"""


def first_turn_only(spark, sf):
    """The first turn of each conversation, with the fields that are kept."""
    c = table(spark, sf, "conversations").where("turn is not null")
    return c.groupBy("conv_id").agg(F.min_by(F.struct("role", "text"), "turn").alias("t")).select("conv_id", "t.role", "t.text")


def document_tags(spark, sf):
    tags = F.array(F.col("lang"), F.concat(F.lit(" "), F.upper("source")), F.lit(""), F.col("source"), F.lower("source"), F.lit("Zeta"), F.lit("alpha"))
    return table(spark, sf, "documents").select("doc_id", sorted_tags(tags).alias("tags"))


def related_last_wins(spark, sf):
    """Of the links to a part in an order the last stays; then they are sorted by part."""
    l = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_partkey") % 10).alias("target"), "l_linenumber", "l_returnflag")
    last = l.groupBy("l_orderkey", "target").agg(F.max_by("l_returnflag", F.struct("l_linenumber", "l_returnflag")).alias("relation"))
    return last.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("target", "relation"))), lambda x: F.concat(x["target"].cast("string"), F.lit("="), x["relation"])), ",").alias("related"))


def listing_differences(spark, sf):
    a = table(spark, sf, "orders").select((F.col("o_custkey") + 50).alias("id"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return R.set_difference_report(a, b, "id")


def corpus_digests(spark, sf):
    return R.corpus_digest(table(spark, sf, "documents").select(F.concat(F.lit("content/"), "doc_id", F.lit("/index.md")).alias("path"), F.sha2("text", 256).alias("sha256")))


def unit_packing(spark, sf):
    """Line items of an order stay together; orders of a customer are packed."""
    l = table(spark, sf, "lineitem").join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").select("o_custkey", "l_orderkey", F.col("l_quantity").cast("long").alias("size"))
    return R.pack_units(l, "o_custkey", "l_orderkey", "size", 200, 3)


_UNITS_SQL = """WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY l_orderkey) AS i FROM (SELECT o_custkey, l_orderkey, sum(l_quantity::BIGINT)::BIGINT AS size FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)),
r AS (SELECT o_custkey, l_orderkey, size, i, 0::BIGINT AS bin, size AS s, 1 AS n FROM o WHERE i = 1
 UNION ALL SELECT o.o_custkey, o.l_orderkey, o.size, o.i, r.bin + (r.s + o.size > 200 OR r.n >= 3)::INT, CASE WHEN r.s + o.size > 200 OR r.n >= 3 THEN o.size ELSE r.s + o.size END, CASE WHEN r.s + o.size > 200 OR r.n >= 3 THEN 1 ELSE r.n + 1 END
 FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.i = r.i + 1)
SELECT o_custkey, l_orderkey, size, bin FROM r"""


def fetch_order(spark, sf):
    """Orders in the order of their fetch: dear ones first, then the urgent, newest first."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.coalesce(F.col("o_totalprice") > 300_000, F.lit(False)).alias("required"), F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False)).alias("tagged"))
    return R.fetch_order(o)


def rerun_difference(spark, sf):
    """A second run that lost one document and doubled another."""
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return R.same_rows(d, d.where("doc_id != 5").unionByName(d.where("doc_id = 7")))


QUERIES = {f.__name__: f for f in (
    link_closure, alias_resolution, link_discovery, api_resolution, strongest_ledgers, earliest_observation, question_documents, batch_packing, fact_groups, usage_rollup,
    running_offsets, projected_ranges, interval_containment, first_turn_only, document_tags, related_last_wins, listing_differences, corpus_digests, unit_packing, fetch_order, rerun_difference)}
ORACLE_SQL = {
    "unit_packing": _UNITS_SQL,
    "fetch_order": "SELECT o_orderkey AS id, row_number() OVER (ORDER BY coalesce(o_totalprice > 300000, false) DESC, coalesce(o_orderpriority = '1-URGENT', false) DESC, o_orderkey DESC) AS place FROM orders",
    "rerun_difference": "SELECT doc_id, sha256(text) AS sha256, CASE WHEN doc_id = 5 THEN 'first' ELSE 'second' END AS side FROM documents WHERE doc_id IN (5, 7)",
    "link_closure": _CLOSURE_SQL,
    "alias_resolution": _ALIAS_SQL,
    "link_discovery": _DISCOVERY_SQL,
    "api_resolution": _API_SQL,
    "strongest_ledgers": """SELECT l_suppkey, max(l_quantity) AS l_quantity, max(l_returnflag) AS l_returnflag, count(*) > 1 AS tied FROM (SELECT DISTINCT * FROM (
 SELECT l_suppkey, l_quantity, l_returnflag, l_orderkey, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_returnflag DESC) AS r FROM lineitem) WHERE r = 1) GROUP BY l_suppkey""",
    "earliest_observation": "SELECT user_id, min(CASE WHEN event_type <> 'click' THEN ts END)::VARCHAR AS observed FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
    "question_documents": """WITH m AS (SELECT 'd' || (p_partkey // 2) AS path, count(DISTINCT t) AS n, min(t) AS t FROM (SELECT p_partkey, 't' || CASE WHEN p_partkey % 6 < 2 THEN 0 ELSE p_partkey END AS t FROM part) GROUP BY 1)
 SELECT path, CASE WHEN coalesce(n, 0) <= 1 THEN coalesce(t, path) END AS resolved, CASE WHEN n > 1 THEN 'ambiguous' END AS error FROM (SELECT 'd' || item_id AS path FROM benchmark) LEFT JOIN m USING (path)""",
    "batch_packing": _PACK_SQL,
    "fact_groups": _FACTS_SQL,
    "usage_rollup": """SELECT model, count(*) AS requests, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * CASE model WHEN 'A' THEN 3 WHEN 'N' THEN 1 END AS cost
 FROM (SELECT min(l_returnflag) AS model, min(l_quantity::BIGINT) AS tokens FROM lineitem GROUP BY l_orderkey, l_partkey) GROUP BY model""",
    "running_offsets": f"""SELECT doc, s AS start, e AS "end", n AS new_length, coalesce(sum(n - (e - s)) OVER (PARTITION BY doc ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS delta FROM {_EDITS}""",
    "projected_ranges": f"""SELECT doc, a AS start, b AS "end", CASE WHEN NOT bad THEN a + da END AS new_start, CASE WHEN NOT bad THEN b + db END AS new_end FROM (
 SELECT o_orderkey AS doc, o_custkey % 400 AS a, o_custkey % 400 + 60 AS b, coalesce(bool_or(s < o_custkey % 400 + 60 AND e > o_custkey % 400 AND NOT (o_custkey % 400 <= s AND s < e AND e <= o_custkey % 400 + 60)), false) AS bad,
 coalesce(sum(n - (e - s)) FILTER (e <= o_custkey % 400), 0)::BIGINT AS da, coalesce(sum(n - (e - s)) FILTER (e <= o_custkey % 400 + 60), 0)::BIGINT AS db
 FROM orders LEFT JOIN (SELECT doc, s, CASE WHEN n % 7 = 0 THEN s ELSE e END AS e, n FROM {_EDITS}) x ON x.doc = o_orderkey GROUP BY o_orderkey, o_custkey)""",
    "interval_containment": _CONTAIN_SQL,
    "first_turn_only": "SELECT conv_id, arg_min(role, turn) AS role, arg_min(text, turn) AS text FROM conversations WHERE turn IS NOT NULL GROUP BY conv_id",
    "document_tags": """SELECT doc_id, list_transform(list_sort(list_transform(list_distinct(list_filter(list_transform([lang, ' ' || upper(source), '', source, lower(source), 'Zeta', 'alpha'], lambda x: trim(x)), lambda x: x <> '')), lambda x: {'k': lower(x), 't': x})), lambda x: x.t) AS tags FROM documents""",
    "related_last_wins": """SELECT l_orderkey, string_agg(target || '=' || relation, ',' ORDER BY target) AS related FROM (SELECT l_orderkey, l_partkey % 10 AS target, arg_max(l_returnflag, l_linenumber || l_returnflag) AS relation FROM lineitem GROUP BY ALL) GROUP BY l_orderkey""",
    "listing_differences": "SELECT DISTINCT o_custkey + 50 AS id, 'missing' AS side FROM orders WHERE o_custkey + 50 NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT DISTINCT c_custkey, 'unexpected' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey + 50 FROM orders)",
    "corpus_digests": """WITH f AS (SELECT 'content/' || doc_id || '/index.md' AS path, sha256(text) AS h FROM documents), b AS (SELECT substring(sha256(path), 1, 4) AS bucket, sha256(string_agg(path || chr(9) || h, chr(10) ORDER BY path)) AS h FROM f GROUP BY 1)
 SELECT sha256(string_agg(bucket || chr(9) || h, chr(10) ORDER BY bucket)) AS digest FROM b""",
}
