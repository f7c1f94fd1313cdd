"""Queries that curate: decisions, metadata, replayed edits, request queues, pooled bodies."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions.text import body_hash
from textkiln.operators import curation as C
from textkiln.sources.tables import table


def _docs(spark, sf):
    return table(spark, sf, "documents").select(F.concat(F.lit("d/"), "doc_id").alias("url"), "doc_id", F.col("text").alias("body"), "source", "lang")


def reviewed_decisions(spark, sf):
    d, k = _docs(spark, sf), F.col("doc_id")
    dec = d.where("doc_id % 3 = 0").select("url", F.when(k % 2 == 0, "remove").when(k % 5 == 0, "omit").otherwise("keep").alias("disposition"), F.when(k % 7 == 0, F.lit("old")).otherwise(body_hash(F.col("body"))).alias("input_sha256"), F.lit("reviewed\n").alias("output"))
    twice = dec.unionByName(dec.where("url like '%9'"))
    return C.apply_decisions(d.select("url", "body"), twice).select("url", "disposition", F.length("body").alias("chars"), "error")


def retired_documents(spark, sf):
    return _docs(spark, sf).where(C.retired(F.col("body"), ("released under the", "all rights reserved"))).select("doc_id")


def metadata_rebuild(spark, sf):
    d = _docs(spark, sf).select("url", F.concat(F.lit("c/"), F.expr("doc_id - (case when doc_id % 10 = 1 then 1 else 0 end)")).alias("canonical_url"), F.col("source").alias("product"), "doc_id")
    aliases = table(spark, sf, "nation").select(F.concat(F.lit("src"), F.col("n_nationkey") % 12).alias("product"), F.initcap("n_name").alias("alias"))
    over = d.where("doc_id % 6 = 0").select("url", F.lit("deprecated").alias("lifecycle"), F.lit("https://example.com/new").alias("replacement_url"))
    links = d.select(F.col("url").alias("source"), F.explode(F.array(*[F.concat(F.lit("c/"), (F.col("doc_id") * m + 1) % 40) for m in (1, 3, 7)])).alias("target"))
    redirects = d.where("doc_id % 10 = 1").select(F.concat(F.lit("c/"), "doc_id").alias("src"), F.concat(F.lit("c/"), F.col("doc_id") + 1).alias("dst"))
    return C.rebuild_metadata(d.drop("doc_id"), aliases, over, links, redirects)


_META_SQL = """WITH d AS (SELECT 'd/' || doc_id AS url, 'c/' || (doc_id - CASE WHEN doc_id % 10 = 1 THEN 1 ELSE 0 END) AS c, source AS product, doc_id AS k FROM documents),
s AS (SELECT c, min(url) AS t FROM d GROUP BY c HAVING count(*) = 1), l AS (SELECT DISTINCT url, 'c/' || ((k * m + 1) % 40) AS target FROM d, (VALUES (1), (3), (7)) v(m)),
h AS (SELECT 'c/' || k AS src, 'c/' || (k + 1) AS dst FROM d WHERE k % 10 = 1),
r AS (SELECT l.url, list_sort(list(DISTINCT coalesce(a.t, b.t))) AS related FROM l LEFT JOIN h ON l.target = h.src LEFT JOIN s a ON a.c = l.target LEFT JOIN s b ON b.c = h.dst WHERE coalesce(a.t, b.t) <> l.url GROUP BY l.url),
al AS (SELECT 'src' || (n_nationkey % 12) AS product, list_transform(list_sort(list(DISTINCT {'k': lower(n_name), 't': upper(n_name[1]) || lower(n_name[2:])})), lambda x: x.t) AS aliases FROM nation GROUP BY 1)
SELECT d.url, d.product, coalesce(aliases, []) AS aliases, CASE WHEN k % 6 = 0 THEN 'deprecated' ELSE 'active' END AS lifecycle, CASE WHEN k % 6 = 0 THEN 'https://example.com/new' END AS replacement_url, coalesce(related, []) AS related
FROM d LEFT JOIN al USING (product) LEFT JOIN r USING (url)"""


def decision_replay(spark, sf):
    d, k = _docs(spark, sf).withColumnRenamed("url", "document"), F.col("doc_id")
    dec = d.where("doc_id % 4 != 3").select(
        "document", F.when(k % 13 == 0, F.lit("0")).otherwise(body_hash(F.col("body"))).alias("input_sha256"), F.when(k % 5 == 0, "alias").when(k % 5 == 1, "exclude").when(k % 5 == 2, "rewrite").otherwise("retain").alias("disposition"),
        F.when(k % 6 != 0, F.lit("new text")).alias("body"), F.concat(F.lit("d/"), F.when(k % 10 == 0, k).otherwise(k + 1)).alias("target"))
    return C.replay(d.select("document", "body"), dec).select("document", "disposition", F.length("body").alias("chars"), "error")


_REPLAY_SQL = """WITH d AS (SELECT 'd/' || doc_id AS document, doc_id AS k, length(text) AS n, (SELECT max(doc_id) FROM documents) AS last FROM documents),
e AS (SELECT *, CASE k % 5 WHEN 0 THEN 'alias' WHEN 1 THEN 'exclude' WHEN 2 THEN 'rewrite' ELSE 'retain' END AS disp, CASE WHEN k % 4 = 3 OR k % 13 = 0 THEN 'no decision' WHEN k % 5 = 2 AND k % 6 = 0 THEN 'empty rewrite'
 WHEN k % 5 = 0 AND (k % 10 = 0 OR k + 1 > last) THEN 'alias without target' END AS error FROM d)
SELECT document, CASE WHEN error IS NULL THEN disp ELSE 'fallback' END AS disposition, CASE WHEN error IS NULL AND disp = 'rewrite' THEN 8 WHEN error IS NULL AND disp IN ('alias', 'exclude') THEN NULL ELSE n END AS chars, error FROM e"""


def request_submission(spark, sf):
    q = table(spark, sf, "customer").select(F.col("c_custkey").alias("request"), F.when(F.col("c_custkey") % 3 == 0, "failed").otherwise("done").alias("status"), (F.col("c_custkey") % 4 + 1).cast("int").alias("attempt"))
    return C.submit(q, table(spark, sf, "orders").select((F.col("o_custkey") + 100).alias("request")))


def result_matching(spark, sf):
    req = table(spark, sf, "customer").select(F.col("c_custkey").alias("request"))
    res = table(spark, sf, "orders").where("o_orderkey % 3 = 0").select((F.col("o_custkey") + 20).alias("request"), F.col("o_orderkey").alias("result"))
    return C.match_results(req, res)


def safe_inventory(spark, sf):
    return C.sanitized(table(spark, sf, "documents"), ("lang", "source"), ("doc_id",)).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"), F.min("doc_id_sha256").alias("first_sha256"))


def pooled_bodies(spark, sf):
    refs, pool = C.with_pool(_docs(spark, sf), "doc_id", "body")
    back = C.from_pool(refs, pool)
    return back.groupBy("sha256").agg(F.count(F.lit(1)).alias("uses"), F.max(F.length("body")).alias("chars"))


def decoded_texts(spark, sf):
    """URLs of pages with two rounds of percent escapes, and their markup's brackets as entities."""
    escaped = F.concat(F.url_encode(F.url_encode("url")), F.lit("%26lt;"), F.url_encode(F.upper(F.regexp_extract("html", "<title>([A-Za-z ]*)", 1))), F.lit("&amp;gt;"))
    return C.decode_texts(table(spark, sf, "pages").select("page_id", escaped.alias("t")), "page_id", "t")


QUERIES = {f.__name__: f for f in (reviewed_decisions, retired_documents, metadata_rebuild, decision_replay, request_submission, result_matching, safe_inventory, pooled_bodies, decoded_texts)}
ORACLE_SQL = {
    "reviewed_decisions": """WITH d AS (SELECT 'd/' || doc_id AS url, doc_id AS k, length(text) AS n FROM documents), e AS (SELECT *, CASE WHEN k % 3 <> 0 THEN NULL WHEN k % 10 = 9 THEN 'ambiguous decision' WHEN k % 7 = 0 THEN 'stale decision' END AS error,
 CASE WHEN k % 2 = 0 THEN 'remove' WHEN k % 5 = 0 THEN 'omit' ELSE 'keep' END AS disp FROM d)
 SELECT url, CASE WHEN k % 3 = 0 AND error IS NULL THEN disp ELSE 'keep' END AS disposition, CASE WHEN k % 3 = 0 AND error IS NULL AND disp = 'omit' THEN NULL WHEN k % 3 = 0 AND error IS NULL AND disp = 'remove' THEN 9 ELSE n END AS chars, error FROM e""",
    "retired_documents": "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)(?:(?:released under the)|(?:all rights reserved))')",
    "metadata_rebuild": _META_SQL,
    "decision_replay": _REPLAY_SQL,
    "request_submission": """SELECT coalesce(c_custkey, r) AS request, CASE WHEN c_custkey IS NULL OR (r IS NOT NULL AND c_custkey % 3 = 0) THEN 'queued' WHEN c_custkey % 3 = 0 THEN 'failed' ELSE 'done' END AS status,
 (coalesce(c_custkey % 4 + 1, 0) + CASE WHEN c_custkey IS NULL OR (r IS NOT NULL AND c_custkey % 3 = 0) THEN 1 ELSE 0 END)::INT AS attempt FROM customer FULL JOIN (SELECT DISTINCT o_custkey + 100 AS r FROM orders) ON r = c_custkey""",
    "result_matching": """WITH r AS (SELECT o_custkey + 20 AS request, count(*) AS n, min(o_orderkey) AS result FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
 SELECT coalesce(c_custkey, request) AS request, CASE WHEN c_custkey IS NOT NULL AND n = 1 THEN result END AS result, CASE WHEN c_custkey IS NULL THEN 'unknown' WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' END AS error FROM customer FULL JOIN r ON request = c_custkey""",
    "safe_inventory": "SELECT lang, source, count(*) AS documents, min(sha256(doc_id::VARCHAR)) AS first_sha256 FROM documents GROUP BY ALL",
    "pooled_bodies": "SELECT sha256(text) AS sha256, count(*) AS uses, max(length(text))::INT AS chars FROM documents GROUP BY 1",
    "decoded_texts": "SELECT page_id::VARCHAR AS page_id, lower(url) || '<' || lower(replace(regexp_extract(html, '<title>([A-Za-z ]*)', 1), ' ', '+')) || '>' AS text, NULL::VARCHAR AS error FROM pages",
}
