"""Queries over evidence and inventories; the synthetic tables stand in for captures, reviews and releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.operators import evidence as E
from textkiln.sources.tables import table


def _files(spark, sf):
    return table(spark, sf, "documents").select(F.concat(F.lit("f"), "doc_id").alias("path"), F.col("text").alias("content"), "doc_id")


def seal_verification(spark, sf):
    f, k = _files(spark, sf), F.col("doc_id")
    records = f.select("path", F.when(k % 3 == 0, "accepted").when(k % 3 == 1, "excluded").otherwise("open").alias("disposition"), "doc_id")
    sealed = E.seal(records.where("doc_id % 20 != 7"), f)
    today = f.where("doc_id % 11 != 0").select("path", F.when(k % 13 == 0, F.lit("x")).otherwise(F.col("content")).alias("content"))
    now = records.where("doc_id % 17 != 0").select("path", F.when(k % 19 == 0, F.lit("accepted")).otherwise(F.col("disposition")).alias("disposition"))
    return E.verify_seal(sealed, now, today)


_SEAL_SQL = """SELECT * FROM (SELECT 'f' || k AS path, CASE WHEN k % 20 = 7 AND k % 17 = 0 THEN NULL WHEN k % 20 = 7 THEN 'not sealed' WHEN k % 17 = 0 THEN 'record missing' WHEN k % 11 = 0 THEN 'file missing'
 WHEN k % 13 = 0 THEN 'file changed' WHEN k % 19 = 0 AND k % 3 <> 0 THEN 'disposition changed' END AS error FROM (SELECT doc_id AS k FROM documents)) WHERE error IS NOT NULL"""


def frame_inventory(spark, sf):
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    v = l.groupBy(F.col("l_orderkey").alias("document")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "p"))), lambda x: F.struct(F.sha2(x["p"].cast("string"), 256).alias("sha256"), F.when(x["p"] % 2 == 0, x["l_linenumber"] * 10).alias("frame"))).alias("visuals"))
    return E.frames(v)


def evidence_checks(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("document"), (F.col("o_orderkey") % 50).alias("address")).distinct()
    claims = table(spark, sf, "customer").select(F.col("c_custkey").alias("document"), F.when(F.col("c_custkey") % 3 != 0, F.array((F.col("c_custkey") * 7) % 50, F.col("c_custkey") % 2)).otherwise(F.array().cast("array<bigint>")).alias("evidence"))
    return E.evidence_subset(claims, o)


def policy_qualification(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    before = d.where("doc_id % 10 != 0").select(k.alias("path"), F.sha2("text", 256).alias("sha256"))
    after = d.where("doc_id % 9 != 0").select(k.alias("path"), F.sha2(F.when(k % 7 == 0, F.upper("lang")).otherwise(F.col("text")), 256).alias("sha256"))
    return E.qualify(before, after, d.where("doc_id % 2 = 0").select(k.alias("path")))


def resumable_capture(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("identity"), "c_nationkey", "c_mktsegment")
    done = E.resumable(c.withColumn("c_nationkey", F.when(F.col("identity") % 4 == 0, -1).otherwise(F.col("c_nationkey"))).where("identity % 3 != 0"), spark.createDataFrame([], "identity long, binding string"), ("c_nationkey", "c_mktsegment")).select("identity", "binding")
    return E.resumable(c, done, ("c_nationkey", "c_mktsegment")).select("identity")


def disposition_history(spark, sf):
    """Customers with a balance have a history; one segment's are corrected."""
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    h = c.where("c_acctbal >= 0").select(k.alias("identity"), F.when(k % 2 == 0, "keep").otherwise("omit").alias("disposition"), F.lit("2025-01-01").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    fix = c.where("c_mktsegment = 'BUILDING'").select(k.alias("identity"), F.lit("keep").alias("disposition"))
    return E.corrected(h, fix, "2025-07-01")


def request_spacing(spark, sf):
    e = table(spark, sf, "events").where("user_id is not null").select(F.col("user_id").alias("client"), F.col("event_id").alias("request"), (F.col("event_id") % 100).cast("double").alias("at"))
    return E.spaced(e, "client", "at", 2.0).select("client", "request", "start")


def unreferenced_assets(spark, sf):
    return E.pruned_assets(table(spark, sf, "part").select(F.col("p_partkey").alias("path")), table(spark, sf, "lineitem").select((F.col("l_partkey") * 2).alias("target")))


def inventory_pass(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    at = lambda cond: c.where(cond).select(k.alias("id"))
    return E.inventory(at("c_custkey % 2 = 0"), at("c_custkey % 3 = 0"), at("c_custkey % 5 = 0"), at("c_custkey % 7 = 0").withColumn("decision", F.lit("include")))


def release_manifest(spark, sf):
    d = table(spark, sf, "documents").select("source", F.octet_length("text").cast("long").alias("size_bytes"), F.when(F.col("doc_id") % 4 == 0, "carried_forward").otherwise("success").alias("status"))
    a = table(spark, sf, "part").select(F.col("p_size").cast("long").alias("size_bytes"))
    return E.manifest(d, a, "2026-01-01T00:00:00Z", "2026-01-01T01:00:00Z")


def document_findings(spark, sf):
    """Whole texts, with the first 240 characters that a listing shows of them as descriptions."""
    shown = F.substring(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[ \t\n\r\f]+", " ")), 1, 240)
    return E.document_findings(table(spark, sf, "documents").select("doc_id", "text", shown.alias("description")), "doc_id", "text", "description")


def payloads(spark, sf):
    return table(spark, sf, "documents").select("doc_id", E.technical_payloads(F.col("text")).alias("payloads"))


def descriptions(spark, sf):
    return table(spark, sf, "documents").select("doc_id", E.first_paragraph(F.col("text")).alias("description"))


def structured_dates(spark, sf):
    """Whole pages with the metadata of the event of their number: in a graph, a list or one node by its kind."""
    node = F.concat(F.lit('{"datePublished":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"'), F.when(F.col("value") > 20, F.concat(F.lit(',"dateModified":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"'))).otherwise(F.lit("")), F.lit("}"))
    kind = F.col("event_type")
    data = F.when(kind == "click", F.concat(F.lit('{"@graph":[{"@type":"X"},'), node, F.lit("]}"))).when(kind == "view", F.concat(F.lit("["), node, F.lit("]"))).when(kind == "error", F.lit('{"dateModified":"soon"}')).otherwise(node)
    e = table(spark, sf, "events").select(F.col("event_id").alias("page_id"), data.alias("data"))
    pages = table(spark, sf, "pages").join(e, "page_id", "left").select("page_id", F.concat(F.col("html"), F.coalesce(F.concat(F.lit('<script type="application/ld+json">'), "data", F.lit("</script>")), F.lit(""))).alias("html"))
    return pages.select("page_id", E.json_ld_dates(F.col("html")).alias("d")).select("page_id", "d.published", "d.modified")


def url_origins(spark, sf):
    o = table(spark, sf, "orders")
    src = lambda m: o.where(f"o_orderkey % {m} = 0").select(F.col("o_custkey").cast("string").alias("url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen_at"))
    out = E.candidate_sources(src(2), src(3), src(5))
    return out.select("url", F.array_join("origins", ",").alias("origins"), "first_seen")


def carried_budgets(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    prev = c.select(k.alias("identity"), F.col("c_nationkey").alias("policy"), F.lit("a").alias("controller"), (k % 3).alias("budget"))
    cur = c.select(k.alias("identity"), F.when(k % 4 == 0, -1).otherwise(F.col("c_nationkey")).alias("policy"), F.lit("b").alias("controller"), F.lit(9).cast("long").alias("budget"))
    return E.changed_bindings(prev, cur, ("controller",))


QUERIES = {f.__name__: f for f in (
    seal_verification, frame_inventory, evidence_checks, policy_qualification, resumable_capture, disposition_history, request_spacing, unreferenced_assets,
    inventory_pass, release_manifest, document_findings, payloads, descriptions, structured_dates, url_origins, carried_budgets)}
ORACLE_SQL = {
    "seal_verification": _SEAL_SQL,
    "frame_inventory": """SELECT d AS document, sha256(p::VARCHAR) AS sha256, CASE WHEN p % 2 = 0 THEN l * 10 ELSE row_number() OVER (PARTITION BY d ORDER BY l) - 1 END::INT AS frame
 FROM (SELECT l_orderkey AS d, l_linenumber AS l, min(l_partkey) AS p FROM lineitem GROUP BY ALL)""",
    "evidence_checks": """WITH o AS (SELECT DISTINCT o_custkey AS d, o_orderkey % 50 AS a FROM orders) SELECT c_custkey AS document, c_custkey % 3 <> 0 AND EXISTS (SELECT 1 FROM o WHERE d = c_custkey AND a = c_custkey * 7 % 50)
 AND EXISTS (SELECT 1 FROM o WHERE d = c_custkey AND a = c_custkey % 2) AS valid FROM customer""",
    "policy_qualification": """SELECT doc_id AS path, CASE WHEN doc_id % 10 = 0 THEN 'added' WHEN doc_id % 9 = 0 THEN 'removed' ELSE 'changed' END AS change, doc_id % 2 = 0 AS approved FROM documents
 WHERE (doc_id % 10 = 0) <> (doc_id % 9 = 0) OR (doc_id % 10 <> 0 AND doc_id % 9 <> 0 AND doc_id % 7 = 0)""",
    "resumable_capture": "SELECT c_custkey AS identity FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0",
    "disposition_history": """SELECT c_custkey AS identity, CASE WHEN c_custkey % 2 = 0 THEN 'keep' ELSE 'omit' END AS disposition, '2025-01-01' AS valid_from, CASE WHEN c_custkey % 2 = 1 AND c_mktsegment = 'BUILDING' THEN '2025-07-01' END AS valid_to FROM customer WHERE c_acctbal >= 0
 UNION ALL SELECT c_custkey, 'keep', '2025-07-01', NULL FROM customer WHERE c_mktsegment = 'BUILDING' AND (c_acctbal IS NULL OR c_acctbal < 0 OR c_custkey % 2 = 1)""",
    "request_spacing": """WITH n AS (SELECT user_id AS client, event_id AS request, (event_id % 100)::DOUBLE AS at0, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 100, event_id) - 1 AS n FROM events WHERE user_id IS NOT NULL)
 SELECT client, request, max(at0 - 2 * n) OVER (PARTITION BY client ORDER BY n) + 2.0 * n AS start FROM n""",
    "unreferenced_assets": "SELECT p_partkey AS path FROM part WHERE p_partkey NOT IN (SELECT l_partkey * 2 FROM lineitem WHERE l_partkey IS NOT NULL)",
    "inventory_pass": """SELECT k AS id, CASE WHEN k % 7 = 0 THEN 'include' WHEN k % 6 = 0 THEN 'include' WHEN k % 3 = 0 OR (k % 5 = 0 AND k % 2 <> 0) THEN 'unresolved' ELSE 'exclude' END AS decision,
 CASE WHEN k % 7 = 0 THEN 'reviewed' WHEN k % 6 = 0 THEN 'listed and tagged' WHEN k % 3 = 0 THEN 'tagged but not listed' WHEN k % 5 = 0 AND k % 2 <> 0 THEN 'only in the sitemap' ELSE 'not tagged' END AS reason
 FROM (SELECT c_custkey AS k FROM customer) WHERE k % 2 = 0 OR k % 3 = 0 OR k % 5 = 0""",
    "release_manifest": """SELECT count(*) AS page_count, sum(strlen(text))::BIGINT AS page_bytes, count(*) FILTER (doc_id % 4 <> 0) AS fresh, count(DISTINCT source) AS sources, (SELECT count(*) FROM part) AS asset_count, (SELECT sum(p_size)::BIGINT FROM part) AS asset_bytes,
 '2026-01-01T00:00:00Z' AS started_at, '2026-01-01T01:00:00Z' AS ended_at FROM documents""",
    "document_findings": f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, substring(trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r\\f]+', ' ', 'g')), 1, 240) AS s FROM documents),
 f AS ({' UNION ALL '.join(f"SELECT doc_id, '{k}' AS category, len(regexp_extract_all(text, '{p}'))::INT AS n FROM d" for k, p in E.FINDINGS.items())}
 UNION ALL SELECT doc_id, 'short_document', (len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) < 80)::INT FROM d UNION ALL SELECT doc_id, 'clipped_description', (s <> '' AND NOT regexp_matches(s, '[.!?]$'))::INT FROM d)
 SELECT * FROM f WHERE n > 0""",
    "payloads": f"SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{E.PAYLOAD}', 1) AS payloads FROM documents",
    "descriptions": """SELECT doc_id, list_filter(list_transform(list_filter(regexp_split_to_array(text, '\\n[ \\t]*\\n'), lambda x: NOT regexp_matches(x, '(?m)^[ \\t]*(?:#|[-*+] |\\d+[.)] |\\||>|!\\[|```)')),
 lambda x: trim(regexp_replace(x, '[ \\t\\n\\r\\f]+', ' ', 'g'))), lambda x: length(x) >= 20 AND regexp_matches(x, '[.!?]$'))[1] AS description FROM documents""",
    "structured_dates": """SELECT page_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS published, CASE WHEN event_type <> 'error' AND value > 20 THEN strftime(ts, '%Y-%m-%d') END AS modified
 FROM pages LEFT JOIN events ON event_id = page_id""",
    "url_origins": """SELECT o_custkey::VARCHAR AS url, array_to_string(list_filter([CASE WHEN bool_or(o_orderkey % 5 = 0) THEN 'discovery' END, CASE WHEN bool_or(o_orderkey % 3 = 0) THEN 'inventory' END, CASE WHEN bool_or(o_orderkey % 2 = 0) THEN 'previous_publication' END], lambda x: x IS NOT NULL), ',') AS origins,
 min(strftime(o_orderdate, '%Y-%m-%d')) AS first_seen FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 GROUP BY o_custkey""",
    "carried_budgets": "SELECT c_custkey AS identity, CASE WHEN c_custkey % 4 = 0 THEN 9 ELSE c_custkey % 3 END AS budget FROM customer",
}
