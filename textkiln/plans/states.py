"""Queries over state: the synthetic tables stand in for page state, manifests, queues and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.operators import state as S
from textkiln.sources.tables import table

_NOW = "2026-01-01T00:00:00Z"


def _page_state(spark, sf):
    """Customers as known pages."""
    c = table(spark, sf, "customer")
    return c.select(
        F.concat(F.lit("https://example.com/c/"), "c_custkey").alias("url"), F.concat(F.lit("s"), F.col("c_nationkey") % 4).alias("source"),
        F.element_at(F.array(*[F.lit(x) for x in ("success", "failed", "discovered", "removed_not_found", "removed_navigation", "fetching", "carried_forward")]), (F.col("c_custkey") % 7 + 1).cast("int")).alias("status"),
        F.lit("2025-01-01T00:00:00Z").alias("discovered_at"), F.lit("2025-06-01T00:00:00Z").alias("updated_at"),
        F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("2025-0"), F.col("c_custkey") % 9 + 1, F.lit("-01"))).alias("source_last_modified"), "c_custkey", "c_acctbal")


_STATE = """(SELECT 'https://example.com/c/' || c_custkey AS url, 's' || (c_nationkey % 4) AS source,
 (['success', 'failed', 'discovered', 'removed_not_found', 'removed_navigation', 'fetching', 'carried_forward'])[c_custkey % 7 + 1] AS status,
 '2025-01-01T00:00:00Z' AS discovered_at, '2025-06-01T00:00:00Z' AS updated_at,
 CASE WHEN c_custkey % 3 <> 0 THEN '2025-0' || (c_custkey % 9 + 1) || '-01' END AS source_last_modified, c_custkey FROM customer)"""


def state_upsert(spark, sf):
    """Orders as discoveries: customers above the known range are new."""
    found = table(spark, sf, "orders").select(
        F.concat(F.lit("https://example.com/c/"), F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey"))).alias("url"),
        F.lit("s9").alias("source"), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("source_last_modified"))
    return S.upsert_discovered(_page_state(spark, sf).drop("c_custkey", "c_acctbal"), found, F.lit(_NOW))


_UPSERT_SQL = f"""WITH f AS (SELECT url, max(d) AS d FROM (SELECT 'https://example.com/c/' || (CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1000000 ELSE o_custkey END) AS url,
 CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders) GROUP BY url)
SELECT coalesce(s.url, f.url) AS url, coalesce(s.source, 's9') AS source,
 CASE WHEN s.url IS NULL OR (f.d IS NOT NULL AND f.d IS DISTINCT FROM s.source_last_modified) THEN 'discovered' ELSE s.status END AS status,
 coalesce(s.discovered_at, '{_NOW}') AS discovered_at, CASE WHEN f.url IS NOT NULL THEN '{_NOW}' ELSE s.updated_at END AS updated_at,
 coalesce(f.d, s.source_last_modified) AS source_last_modified FROM {_STATE} s FULL JOIN f ON s.url = f.url"""


def status_counts(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("status")).agg(F.count(F.lit(1)).alias("n")).orderBy("status")


def pending_rows(spark, sf):
    return S.pending(_page_state(spark, sf), force=True).select("source", "url", "status").orderBy("source", "url")


def _prior(spark, sf):
    s = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("k"))
    return s.select(
        F.concat(F.lit("https://example.com/c/"), "o_custkey").alias("url"), F.concat(F.lit("content/"), "o_custkey", F.lit("/index.md")).alias("path"), F.sha2(F.col("k").cast("string"), 256).alias("sha256"),
        F.when(F.col("n") % 4 != 0, F.lit("2025-05-05")).alias("last_success_at"), (F.col("n") % 5).alias("failures"), (F.col("n") % 3).alias("terminals"))


_PRIOR = """(SELECT 'https://example.com/c/' || o_custkey AS url, 'content/' || o_custkey || '/index.md' AS path, sha256(k::VARCHAR) AS sha256,
 CASE WHEN n % 4 <> 0 THEN '2025-05-05' END AS last_success_at, n % 5 AS failures, n % 3 AS terminals FROM (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS k FROM orders GROUP BY 1))"""


def reconcile_states(spark, sf):
    return S.reconcile(_page_state(spark, sf).select("url", "status"), _prior(spark, sf), prior_ended_at="2025-09-09")


_RECONCILE_SQL = f"""SELECT url, st AS status, CASE WHEN had AND st <> 'confirmed_removal' THEN path END AS output_path, CASE WHEN had AND st <> 'confirmed_removal' THEN sha256 END AS content_hash,
 st AS freshness, status AS failure, CASE WHEN had THEN coalesce(last_success_at, '2025-09-09') END AS last_success_at, CASE WHEN had THEN failures + 1 ELSE 1 END AS failures, t AS terminals FROM (
 SELECT *, CASE WHEN NOT had THEN 'unavailable' WHEN raw AND t >= 2 THEN 'confirmed_removal' WHEN raw THEN 'removal_candidate' ELSE 'carried_forward' END AS st FROM (
 SELECT s.url, s.status, p.url IS NOT NULL AS had, p.path, p.sha256, p.last_success_at, p.failures, s.status LIKE 'removed_%' AS raw,
  CASE WHEN s.status LIKE 'removed_%' THEN coalesce(p.terminals, 0) + 1 ELSE 0 END AS t
 FROM {_STATE} s LEFT JOIN {_PRIOR} p ON s.url = p.url WHERE s.status NOT IN ('success', 'carried_forward', 'removal_candidate', 'confirmed_removal', 'unavailable')))"""


def change_classification(spark, sf):
    """Documents of ids below half as the prior snapshot (every third text altered), the rest of the ids plus a quarter as the current one."""
    d = table(spark, sf, "documents").select(F.concat(F.lit("d/"), "doc_id").alias("url"), "doc_id", "text")

    cur = d.where(F.col("doc_id") % 4 != 0).select("url", F.when(F.col("doc_id") % 7 == 0, "failed").otherwise("success").alias("status"), F.sha2("text", 256).alias("sha256"))
    prior = d.where(F.col("doc_id") % 5 != 0).select("url", F.sha2(F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("sha256"))
    return S.classify_changes(cur, prior)


_CHANGE_SQL = """SELECT coalesce(c.url, p.url) AS url, CASE WHEN c.url IS NULL THEN 'absent' WHEN c.status = 'success' AND p.url IS NULL THEN 'new' WHEN c.status = 'success' AND c.h = p.h THEN 'unchanged'
 WHEN c.status = 'success' THEN 'changed' WHEN p.url IS NOT NULL THEN 'fallback' ELSE 'unavailable' END AS change FROM
 (SELECT 'd/' || doc_id AS url, CASE WHEN doc_id % 7 = 0 THEN 'failed' ELSE 'success' END AS status, sha256(text) AS h FROM documents WHERE doc_id % 4 <> 0) c FULL JOIN
 (SELECT 'd/' || doc_id AS url, sha256(CASE WHEN doc_id % 3 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 5 <> 0) p ON c.url = p.url"""


def change_counts(spark, sf):
    return S.zero_filled(change_classification(spark, sf), "change", (*S.CHANGES, "invalid"))


def _queues(spark, sf):
    """Event users as queues of the event types they saw; epochs from their first event."""
    e = table(spark, sf, "events").where("user_id is not null")
    return e.groupBy("user_id").agg(F.min("ts").alias("t"), F.sort_array(F.collect_set("event_type")).alias("identities")).select(
        F.concat(F.lit("q"), "user_id").alias("queue"), F.concat(F.lit("s"), F.col("user_id") % 3).alias("source"),
        F.when(F.col("user_id") % 11 != 0, F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("started_at"), "identities")


def review_frontier(spark, sf):
    return S.frontier(_queues(spark, sf))


_FRONTIER_SQL = """WITH q AS (SELECT 'q' || user_id AS queue, 's' || (user_id % 3) AS source, CASE WHEN user_id % 11 <> 0 THEN date_trunc('second', min(ts)) END AS epoch, list(DISTINCT event_type) AS ids FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
e AS (SELECT queue, source, epoch, unnest(ids) AS i FROM q), m AS (SELECT source, i, max(epoch) AS newest FROM e GROUP BY ALL),
c AS (SELECT queue, bool_and(coalesce(newest > epoch, false)) AS c FROM e JOIN m USING (source, i) GROUP BY queue)
SELECT queue, source, CASE WHEN epoch IS NULL THEN 'uncertain' WHEN c THEN 'deferred' ELSE 'selected' END AS verdict FROM q JOIN c USING (queue)"""


def review_priority_topk(spark, sf):
    items = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id").select(
        F.col("doc_id").alias("identity"), F.concat("source", F.lit("/"), "doc_id").alias("url"), (F.col("toxic") == 1).alias("prioritised"), (F.col("quality") == 1).alias("published"),
        (F.col("doc_id") % 10 == 3).alias("final"), (F.col("doc_id") % 2 == 0).alias("binding_changed"), (F.col("doc_id") % 5 == 0).alias("retryable"))
    return S.review_batch(items, 50).select("identity", "url")


def exclusion_records(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("u"), F.col("c_custkey") % 100).alias("url"), F.col("c_mktsegment").alias("origin"))
    old = c.groupBy("url").agg(F.min("origin").alias("origin")).where("url < 'u5'")
    new = c.groupBy("url").agg(F.max("origin").alias("origin"))
    return S.insert_or_ignore(old, new)


def candidate_links(spark, sf):
    """Links of orders to parts; every tenth order's links are replaced."""
    l = table(spark, sf, "lineitem")
    links = l.select(F.col("l_orderkey").alias("document"), F.col("l_partkey").alias("target")).distinct()
    new = l.where("l_orderkey % 10 = 0").select(F.col("l_orderkey").alias("document"), F.col("l_suppkey").alias("target"))
    return S.replace_links(links, new)


def manifest_counts(spark, sf):
    s = _page_state(spark, sf).withColumn("status", F.when(F.col("status") == "success", "fresh").otherwise(F.col("status")))
    return S.zero_filled(s.where(F.col("status").isin("fresh", "carried_forward", "removal_candidate", "confirmed_removal", "unavailable")), "status", ("fresh", "carried_forward", "removal_candidate", "confirmed_removal", "unavailable"))


def mark_results(spark, sf):
    """Every second known page gets a result."""
    s = _page_state(spark, sf)
    state = s.select("url", "source", "status", F.lit("p").alias("output_path"), F.lit("h").alias("content_hash"), F.lit(None).cast("string").alias("error_class"), F.lit("old").alias("freshness"), F.lit(None).cast("string").alias("failure"), F.lit("2024").alias("last_success_at"), F.lit(2).alias("failures"), F.lit(1).alias("terminals"))
    ok = F.col("c_custkey") % 4 == 0
    results = s.where("c_custkey % 2 = 0").select("url", F.when(ok, "success").otherwise("failed").alias("result"), F.when(ok, F.lit("new")).alias("path"), F.when(ok, F.lit("d")).alias("digest"), F.when(~ok, F.lit("HTTPError")).alias("error"))
    return S.mark_results(state, results, F.lit("2026"))


QUERIES = {f.__name__: f for f in (
    state_upsert, status_counts, pending_rows, reconcile_states, change_classification, change_counts, review_frontier, review_priority_topk,
    exclusion_records, candidate_links, manifest_counts, mark_results)}
ORACLE_SQL = {
    "state_upsert": _UPSERT_SQL,
    "status_counts": "SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1",
    "pending_rows": f"SELECT source, url, status FROM {_STATE} WHERE status IN ('discovered', 'failed', 'fetching', 'success')",
    "reconcile_states": _RECONCILE_SQL,
    "change_classification": _CHANGE_SQL,
    "change_counts": f"SELECT v.change, coalesce(n, 0) AS n FROM (VALUES ('new'), ('changed'), ('unchanged'), ('fallback'), ('unavailable'), ('absent'), ('invalid')) v(change) LEFT JOIN (SELECT change, count(*) AS n FROM ({_CHANGE_SQL}) GROUP BY change) c USING (change)",
    "review_frontier": _FRONTIER_SQL,
    "review_priority_topk": """SELECT doc_id AS identity, source || '/' || doc_id AS url FROM labels JOIN documents USING (doc_id)
 WHERE doc_id % 10 <> 3 AND (doc_id % 2 = 0 OR doc_id % 5 = 0) ORDER BY toxic <> 1, quality <> 1, url, doc_id LIMIT 50""",
    "exclusion_records": """WITH c AS (SELECT 'u' || (c_custkey % 100) AS url, min(c_mktsegment) AS a, max(c_mktsegment) AS b FROM customer GROUP BY 1)
 SELECT url, CASE WHEN url < 'u5' THEN a ELSE b END AS origin FROM c""",
    "candidate_links": "SELECT DISTINCT l_orderkey AS document, CASE WHEN l_orderkey % 10 = 0 THEN l_suppkey ELSE l_partkey END AS target FROM lineitem",
    "manifest_counts": f"""SELECT v.status, coalesce(n, 0) AS n FROM (VALUES ('fresh'), ('carried_forward'), ('removal_candidate'), ('confirmed_removal'), ('unavailable')) v(status)
 LEFT JOIN (SELECT CASE WHEN status = 'success' THEN 'fresh' ELSE status END AS status, count(*) AS n FROM {_STATE} GROUP BY 1) USING (status)""",
    "mark_results": f"""SELECT url, source, CASE WHEN c_custkey % 4 = 0 THEN 'success' WHEN c_custkey % 2 = 0 THEN 'failed' ELSE status END AS status,
 CASE WHEN c_custkey % 4 = 0 THEN 'new' WHEN c_custkey % 2 = 1 THEN 'p' END AS output_path, CASE WHEN c_custkey % 4 = 0 THEN 'd' WHEN c_custkey % 2 = 1 THEN 'h' END AS content_hash,
 CASE WHEN c_custkey % 4 = 2 THEN 'HTTPError' END AS error_class, CASE WHEN c_custkey % 4 = 0 THEN 'fresh' ELSE 'old' END AS freshness, CASE WHEN c_custkey % 4 = 2 THEN 'failed' END AS failure,
 CASE WHEN c_custkey % 4 = 0 THEN '2026' ELSE '2024' END AS last_success_at, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 2 END AS failures, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS terminals FROM {_STATE}""",
}
