"""Queries that check a snapshot and fold its events: validation, coverage, dates, errors, claims, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions import text as X
from textkiln.operators import state as S
from textkiln.operators import validation as V
from textkiln.session import forgotten, shared_dir
from textkiln.sources.archive import distinct_attachments as _distinct_attachments
from textkiln.sources.tables import table
from textkiln.streaming import events as E


def document_errors(spark, sf):
    """Documents with a wrong hash, an http URL, a repeated tag or a bad date here and there."""
    k = F.col("doc_id")
    d = table(spark, sf, "documents").select(
        F.concat(F.when(k % 50 == 0, F.lit("/")).otherwise(F.lit("")), F.lit("content/"), k, F.lit("/index.md")).alias("path"), F.when(k % 11 != 0, F.lit("t")).alias("title"),
        F.concat(F.when(k % 13 == 0, F.lit("http")).otherwise(F.lit("https")), F.lit("://example.com/"), k).alias("url"), F.col("text").alias("body"),
        F.when(k % 17 == 0, F.lit("0")).otherwise(X.body_hash(F.col("text"))).alias("content_hash"), F.array(F.lit("a"), F.when(k % 19 == 0, F.lit("a")).otherwise(F.lit("b"))).alias("tags"),
        F.when(k % 3 == 0, F.when(k % 7 == 0, F.lit("2025-02-30")).otherwise(F.lit("2025-02-28"))).alias("publication_date"))
    return V.validate_documents(d)


def policy_conflicts(spark, sf):
    rules = table(spark, sf, "customer").select((F.col("c_custkey") % 1400).alias("source_id"), F.lit("/p").alias("path_prefix"))
    relations = table(spark, sf, "orders").select((F.col("o_custkey") % 30).cast("string").alias("source_url"), (F.col("o_orderkey") % 30).cast("string").alias("target_url"))
    return V.policy_conflicts(rules, ["source_id", "path_prefix"], relations)


def missing_targets(spark, sf):
    links = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_partkey") + 500).alias("target")).distinct()
    return V.missing_targets(links, table(spark, sf, "part"), "target", "p_partkey")


def file_verification(spark, sf):
    d = table(spark, sf, "documents")
    listed = d.where("doc_id % 9 != 0").select(F.concat(F.lit("f"), "doc_id").alias("name"), F.sha2("text", 256).alias("sha256"))
    found = d.where("doc_id % 8 != 0").select(F.concat(F.lit("f"), "doc_id").alias("name"), F.sha2(F.when(F.col("doc_id") % 7 == 0, F.lit("x")).otherwise(F.col("text")), 256).alias("sha256"))
    return V.verify_files(listed, found)


def review_coverage(spark, sf):
    given = table(spark, sf, "orders").select((F.col("o_custkey") % 2000).alias("address"))
    return V.coverage(table(spark, sf, "customer").select(F.col("c_custkey").alias("address")), given, ["address"])


def superseded_baseline(spark, sf):
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("path"), F.lit("1998-03-01").alias("captured_at"))
    inputs = table(spark, sf, "orders").select(F.col("o_custkey").alias("path"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_success"))
    return V.superseded(base, inputs)


def decision_errors(spark, sf):
    f = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 9 == 0, "credential").otherwise("email").alias("kind")).where("id % 4 != 3")
    d = table(spark, sf, "events").where("event_id % 5 != 4").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 2 == 0, "safe").when(F.col("event_id") % 11 == 0, "unresolved").otherwise("replace").alias("choice"), F.when(F.col("event_id") % 7 != 0, "reviewed").alias("reason"))
    return V.admissible(d, f)


def source_dates(spark, sf):
    """Times of events as sources write them: ISO, RFC 2822, with a zone, in words, or with a day that doesn't exist."""
    ts, kind = F.col("ts"), F.col("event_type")
    value = (
        F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd")).when(kind == "view", F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(kind == "signup", F.concat(F.lit("Updated "), F.date_format(ts, "MMMM d, yyyy"))).otherwise(F.date_format(ts, "yyyy-02-30")))
    v = F.col("v")
    return table(spark, sf, "events").select("event_id", value.alias("v")).select("event_id", X.source_date(v).alias("date"), X.long_date(v).alias("long_date"), F.date_format(X.aware_time(v), "yyyy-MM-dd HH:mm:ss").alias("time"))


def transient_errors(spark, sf):
    """Errors made of each event: a status from its value, or its kind in words."""
    kind, code = F.col("event_type"), (400 + F.floor("value") % 140).cast("string")
    error = F.when(kind == "click", F.concat(F.lit("HTTP "), code)).when(kind == "view", F.concat(F.lit("permanent: HTTP "), code)).when(kind == "error", F.concat_ws(" ", F.lit("read timed out after"), F.round("value", 1))).when(kind == "signup", F.concat(F.lit("connection reset by peer "), code))
    return table(spark, sf, "events").select("event_id", S.is_transient(error).alias("transient"))


def inference_claims(spark, sf):
    r = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request"), F.when(F.col("o_orderkey") < 3, "claimed").when(F.col("o_orderkey") % 2 == 0, "queued").otherwise("done").alias("status"),
        F.when(F.col("o_orderkey") == 1, "me").otherwise("other").alias("owner"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("submitted_at"))
    return S.claims(r, "me", 3)


def distinct_attachments(spark, sf):
    a = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document"), F.sha2((F.col("l_partkey") % 3).cast("string"), 256).alias("sha256"))
    return _distinct_attachments(a).groupBy("document").agg(F.max("index").alias("last_index"), F.count(F.lit(1)).alias("attachments"))


def _page_events(df):
    kind = F.when(F.col("event_type").isin("click", "view"), "success").when(F.col("event_type") == "purchase", "gone").otherwise("error")
    return df.where("user_id is not null").select(F.concat(F.lit("p"), "user_id").alias("page"), kind.alias("kind"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "event_id", "ts")


def event_fold(spark, sf):
    return E.folded(_page_events(table(spark, sf, "events")))


def event_stream(spark, sf):
    """The same fold as a stream: events come in five files that cut across time, three before a restart and two after."""
    import uuid

    events = table(spark, sf, "events")
    root = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    dealt = _page_events(events).select("page", "kind", "at", "event_id").withColumn("part", F.pmod("event_id", F.lit(5)))
    stream = E.page_states(E.read_events(spark, f"{root}/in", dealt.drop("part").schema))
    for parts in ((0, 1, 2), (3, 4)):
        dealt.where(F.col("part").isin(*parts)).repartitionByRange(len(parts), "part").drop("part").write.mode("append").parquet(f"{root}/in")
        E.upsert(stream, f"{root}/out", f"{root}/log")
    forgotten(spark, root)
    return E.newest(spark, f"{root}/out")


def event_windows(spark, sf):
    return E.windowed_counts(_page_events(table(spark, sf, "events")))


QUERIES = {f.__name__: f for f in (
    document_errors, policy_conflicts, missing_targets, file_verification, review_coverage, superseded_baseline, decision_errors, source_dates, transient_errors,
    inference_claims, distinct_attachments, event_fold, event_stream, event_windows)}

_KIND = "CASE WHEN event_type IN ('click', 'view') THEN 'success' WHEN event_type = 'purchase' THEN 'gone' ELSE 'error' END"
_FOLD_SQL = f"""WITH RECURSIVE e AS (SELECT 'p' || user_id AS page, {_KIND} AS kind, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events WHERE user_id IS NOT NULL),
r AS (SELECT page, 0::BIGINT AS i, 0 AS attempts, 0 AS failures, 0 AS terminals, 'discovered' AS status, NULL::VARCHAR AS last_success FROM (SELECT DISTINCT page FROM e)
 UNION ALL SELECT r.page, e.i, attempts + 1, CASE WHEN kind = 'success' THEN 0 ELSE failures + 1 END, CASE WHEN kind = 'gone' THEN terminals + 1 ELSE 0 END,
 CASE WHEN kind = 'success' THEN 'success' WHEN kind = 'gone' AND terminals >= 1 THEN 'confirmed_removal' WHEN kind = 'gone' THEN 'removal_candidate' WHEN last_success IS NOT NULL THEN 'carried_forward' ELSE 'failed' END,
 CASE WHEN kind = 'success' THEN t ELSE last_success END FROM r JOIN e ON e.page = r.page AND e.i = r.i + 1)
SELECT page, arg_max(status, i) AS status, arg_max(attempts, i) AS attempts, arg_max(failures, i) AS failures, arg_max(terminals, i) AS terminals, max(last_success) AS last_success FROM r GROUP BY page"""
_D = "documents"
ORACLE_SQL = {
    "document_errors": """WITH d AS (SELECT CASE WHEN doc_id % 50 = 0 THEN '/' ELSE '' END || 'content/' || doc_id || '/index.md' AS subject, doc_id AS k FROM documents)
 SELECT subject, 'path' AS error FROM d WHERE k % 50 = 0 UNION ALL SELECT subject, 'title' FROM d WHERE k % 11 = 0 UNION ALL SELECT subject, 'url' FROM d WHERE k % 13 = 0 UNION ALL SELECT subject, 'content_hash' FROM d WHERE k % 17 = 0
 UNION ALL SELECT subject, 'tags' FROM d WHERE k % 19 = 0 UNION ALL SELECT subject, 'publication_date' FROM d WHERE k % 21 = 0""",
    "policy_conflicts": """SELECT (c_custkey % 1400) || '|/p' AS subject, 'duplicate rule' AS error FROM customer GROUP BY c_custkey % 1400 HAVING count(*) > 1
 UNION ALL SELECT (o_custkey % 30)::VARCHAR, 'self relation' FROM orders WHERE o_custkey % 30 = o_orderkey % 30
 UNION ALL SELECT (o_custkey % 30) || '|' || (o_orderkey % 30), 'duplicate relation' FROM orders GROUP BY o_custkey % 30, o_orderkey % 30 HAVING count(*) > 1""",
    "missing_targets": "SELECT DISTINCT l_orderkey, l_partkey + 500 AS target FROM lineitem WHERE l_partkey + 500 NOT IN (SELECT p_partkey FROM part)",
    "file_verification": """SELECT 'f' || doc_id AS name, CASE WHEN doc_id % 9 = 0 THEN 'unlisted' WHEN doc_id % 8 = 0 THEN 'missing' ELSE 'changed' END AS error FROM documents
 WHERE (doc_id % 9 = 0) <> (doc_id % 8 = 0) OR (doc_id % 9 <> 0 AND doc_id % 8 <> 0 AND doc_id % 7 = 0)""",
    "review_coverage": """WITH g AS (SELECT o_custkey % 2000 AS address, count(*) AS n FROM orders GROUP BY 1) SELECT coalesce(c_custkey, address) AS address,
 CASE WHEN c_custkey IS NULL THEN 'unexpected' WHEN n IS NULL THEN 'missing' ELSE 'repeated' END AS error FROM customer FULL JOIN g ON address = c_custkey WHERE c_custkey IS NULL OR n IS NULL OR n > 1""",
    "superseded_baseline": "SELECT c_custkey AS path, '1998-03-01' AS captured_at FROM customer LEFT JOIN (SELECT o_custkey, max(strftime(o_orderdate, '%Y-%m-%d')) AS m FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE m IS NULL OR m <= '1998-03-01'",
    "decision_errors": """SELECT * FROM (SELECT event_id AS id, CASE WHEN event_id % 4 = 3 THEN CASE WHEN event_id % 5 <> 4 THEN 'unknown finding' END WHEN event_id % 5 = 4 THEN 'undecided' WHEN event_id % 9 = 0 AND event_id % 2 = 0 THEN 'credential can''t be safe'
 WHEN event_id % 2 <> 0 AND event_id % 11 = 0 THEN 'unresolved' WHEN event_id % 7 = 0 THEN 'no reason' END AS error FROM events) WHERE error IS NOT NULL""",
    "source_dates": """SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'error') THEN strftime(ts, '%Y-%m-%d') END AS date, CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d') END AS long_date,
 CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time FROM events""",
    "transient_errors": """SELECT event_id, coalesce(CASE event_type WHEN 'click' THEN floor(value) % 140 = 29 OR floor(value) % 140 BETWEEN 100 AND 139 WHEN 'view' THEN false WHEN 'error' THEN true WHEN 'signup' THEN true ELSE false END, false) AS transient FROM events""",
    "inference_claims": """WITH o AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders), n AS (SELECT 4 - least(4, count(*)) AS free FROM o WHERE k < 3),
 q AS (SELECT k AS request, 1 AS turn, d FROM (SELECT *, row_number() OVER (ORDER BY d, k) AS r FROM o WHERE k >= 3 AND k % 2 = 0) WHERE r <= (SELECT free FROM n))
 SELECT request, turn FROM (SELECT k AS request, 0 AS turn, d FROM o WHERE k = 1 UNION ALL SELECT * FROM q) ORDER BY turn, d, request LIMIT 3""",
    "distinct_attachments": "SELECT l_orderkey AS document, (count(DISTINCT l_partkey % 3) - 1)::INT AS last_index, count(*) AS attachments FROM lineitem GROUP BY l_orderkey",
    "event_fold": _FOLD_SQL,
    "event_stream": _FOLD_SQL,
    "event_windows": f"SELECT date_trunc('hour', ts) AS start, {_KIND} AS kind, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY ALL",
}
