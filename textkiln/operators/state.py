"""Page state as keyed tables: upserts, transitions, reconciliation with the previous snapshot, reports.

Updates are full-outer or left equi-joins on the URL, so a new snapshot replaces the old one in one
pass; nothing is updated row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PENDING = ("discovered", "failed", "fetching")
ACCEPTED = ("success", "carried_forward", "removal_candidate")
RAW_TERMINAL = ("removed_not_found", "removed_navigation")
RECONCILED = ("carried_forward", "removal_candidate", "confirmed_removal", "unavailable")
TERMINAL = (*RAW_TERMINAL, "confirmed_removal")


def upsert_discovered(state: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """Discovered pages go in; a known page is queued again only if its source date is given and differs.

    ``state``: url, source, status, discovered_at, updated_at, source_last_modified; ``found``: url, source,
    source_last_modified (one row a URL; of several the latest date counts).
    """
    found = found.groupBy("url").agg(F.max_by("source", F.coalesce("source_last_modified", F.lit(""))).alias("f_source"), F.max("source_last_modified").alias("f_date"), F.lit(True).alias("hit"))
    j = state.join(found, "url", "full_outer")
    known, hit = F.col("discovered_at").isNotNull(), F.col("hit").isNotNull()
    again = hit & F.col("f_date").isNotNull() & ~F.col("f_date").eqNullSafe(F.col("source_last_modified"))
    return j.select(
        "url",
        F.when(known, F.col("source")).otherwise(F.col("f_source")).alias("source"),
        F.when(~known | again, F.lit("discovered")).otherwise(F.col("status")).alias("status"),
        F.coalesce("discovered_at", now).alias("discovered_at"),
        F.when(hit, now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.coalesce(F.when(hit, F.col("f_date")), F.col("source_last_modified")).alias("source_last_modified"),
    )


def pending(state: DataFrame, force: bool = False) -> DataFrame:
    return state.where(F.col("status").isin(*PENDING, *(["success"] if force else [])))


def accepted(state: DataFrame) -> DataFrame:
    return state.where(F.col("status").isin(*ACCEPTED))


def mark_fetching(state: DataFrame, urls: DataFrame, now: Column) -> DataFrame:
    """Attempts go up and the error is cleared for the listed URLs."""
    hit = urls.select("url").distinct().withColumn("hit", F.lit(True))
    on = F.col("hit").isNotNull()
    return (
        state.join(hit, "url", "left")
        .withColumns({"status": F.when(on, "fetching").otherwise(F.col("status")), "attempts": F.col("attempts") + F.when(on, 1).otherwise(0),
                      "error_class": F.when(~on, F.col("error_class")), "updated_at": F.when(on, now).otherwise(F.col("updated_at"))})
        .drop("hit")
    )


def mark_results(state: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """A success resets the counters; a failure clears path and digest and records its class.

    ``results``: url, result (a status), path, digest, error.
    """
    j = state.join(results, "url", "left")
    hit, fresh = F.col("result").isNotNull(), F.col("result") == "success"
    keep = lambda c: F.when(~hit, F.col(c))
    return j.select(
        "url", "source", F.coalesce("result", "status").alias("status"),
        F.coalesce(keep("output_path"), "path").alias("output_path"), F.coalesce(keep("content_hash"), "digest").alias("content_hash"),
        F.when(hit, F.col("error")).otherwise(F.col("error_class")).alias("error_class"),
        F.when(hit & fresh, F.lit("fresh")).otherwise(F.col("freshness")).alias("freshness"),
        F.when(~hit, F.col("failure")).when(~fresh, F.col("result")).alias("failure"),
        F.when(hit & fresh, now).otherwise(F.col("last_success_at")).alias("last_success_at"),
        F.when(hit & fresh, 0).otherwise(F.col("failures")).alias("failures"),
        F.when(hit & fresh, 0).otherwise(F.col("terminals")).alias("terminals"),
    )


def reconcile(state: DataFrame, prior: DataFrame, retain: bool = False, prior_ended_at: str | None = None) -> DataFrame:
    """Rows that didn't succeed, against the previous snapshot.

    ``state``: url, status; ``prior``: url, path, sha256, last_success_at, failures, terminals. No prior
    document: unavailable. A terminal failure is a removal candidate, the second in a row a confirmed
    removal (unless ``retain``); anything else carries the prior document forward.
    """
    p = prior.select("url", F.lit(True).alias("had"), "path", "sha256", F.coalesce("last_success_at", F.lit(prior_ended_at).cast("string")).alias("last"), F.coalesce("failures", F.lit(0)).alias("f"), F.coalesce("terminals", F.lit(0)).alias("t"))
    j = state.where((F.col("status") != "success") & ~F.col("status").isin(*RECONCILED)).join(p, "url", "left")
    had, raw = F.col("had").isNotNull(), F.col("status").isin(*RAW_TERMINAL)
    t = F.when(raw, F.coalesce("t", F.lit(0)) + 1).otherwise(F.lit(0))
    gone = had & raw & (t >= 2) & F.lit(not retain)
    status = F.when(~had, "unavailable").when(gone, "confirmed_removal").when(raw, "removal_candidate").otherwise("carried_forward")
    restored = had & ~gone
    return j.select(
        "url", status.alias("status"), F.when(restored, F.col("path")).alias("output_path"), F.when(restored, F.coalesce("sha256", F.lit(""))).alias("content_hash"),
        status.alias("freshness"), F.col("status").alias("failure"), F.nullif(F.col("last"), F.lit("")).alias("last_success_at"),
        F.when(had, F.col("f") + 1).otherwise(1).alias("failures"), t.alias("terminals"),
    )


def classify_changes(current: DataFrame, prior: DataFrame) -> DataFrame:
    """``url, change``: new, changed, unchanged, fallback (prior kept for a failure), unavailable or absent.

    ``current``: url, status, sha256; ``prior``: url, sha256.
    """
    j = current.join(prior.select("url", F.col("sha256").alias("was"), F.lit(True).alias("had")), "url", "full_outer")
    ok, had = F.col("status") == "success", F.col("had").isNotNull()
    change = (
        F.when(F.col("status").isNull(), "absent").when(ok & ~had, "new").when(ok & (F.col("sha256") == F.col("was")), "unchanged")
        .when(ok, "changed").when(had, "fallback").otherwise("unavailable"))
    return j.select("url", change.alias("change"))


CHANGES = ("new", "changed", "unchanged", "fallback", "unavailable", "absent")


def zero_filled(counts: DataFrame, key: str, values: tuple[str, ...]) -> DataFrame:
    """Counts with a row for each of ``values``."""
    base = counts.sparkSession.createDataFrame([(v,) for v in values], f"{key} string")
    return base.join(counts.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def frontier(queues: DataFrame) -> DataFrame:
    """``queue, source, verdict``: a queue is deferred if strictly newer queues of its source cover all its identities.

    ``queues``: queue, source, started_at (ISO with zone, else unknown), identities (array). The newest
    queue that holds an identity is never deferred itself for it, so the newest epoch of each identity
    settles every older queue at once.
    """
    from textkiln.functions.text import aware_time

    q = queues.withColumn("epoch", aware_time(F.col("started_at")))
    each = q.select("queue", "source", "epoch", F.explode(F.array_distinct("identities")).alias("identity"))
    newest = F.max("epoch").over(Window.partitionBy("source", "identity"))
    covered = each.withColumn("newest", newest).groupBy("queue").agg(F.bool_and(F.coalesce(F.col("newest") > F.col("epoch"), F.lit(False))).alias("all_covered"))
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.col("epoch").isNotNull().desc(), F.col("epoch").desc(), F.col("queue").desc()))
    # an empty queue is covered by any dated queue that is selected before it
    out = q.withColumn("place", rank).join(covered, "queue", "left")
    deferred = F.col("epoch").isNotNull() & (F.col("all_covered") | (F.col("all_covered").isNull() & (F.col("place") > 1)))
    return out.select("queue", "source", F.when(F.col("epoch").isNull(), "uncertain").when(deferred, "deferred").otherwise("selected").alias("verdict"))


def review_batch(items: DataFrame, limit: int) -> DataFrame:
    """First ``limit`` of the eligible: prioritised first, then earlier published, then by URL.

    ``items``: identity, url, prioritised, published, final, binding_changed, retryable.
    """
    eligible = items.where(~F.col("final") & (F.col("binding_changed") | F.col("retryable")))
    return eligible.orderBy(~F.col("prioritised"), ~F.col("published"), "url", "identity").limit(limit)


def insert_or_ignore(exclusions: DataFrame, new: DataFrame) -> DataFrame:
    """First record of each URL stays."""
    return exclusions.unionByName(new.dropDuplicates(["url"]).join(exclusions.select("url"), "url", "left_anti"))


def replace_links(links: DataFrame, new: DataFrame) -> DataFrame:
    """All links of the documents in ``new`` are replaced by its distinct ones."""
    return links.join(new.select("document").distinct(), "document", "left_anti").unionByName(new.where("target is not null").distinct())


def claims(requests: DataFrame, owner: str, limit: int, most_running: int = 4) -> DataFrame:
    """What ``owner`` works on next: its own running claims, then queued requests while fewer than ``most_running`` run."""
    running = requests.where("status = 'claimed'")
    free = most_running - min(most_running, running.limit(most_running).count())
    own = running.where(F.col("owner") == owner).select("request", F.lit(0).alias("turn"), "submitted_at")
    queued = requests.where("status = 'queued'").orderBy("submitted_at", "request").limit(free).select("request", F.lit(1).alias("turn"), "submitted_at")
    return own.unionByName(queued).orderBy("turn", "submitted_at", "request").limit(limit).select("request", "turn")


def is_transient(error: Column) -> Column:
    """Rate limits, server errors and time-outs; an error that names itself permanent never is."""
    e = F.lower(F.coalesce(error, F.lit("")))
    return ~e.contains("permanent") & (e.rlike(r"\b(429|5\d\d)\b") | e.rlike("timed? ?out|temporar|connection (reset|refused)"))
