"""Curation: retired text, reviewed decisions guarded by digests, metadata joins, replay of recorded decisions."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.functions.text import body_hash, sorted_tags
from textkiln.operators.matching import leading_paths


def decoded(text: str, rounds: int = 8) -> str:
    """Percent, HTML and backslash escapes undone until nothing changes; more than ``rounds`` deep is an error."""
    for _ in range(rounds):
        nxt = re.sub(r"\\([!-/:-@\[-`{-~])", r"\1", html.unescape(unquote(text)))
        if nxt == text:
            return text
        text = nxt
    raise ValueError("escapes nested too deeply")


def decode_texts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, error``: decoded and case-folded texts; one nested too deeply gives an error."""
    def one(t):
        if t is None:
            return None, None
        try:
            return decoded(t).casefold(), None
        except ValueError as e:
            return None, str(e)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [one(t) for t in f["t"]]
            yield pd.DataFrame({"k": f["k"], "text": [x[0] for x in out], "error": [x[1] for x in out]})

    return rows.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInPandas(run, "k string, text string, error string").withColumnRenamed("k", key)


def retired(text: Column, patterns: tuple[str, ...]) -> Column:
    """Does any pattern of a reviewed list occur? One alternation, so that the text is scanned once."""
    return F.coalesce(text, F.lit("")).rlike("(?i)(?:" + "|".join(f"(?:{p})" for p in patterns) + ")") if patterns else F.lit(False)


def url_excluded(url_path: Column, families: tuple[str, ...], exact: tuple[str, ...] = ()) -> Column:
    """Listed exactly, or at or below a family (at a slash)."""
    own = url_path.isin(*exact) if exact else F.lit(False)
    return own | F.arrays_overlap(leading_paths(url_path), F.array(*[F.lit(f) for f in families]).cast("array<string>"))


def apply_decisions(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``url, disposition, body, error``: reviewed decisions on (url, digest of the body).

    ``docs``: url, body; ``decisions``: url, disposition (keep, remove, omit), input_sha256, output (the
    reviewed body, for remove). A decision on another input is stale; several on one page are ambiguous;
    both keep the page as it is and say so.
    """
    d = decisions.groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("disposition", "input_sha256", "output"), "input_sha256").alias("d"))
    j = docs.join(d, "url", "left").withColumn("h", F.when(F.col("n") == 1, body_hash(F.col("body"))))
    error = F.when(F.col("n") > 1, "ambiguous decision").when(F.col("d.input_sha256") != F.col("h"), "stale decision")
    on = F.col("n").isNotNull() & error.isNull()
    disposition = F.when(on, F.col("d.disposition")).otherwise("keep")
    return j.select("url", disposition.alias("disposition"), F.when(on & (F.col("d.disposition") == "omit"), F.lit(None)).when(on & (F.col("d.disposition") == "remove"), F.col("d.output")).otherwise(F.col("body")).alias("body"), error.alias("error"))


def rebuild_metadata(docs: DataFrame, aliases: DataFrame, overrides: DataFrame, links: DataFrame, redirects: DataFrame) -> DataFrame:
    """Documents with aliases of their product, overrides of their URL, and related documents.

    ``docs``: url, canonical_url, product; ``aliases``: product, alias; ``overrides``: url, lifecycle, replacement_url;
    ``links``: source, target (canonical URLs); ``redirects``: src, dst. A link counts if its target, or
    where its target redirects to, is the canonical URL of exactly one document other than its own.
    """
    a = aliases.groupBy("product").agg(sorted_tags(F.collect_set("alias")).alias("aliases"))
    single = docs.groupBy("canonical_url").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("target_url")).where("n = 1").select(F.col("canonical_url").alias("c"), "target_url")
    hop = redirects.groupBy("src").agg(F.min("dst").alias("dst"))
    l = links.distinct().join(hop, F.col("target") == F.col("src"), "left")
    near = l.join(single, F.col("target") == F.col("c"), "left").select("source", "dst", F.col("target_url").alias("direct"))
    far = near.join(single, F.col("dst") == F.col("c"), "left").select("source", F.coalesce("direct", "target_url").alias("related")).where("related is not null and related != source")
    related = far.groupBy(F.col("source").alias("url")).agg(F.array_sort(F.collect_set("related")).alias("related"))
    o = overrides.groupBy("url").agg(F.max("lifecycle").alias("lifecycle"), F.max("replacement_url").alias("replacement_url"))
    none = F.array().cast("array<string>")
    return (
        docs.join(a, "product", "left").join(o, "url", "left").join(related, "url", "left")
        .select("url", "product", F.coalesce("aliases", none).alias("aliases"), F.coalesce("lifecycle", F.lit("active")).alias("lifecycle"), "replacement_url", F.coalesce("related", none).alias("related"))
    )


def replay(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Recorded model decisions put on documents: each (document, input digest) must have exactly one.

    ``docs``: document, body; ``decisions``: document, input_sha256, disposition (rewrite, retain, alias, exclude), body,
    target. Returns document, disposition, body, error; whatever fails a gate falls back to the input.
    """
    once = decisions.groupBy("document", "input_sha256").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("disposition", F.col("body").alias("new_body"), "target")).alias("d")).select("document", "input_sha256", "n", "d.*")
    # targets are looked up for aliases only, before they meet the bodies: documents without a target would all go to one task
    known = docs.select(F.col("document").alias("target")).distinct()
    found = once.where("n = 1 and disposition = 'alias' and target is not null").select("document", "input_sha256", "target").join(known, "target", "left_semi").select("document", "input_sha256", F.lit(True).alias("target_known"))
    r = once.join(found, ["document", "input_sha256"], "left")
    j = docs.withColumn("input_sha256", body_hash(F.col("body"))).join(r, ["document", "input_sha256"], "left")
    error = (
        F.when(F.col("n").isNull(), "no decision").when(F.col("n") > 1, "several decisions")
        .when((F.col("disposition") == "rewrite") & (F.trim(F.coalesce("new_body", F.lit(""))) == ""), "empty rewrite")
        .when((F.col("disposition") == "alias") & (F.col("target_known").isNull() | (F.col("target") == F.col("document"))), "alias without target"))
    ok = error.isNull()
    return j.select("document", F.when(ok, F.col("disposition")).otherwise("fallback").alias("disposition"),
                    F.when(ok & (F.col("disposition") == "rewrite"), F.col("new_body")).when(ok & F.col("disposition").isin("alias", "exclude"), F.lit(None)).otherwise(F.col("body")).alias("body"), error.alias("error"))


def submit(queue: DataFrame, new: DataFrame) -> DataFrame:
    """Requests by digest: a known one that didn't fail stays; a failed one gets the next attempt; a new one its first.

    ``queue``: request, status, attempt; ``new``: request.
    """
    j = queue.join(new.select("request").distinct().withColumn("asked", F.lit(True)), "request", "full_outer")
    again = F.col("asked").isNotNull() & (F.col("status") == "failed")
    return j.select("request", F.when(F.col("status").isNull() | again, "queued").otherwise(F.col("status")).alias("status"), (F.coalesce("attempt", F.lit(0)) + F.when(F.col("status").isNull() | again, 1).otherwise(0)).alias("attempt"))


def match_results(requests: DataFrame, results: DataFrame) -> DataFrame:
    """``request, result, error``: unordered results met with their requests; unknown and repeated ids are errors."""
    n = results.groupBy("request").agg(F.count(F.lit(1)).alias("n"), F.min("result").alias("result"))
    j = requests.select("request").distinct().withColumn("known", F.lit(True)).join(n, "request", "full_outer")
    error = F.when(F.col("known").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated")
    return j.select("request", F.when(error.isNull(), F.col("result")).alias("result"), error.alias("error"))


def sanitized(rows: DataFrame, allowed: tuple[str, ...], hashed: tuple[str, ...]) -> DataFrame:
    """Only allowed columns, and digests of the hashed ones."""
    return rows.select(*allowed, *[F.sha2(F.col(c).cast("string"), 256).alias(f"{c}_sha256") for c in hashed])


def with_pool(rows: DataFrame, key: str, body: str) -> tuple[DataFrame, DataFrame]:
    """Bodies pooled by digest: rows with ``sha256`` instead of the body, and one row for each distinct body."""
    d = rows.withColumn("sha256", F.sha2(body, 256))
    return d.select(key, "sha256"), d.select("sha256", body).dropDuplicates(["sha256"])


def from_pool(refs: DataFrame, pool: DataFrame) -> DataFrame:
    return refs.join(pool, "sha256", "left")
