"""Constraint checks: every check returns rows of (subject, error), so a snapshot is valid if their union is empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.functions.text import body_hash, source_date
from textkiln.functions.urls import safe_member_path


def errors(rows: DataFrame, subject: str, checks: dict[str, Column]) -> DataFrame:
    """``subject, error`` for each check that a row fails (a null outcome fails)."""
    bad = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    return rows.select(F.col(subject).cast("string").alias("subject"), F.explode(bad).alias("error"))


def validate_documents(docs: DataFrame, subject: str = "path") -> DataFrame:
    """``path, title, url, body, content_hash, tags, publication_date``: fields, hash, tag order, dates, chrome."""
    tags = F.col("tags")
    return errors(docs, subject, {
        "path": safe_member_path(F.col("path")),
        "title": F.trim(F.coalesce("title", F.lit(""))) != "",
        "url": F.col("url").startswith("https://"),
        "content_hash": F.col("content_hash") == body_hash(F.col("body")),
        "tags": F.coalesce(F.size(F.array_distinct(tags)) == F.size(tags), F.lit(True)),
        "publication_date": F.col("publication_date").isNull() | (source_date(F.col("publication_date")) == F.col("publication_date")),
        "chrome": ~F.coalesce("body", F.lit("")).rlike(r"(?im)^(accept cookies|return to top|on this page)\s*$"),
    })


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """``key, n`` of keys that appear more than once."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def policy_conflicts(rules: DataFrame, key: list[str], relations: DataFrame) -> DataFrame:
    """Rules with one key, relations of a page to itself, relations declared twice."""
    twice = duplicate_keys(rules, key).select(F.concat_ws("|", *key).alias("subject"), F.lit("duplicate rule").alias("error"))
    own = relations.where("source_url = target_url").select(F.col("source_url").alias("subject"), F.lit("self relation").alias("error"))
    again = duplicate_keys(relations, ["source_url", "target_url"]).select(F.concat_ws("|", "source_url", "target_url").alias("subject"), F.lit("duplicate relation").alias("error"))
    return reduce(DataFrame.unionByName, [twice, own, again])


def missing_targets(links: DataFrame, documents: DataFrame, target: str, key: str) -> DataFrame:
    """Links whose target document doesn't exist."""
    return links.join(documents.select(F.col(key).alias(target)).distinct(), target, "left_anti")


def verify_files(listed: DataFrame, found: DataFrame) -> DataFrame:
    """``name, error``: full outer comparison of two tables of ``name, sha256``."""
    j = listed.select("name", F.col("sha256").alias("a")).join(found.select("name", F.col("sha256").alias("b")), "name", "full_outer")
    error = F.when(F.col("a").isNull(), "unlisted").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "changed")
    return j.select("name", error.alias("error")).where("error is not null")


def complete(rows: DataFrame, flags: list[str]) -> DataFrame:
    """One row: does every row have each flag?"""
    return rows.agg(*[F.coalesce(F.bool_and(f), F.lit(True)).alias(f) for f in flags])


def coverage(expected: DataFrame, given: DataFrame, key: list[str]) -> DataFrame:
    """``key, error``: expected keys given not exactly once, and given keys not expected."""
    n = given.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    e = expected.select(*key).distinct().withColumn("e", F.lit(True))
    j = e.join(n, key, "full_outer")
    return j.select(*key, F.when(F.col("e").isNull(), "unexpected").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").alias("error")).where("error is not null")


def superseded(baseline: DataFrame, inputs: DataFrame) -> DataFrame:
    """Baseline rows that no newer input replaces (``path, captured_at``; ISO times compare as text)."""
    i = inputs.groupBy("path").agg(F.max("last_success").alias("last_success"))
    return baseline.join(i, "path", "left").where("last_success is null or captured_at >= last_success").select(*baseline.columns)


def admissible(decisions: DataFrame, findings: DataFrame) -> DataFrame:
    """``id, error`` of privacy decisions: each finding decided once, credentials never safe, a reason for each."""
    j = findings.select("id", "kind").distinct().join(decisions.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("choice").alias("choice"), F.min(F.coalesce("reason", F.lit(""))).alias("reason")), "id", "full_outer")
    error = (
        F.when(F.col("kind").isNull(), "unknown finding").when(F.col("n").isNull(), "undecided").when(F.col("n") > 1, "decided twice")
        .when((F.col("kind").isin("credential", "private_key")) & (F.col("choice") == "safe"), "credential can't be safe").when(F.col("choice") == "unresolved", "unresolved").when(F.trim("reason") == "", "no reason"))
    return j.select("id", error.alias("error")).where("error is not null")
