"""Metadata projected from routes, titles and posts; digests by path and by file; policies under a digest; checks that a transformation is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def route_metadata(url: Column) -> dict[str, Column]:
    """``slug, category, subcategory, breadcrumb`` of a documentation route: its last step without a suffix, its first two steps, and all but the last as titles."""
    path = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*/?([^?#]*)", 1)
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    last = F.regexp_replace(F.element_at(steps, -1), r"\.[A-Za-z0-9]{1,5}$", "")
    title = lambda x: F.initcap(F.regexp_replace(x, "[-_]+", " "))
    some = F.size(steps) > 0
    return {
        "slug": F.when(some, last), "category": F.get(steps, F.lit(0)), "subcategory": F.when(F.size(steps) > 2, F.get(steps, F.lit(1))),
        "breadcrumb": F.when(some, F.transform(F.slice(steps, F.lit(1), F.size(steps) - 1), title)).otherwise(F.array().cast("array<string>"))}


def support_metadata(title: Column, kinds: dict[str, str]) -> dict[str, Column]:
    """``article, title, kind`` of a support article: the number that leads its title, the title without it, and a kind by what the rest begins with."""
    number = F.regexp_extract(title, r"^(K\d+)\s*:\s*", 1)
    rest = F.regexp_replace(title, r"^K\d+\s*:\s*", "")
    kind = F.lit(None).cast("string")
    for start, name in sorted(kinds.items(), key=lambda kv: len(kv[0])):
        kind = F.when(F.lower(rest).startswith(start), name).otherwise(kind)
    return {"article": F.nullif(number, F.lit("")), "title": rest, "kind": kind}


def post_description(text: Column, most: int = 240) -> Column:
    """The first characters of a post, with blanks made one."""
    return F.substring(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), 1, most)


def payload_digest(path: Column) -> Column:
    """The digest that a path of an immutable payload names: ``payloads/ab/<64 hex>`` with ``ab`` its first two; null for any other path."""
    found = F.regexp_extract(path, r"^payloads/([0-9a-f]{2})/([0-9a-f]{64})(?:\.[a-z0-9]{1,10})?$", 2)
    return F.when((found != "") & (F.substring(found, 1, 2) == F.regexp_extract(path, r"^payloads/([0-9a-f]{2})/", 1)), found)


def file_digests(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, length, sha256`` of the files below a folder, wherever it is stored."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def pinned_policy(spark: SparkSession, path: str, sha256: str, schema: str) -> DataFrame:
    """Rows of a policy in JSON lines (gzip by its suffix), if the file's bytes have the pinned digest; another digest is an error when it is read."""
    found = file_digests(spark, path).agg(F.max("sha256")).scalar()
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.where(F.assert_true(found.eqNullSafe(F.lit(sha256)), F.lit("the policy's digest isn't the pinned one")).isNull())


def violations(rows: DataFrame, excluded: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """Rows of a finished corpus that its own policy would still take out (``excluded`` gives their keys); none if the policy was applied."""
    return rows.join(excluded(rows).select(key).distinct(), key, "left_semi")


def unstable(rows: DataFrame, transform: Callable[[DataFrame], DataFrame], key: str, text: str) -> DataFrame:
    """Keys whose text another run of a transformation would change; none if it is idempotent there."""
    again = transform(rows).select(key, F.col(text).alias("__again"))
    return rows.join(again, key).where(~F.col(text).eqNullSafe(F.col("__again"))).select(key)
