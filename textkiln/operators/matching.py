"""Prefix and marker matching against short reviewed tables.

A theta join of a large table with rules would be a nested loop. A prefix rule is instead looked up
by equality: a path has one candidate for each of its leading segments, so the join is an equi-join
whatever the number of rules, and only the longest hit stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Reviewed tables above this many rows are not broadcast.
MAX_BROADCAST_ROWS = 10_000


def rules_table(spark: SparkSession, rows: tuple, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def leading_paths(path: Column) -> Column:
    """``/a/b/c`` -> ``/``, ``/a``, ``/a/b``, ``/a/b/c``; without a leading slash the first is the first segment."""
    parts = F.split(path, "/")
    cuts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.array_distinct(F.transform(cuts, lambda x: F.when(x == "", F.lit("/")).otherwise(x)))


def excluded_by_prefix(rows: DataFrame, key: str, prefixes: tuple[str, ...]) -> DataFrame:
    """``rows`` plus ``excluded``: the key is a prefix of the list or lies below one (at a slash)."""
    return rows.withColumn("excluded", F.arrays_overlap(leading_paths(F.col(key)), F.array(*[F.lit(p) for p in prefixes])))


def longest_prefix(rows: DataFrame, path: str, rules: DataFrame, prefix: str, name: str) -> DataFrame:
    """``rows`` plus ``name``: the rule with the longest prefix at or above the path (null: none)."""
    rules = rules.select(F.struct("*").alias("__rule"), F.col(prefix).alias("__prefix"))
    found = (
        rows.select(path).distinct()
        .withColumn("__prefix", F.explode(leading_paths(F.col(path))))
        .join(rules, "__prefix").groupBy(path).agg(F.max_by("__rule", F.length("__prefix")).alias(name))
    )
    return rows.join(found, path, "left")


def longest_marker(rows: DataFrame, path: str, markers: DataFrame, marker: str, name: str) -> DataFrame:
    """``rows`` plus ``name``: the longest marker contained in the path and a slash. The markers are a reviewed list."""
    listed = markers.limit(MAX_BROADCAST_ROWS + 1).collect()
    if len(listed) > MAX_BROADCAST_ROWS:
        raise ValueError(f"more than {MAX_BROADCAST_ROWS} markers")
    out = F.lit(None)
    for r in sorted(listed, key=lambda r: (len(r[marker]), r[marker])):
        out = F.when(F.concat(F.col(path), F.lit("/")).contains(r[marker]), F.struct(*[F.lit(r[c]).alias(c) for c in markers.columns])).otherwise(out)
    return rows.withColumn(name, out if listed else F.lit(None).cast(markers.schema))
