"""A policy exchanged for another: only rows that a changed rule can touch are judged again.

Rules are prefixes with what they say; the longest prefix of a path holds. Of two policies the rules that differ are known by
their prefix. A row whose path lies at or below none of these has the same longest rule in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.operators.matching import leading_paths, longest_prefix


def changed_rules(old: DataFrame, new: DataFrame, prefix: str) -> DataFrame:
    """``prefix, change`` of rules that only one policy has (added, removed) or that say something else (changed)."""
    said = lambda df, name: df.select(prefix, F.to_json(F.struct(*[c for c in sorted(df.columns) if c != prefix])).alias(name))
    both = said(old, "before").join(said(new, "after"), prefix, "full").where(~F.col("before").eqNullSafe(F.col("after")))
    return both.select(prefix, F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed").alias("change"))


def touched(rows: DataFrame, path: str, changed: DataFrame, prefix: str) -> DataFrame:
    """Distinct paths at or below a changed rule: an equi-join of their leading parts with the rules that differ."""
    below = rows.select(path).distinct().withColumn("__prefix", F.explode(leading_paths(F.col(path))))
    return below.join(changed.select(F.col(prefix).alias("__prefix")), "__prefix", "left_semi").select(path).distinct()


def reclassified(kept: DataFrame, path: str, old: DataFrame, new: DataFrame, prefix: str, name: str) -> DataFrame:
    """``kept`` (rows with ``name``: the longest rule of ``old`` at or above their path) under the policy ``new``, with ``again``: was the row judged again?"""
    if set(old.columns) != set(new.columns):
        raise ValueError("rules of two policies have other columns")
    paths = touched(kept, path, changed_rules(old, new, prefix), prefix).withColumn("again", F.lit(True))
    marked = kept.join(paths, path, "left").withColumn("again", F.coalesce("again", F.lit(False)))
    same = marked.where("not again")
    judged = longest_prefix(marked.where("again").drop(name), path, new.select(*old.columns), prefix, name)
    return same.unionByName(judged.select(*same.columns))
