"""Edits of several reviewers brought together: one set that every order of theirs gives, and conflicts as rows.

Edits name spans of one base text (``start, end`` in characters, an insertion has none) with the digest of what they found there. Equal edits are
one. Edits that share characters, insertions at one place, and insertions inside a replaced span conflict; a
conflict takes all edits of its cluster with it, so what stays doesn't depend on whose edit came first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkiln.operators.rewrites import edited

_SPAN = ["start", "end", "sha256", "replacement"]


def owned_edits(edits: DataFrame, sections: DataFrame, group: str) -> DataFrame:
    """``edits`` (with ``section``) plus ``owned``: does the edit lie in the section that it says it comes from? ``sections``: group, section, start, end."""
    s = sections.select(group, "section", F.col("start").alias("s_start"), F.col("end").alias("s_end"))
    inside = (F.col("s_start") <= F.col("start")) & (F.col("end") <= F.col("s_end"))
    return edits.join(s, [group, "section"], "left").withColumn("owned", F.coalesce(inside, F.lit(False))).drop("s_start", "s_end")


def merged_edits(edits: DataFrame, group: str) -> DataFrame:
    """``group, start, end, sha256, replacement, cluster, conflict`` of distinct edits: a cluster is what overlaps, one after another."""
    one = edits.select(group, *_SPAN).distinct()
    order = Window.partitionBy(group).orderBy("start", "end", "replacement", "sha256")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    insertion = F.col("start") == F.col("end")
    same_place = insertion & (F.lag("start").over(order) == F.col("start")) & (F.lag("end").over(order) == F.col("end"))
    apart = F.coalesce((F.col("start") >= F.max("end").over(before)) & ~same_place, F.lit(True))
    placed = one.withColumn("__apart", apart).withColumn("cluster", F.sum(F.col("__apart").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    n = F.count(F.lit(1)).over(Window.partitionBy(group, "cluster"))
    return placed.withColumn("conflict", n > 1).drop("__apart")


def conflicts(merged: DataFrame, group: str) -> DataFrame:
    """``group, start, end, edits``: each conflict's span and its edits as sorted ``start:end:replacement``."""
    said = F.concat_ws(":", "start", "end", "replacement")
    rows = merged.where("conflict").groupBy(group, "cluster").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(said)).alias("edits"))
    return rows.select(group, "start", "end", "edits")


def assembled(docs: DataFrame, edits: DataFrame, key: str, body: str, sections: DataFrame | None = None) -> DataFrame:
    """``key, body, conflicts, refused, error``: each document with the edits that don't conflict applied.

    ``refused`` counts edits outside the section that they come from; ``error`` is a guard that no longer holds, and keeps the body.
    """
    mine = edits if sections is None else owned_edits(edits, sections, key)
    refused = mine.where("not owned").groupBy(key).agg(F.count(F.lit(1)).alias("refused")) if sections is not None else None
    merged = merged_edits(mine if sections is None else mine.where("owned"), key)
    n = merged.where("conflict").groupBy(key).agg(F.count_distinct("cluster").alias("conflicts"))
    out = edited(docs, merged.where("not conflict").select(key, *_SPAN), key, body).join(n, key, "left")
    out = out.withColumn("refused", F.lit(0).cast("long")) if refused is None else out.join(refused, key, "left")
    return out.select(key, "body", F.coalesce("conflicts", F.lit(0)).alias("conflicts"), F.coalesce("refused", F.lit(0)).alias("refused"), "error")


def guarded_placements(edits: DataFrame, findings: DataFrame, group: str) -> DataFrame:
    """Findings of an edited text with the edit that wrote the characters they lie in.

    ``edits``: group, start, end, sha256, replacement, not overlapping, in the text before; ``findings``: group, start, end, sha256, replacement, in the text after.
    An edit counts if it removed the text (``sha256``) and wrote the replacement that the finding names. Gives group, the finding's
    ``start, end``, ``original_start, original_end`` and ``candidate_start, candidate_end`` of the edit.
    """
    w = Window.partitionBy(group).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("replacement").cast("long")
    moved = edits.withColumn("at", F.col("start") + F.coalesce(F.sum(size - (F.col("end") - F.col("start"))).over(w), F.lit(0))).withColumn("to", F.col("at") + size)
    # what the edits wrote doesn't overlap, so only the last block that begins at or before a finding can hold it: one sorted pass
    blocks = moved.where((F.col("start") < F.col("end")) & (F.col("at") < F.col("to"))).select(
        group, F.col("at").alias("place"), F.lit(0).alias("kind"), F.struct("at", "to", "start", "end", "sha256", "replacement").alias("edit"), *[F.lit(None).cast(k).alias(c) for c, k in (("until", "long"), ("sha256", "string"), ("replacement", "string"))])
    spans = findings.where(F.col("start") < F.col("end")).select(group, F.col("start").cast("long").alias("place"), F.lit(1).alias("kind"), F.lit(None).cast(blocks.schema["edit"].dataType).alias("edit"), F.col("end").cast("long").alias("until"), "sha256", "replacement")
    upto = Window.partitionBy(group).orderBy("place", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = blocks.unionByName(spans).withColumn("e", F.last("edit", ignorenulls=True).over(upto))
    held = met.where(F.col(group).isNotNull() & (F.col("kind") == 1) & (F.col("until") <= F.col("e.to")) & (F.col("sha256") == F.col("e.sha256")) & (F.col("replacement") == F.col("e.replacement")))
    return held.select(group, F.col("place").alias("start"), F.col("until").alias("end"), F.col("e.start").alias("original_start"), F.col("e.end").alias("original_end"), F.col("e.at").alias("candidate_start"), F.col("e.to").alias("candidate_end"))
