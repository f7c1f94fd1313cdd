"""Contiguous shards of near-equal bytes, cut from global prefix sums (DataFrame operations only).

Rows are put in one global order (SHA-256 of the text, then id), so equal texts are neighbours. The
order is range-partitioned, the per-partition byte totals give each partition's offset, and shard
``j`` ends where the prefix sum reaches ``j/n`` of all bytes. A cut that falls inside a group of
equal texts moves to the group's nearer end when the whole group is at most ``together`` of a
shard's target; a larger group is split, since keeping it whole would make sizes unequal.

Defined results: a null text has no bytes (size 1, CRC 0) and counts as equal to the empty text;
null ids sort first; repeated rows each get a slot; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.llm.prefix import running_totals
from textkiln.llm.tables import written


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, together: float = 0.05, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: slots count from 0 in each shard, in the global order."""
    t = F.coalesce(F.col(text), F.lit(""))
    narrow = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(t) + 1).cast("long").alias("size"),
            F.crc32(t.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(t, 256)).alias("digest"),
        ), "shard-narrow")
    laid = written(running_totals(narrow, ["digest", "doc_id"], "size", label="shard-ranged"), "shard-laid")
    total = laid.agg(F.sum("size")).first()[0] or 0
    targets = [total * j // n_shards for j in range(1, n_shards)]
    cuts = _cuts(laid, targets, int(together * total / n_shards)) if total else targets
    shard = sum((F.when(F.col("before") >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    sharded = laid.withColumn("shard", shard)
    # at most n_shards rows
    first = F.broadcast(sharded.groupBy("shard").agg(F.min("index").alias("__first")))
    return sharded.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("index") - F.col("__first")).alias("slot"))


def _cuts(laid: DataFrame, targets: list[int], together: int) -> list[int]:
    """Cut positions; only the rows that straddle a target, at most one a cut, come to the driver."""
    straddles = F.lit(False)
    for x in targets:
        straddles = straddles | ((F.col("before") <= x) & (F.col("before") + F.col("size") > x))
    hit = [(r["digest"], r["before"], r["size"]) for r in laid.where(straddles).select("digest", "before", "size").collect()]
    if not hit:
        return targets
    spans = {
        bytes(r["digest"]): (r["lo"], r["hi"])
        for r in laid.where(F.col("digest").isin([bytes(d) for d, _, _ in hit])).groupBy("digest").agg(F.min("before").alias("lo"), F.max(F.col("before") + F.col("size")).alias("hi")).collect()
    }
    out = []
    for x in targets:
        row = next(((bytes(d), b, b + s) for d, b, s in hit if b <= x < b + s), None)
        lo, hi = spans[row[0]] if row else (x, x)
        if row and hi - lo > together:
            lo, hi = row[1], row[2]
        out.append(lo if x - lo <= hi - x else hi)
    return out
