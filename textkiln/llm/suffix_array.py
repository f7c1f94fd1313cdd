"""Suffix order of whole tables by a difference cover, every step over all tasks: the direct form of ``suffix_dedup``.

Suffixes are ordered by their first ``WINDOW`` bytes, which is all that removal looks at.

1. Positions 1 and 2 modulo 3 are sampled and sorted by triples of eight-byte words; equal triples get one name, numbered
   over all ranges (24 bytes).
2. One recursion names pairs of names and two more bytes: 24 + 24 + 2 bytes, the depth of a window, so it ends here.
3. Positions 0 modulo 3 follow from one byte and the rank of the next position. The merge counts, for every suffix, the
   suffixes of the other kind before it: 0 meets 1 one byte on, 0 meets 2 two bytes on, 1 and 2 by rank.
4. Neighbours whose prefixes agree (by a 64-bit hash) form a class; a window goes if its class has a smaller document.

Every position is a row that is sorted and joined several times, so this moves some hundred times the input. The query takes
``suffix_dedup``, which deals positions out first; the README has the figures of both.

Defined results: as in ``suffix_dedup``; ``row`` is unique, a null text has no windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.arrow import small
from textkiln.llm.prefix import running_totals
from textkiln.llm.suffix_dedup import WINDOW, _words8
from textkiln.llm.tables import dropped, written

_POSITION = "row long, d long, pos int, w0 long, w1 long, w2 long, tail int, first int, second int, hash long, window boolean"


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every position that a window, or the rank of one, looks at."""
    for b in small(batches, 16):
        for row, d, t in zip(b["row"].to_pylist(), b["d"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
            n = len(t or b"") - WINDOW + 1
            if n < 1:
                continue
            x = np.frombuffer(t + bytes(120), np.uint8)
            w = (_words8(x) ^ np.uint64(1 << 63)).view(np.int64)  # signed in the same order
            p = np.arange(n + 26)
            digest = [xxhash.xxh64_intdigest(t[i:i + WINDOW]) - (1 << 63) for i in range(n)] + [0] * 26
            columns = [np.full(len(p), row), np.full(len(p), d), p.astype(np.int32), w[p], w[p + 8], w[p + 16], (x[p + 48].astype(np.int32) << 8) | x[p + 49], x[p].astype(np.int32), x[p + 1].astype(np.int32), np.array(digest, np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(p < n)], [c.split()[0] for c in _POSITION.split(", ")])


def named(rows: DataFrame, keys: list[str], name: str, label: str) -> DataFrame:
    """``rows`` plus ``name``: the dense rank of their keys. Ranges hold whole keys; those before count their distinct ones."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(rows.repartitionByRange(n, *keys).withColumn("__part", F.spark_partition_id()).withColumn("__name", F.dense_rank().over(Window.partitionBy("__part").orderBy(*keys))), label)
    # one row a range
    before = ranged.groupBy("__part").agg(F.max("__name").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranged.join(F.broadcast(before.drop("__n")), "__part").withColumn(name, F.col("__before") + F.col("__name")).drop("__part", "__before", "__name")


def _next(ranks: DataFrame, step: int, name: str) -> DataFrame:
    return ranks.select("row", (F.col("pos") - step).alias("pos"), F.col("rank").alias(name))


def _smaller(a: DataFrame, b: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``row, pos, name``: for every row of ``a`` the rows of ``b`` with lesser keys."""
    both = written(a.select("row", "pos", *keys, F.lit(0).cast("long").alias("other")).unionByName(b.select("row", "pos", *keys, F.lit(1).cast("long").alias("other"))), "array-merge")
    out = running_totals(both, [*keys, "other", "row", "pos"], "other", label="array-counted").where("other = 0").select("row", "pos", F.col("before").alias(name))
    return out


def suffix_order(rows: DataFrame) -> DataFrame:
    """``row, d, pos, hash, index``: windows of ``row, d, text`` with a place in the order of their bytes; equal windows are neighbours."""
    all_positions = written(rows.select("row", "d", "text").mapInArrow(_positions, _POSITION), "array-positions")
    sampled = all_positions.where("pos % 3 != 0")
    first = written(named(sampled.select("row", "pos", "w0", "w1", "w2", "tail"), ["w0", "w1", "w2"], "rank", "array-triples").select("row", "pos", "tail", "rank"), "array-names")
    pairs = first.join(_next(first.select("row", "pos", "rank"), 24, "far"), ["row", "pos"], "left").withColumn("far", F.coalesce("far", F.lit(0)))
    ranks = written(named(pairs, ["rank", "far", "tail"], "name", "array-pairs").select("row", "pos", F.col("name").alias("rank")), "array-ranks")
    windows = all_positions.where("window")
    one = lambda k: windows.where(F.col("pos") % 3 == k)
    by_one = lambda k: one(k).select("row", "pos", "first").join(_next(ranks, 1, "r"), ["row", "pos"])
    by_two = lambda k: one(k).select("row", "pos", "first", "second").join(_next(ranks, 2, "r"), ["row", "pos"])
    zero, ones, twos = by_one(0), by_one(1), by_two(2)
    k1, k2 = ["first", "r"], ["first", "second", "r"]
    own0 = running_totals(written(zero, "array-zero"), [*k1, "row", "pos"], "r", label="array-own").select("row", "pos", "index")
    place0 = own0.join(_smaller(zero, ones, k1, "n1"), ["row", "pos"]).join(_smaller(by_two(0), twos, k2, "n2"), ["row", "pos"]).select("row", "pos", (F.col("index") + F.col("n1") + F.col("n2")).alias("index"))
    mine = written(windows.where("pos % 3 != 0").select("row", "pos").join(ranks, ["row", "pos"]), "array-rest")
    own12 = running_totals(mine, ["rank", "row", "pos"], "rank", label="array-own").select("row", "pos", "index")
    less = _smaller(ones, zero, k1, "n").unionByName(_smaller(twos, by_two(0), k2, "n"))
    place12 = own12.join(less, ["row", "pos"]).select("row", "pos", (F.col("index") + F.col("n")).alias("index"))
    return windows.select("row", "d", "pos", "hash").join(place0.unionByName(place12), ["row", "pos"])


def repeated_windows(rows: DataFrame) -> DataFrame:
    """``row, pos`` of windows that a smaller document (``d``) holds too: adjacent prefixes are compared, classes numbered, and each takes its least document."""
    ordered = written(suffix_order(rows).withColumnRenamed("index", "at").withColumn("one", F.lit(1).cast("long")), "array-laid")
    placed = written(running_totals(ordered, ["at", "hash", "row", "pos"], "one", label="array-placed").select("row", "d", "pos", "hash", F.col("index").alias("place")), "array-places")
    ahead = placed.select((F.col("place") + 1).alias("place"), F.col("hash").alias("ahead"))
    new = placed.join(ahead, "place", "left").withColumn("new", (~F.col("hash").eqNullSafe(F.col("ahead"))).cast("long"))
    classes = running_totals(written(new.select("row", "d", "pos", "place", "new"), "array-new"), ["place"], "new", label="array-classes").withColumn("class", F.col("before") + F.col("new"))
    classes = written(classes.select("row", "d", "pos", "class"), "array-of-class")
    least = classes.groupBy("class").agg(F.min("d").alias("least"))
    out = written(classes.join(least, "class").where("least < d").select("row", "pos"), "array-windows")
    dropped(ordered, placed, classes)
    return out
