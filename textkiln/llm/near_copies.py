"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash fingerprints of the sets, linked through Golay keys at four bits or fewer (``simhash.fingerprint_links``), find
close copies, and sets of that similarity can differ in 13 bits and more, which no affordable number of keys
reaches. So candidates come from two places, and whole sets verify both.

1. Golay links, and beside them neighbours by size among texts that share a shingle that counts (below). Together they join
   large groups by few pairs.
2. What is not joined by then is compared exactly. Shingles are ordered alike for all texts; of two sets of
   that similarity each has a common shingle among its first ``n - ceil(0.8 n) + 1``, so texts that share none of
   these need no comparison, and no pair is lost. The order is free: shingles that a sample finds in many texts come
   last, the others by hash, so that the shared shingles are rare ones.

Sizes, positions and parities of classes of shingles bound the common part of a pair before any set is sent: a class that is
odd in one set only holds a shingle of that set only. There are 512 classes, and for larger sets as many more as they
have shingles. Sets are larger than their texts, so they are made anew from the texts where they are needed.

Defined results: words are what blanks divide, in lower case; fewer words than a shingle make one shingle; texts without
words, null texts included, are copies of each other. Shingles and sets go by hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.arrow import small
from textkiln.llm.components import components
from textkiln.llm.simhash import fingerprint_links, majority, signed
from textkiln.llm.tables import dropped, written

WORDS = 5
#: One text of so many is looked at for frequent shingles, and these are what so many of them hold; only the order depends on it.
SAMPLE, FREQUENT, MOST_FREQUENT = 8, 8, 200_000
PARITIES = [f"b{i}" for i in range(8)]
#: Sets of more shingles have more classes.
FEW = 256


def shingles(text: bytes | None) -> np.ndarray:
    """The text's shingles by hash, ascending and distinct."""
    w = (text or b"").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) <= WORDS:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts, stops = [0, *ends[:-WORDS].tolist()], (ends[WORDS - 1:] - 1).tolist()
    return np.unique(np.fromiter([digest(joined[s:e], 42) for s, e in zip(starts, stops)], np.uint64, len(starts)))


def set_digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes(), 7)


def parities(s: np.ndarray, classes: int) -> np.ndarray:
    """Bytes of a bit for each class (a power of two): is it odd? Classes go by the hash's first bits, so halves of them add up."""
    odd = np.bincount((s >> np.uint64(64 - classes.bit_length() + 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        sets = [shingles(t) for t in b["text"].cast(pa.binary()).to_pylist()]
        bits = np.array([parities(s, 512) for s in sets]).reshape(len(sets), 64).view("<i8")
        wide = [parities(s, 2 << len(s).bit_length()).tobytes() if len(s) > FEW else None for s in sets]
        columns = [
            b["row"], b["doc_id"], b["text_hash"], pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32()), pa.array([signed(majority(s)) for s in sets], pa.int64()),
            *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(8)], pa.array(wide, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "text_hash", "digest", "n", "fp", *PARITIES, "wide"])


def _fits(x: bytes | None, y: bytes | None, n: int) -> bool:
    """May sets of ``n`` shingles together have the similarity, by their parities?"""
    if x is None or y is None:
        return True
    p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(p) != len(q):
        # twice the classes: neighbours add up
        long = np.unpackbits(p if len(p) > len(q) else q, bitorder="little")
        half = np.packbits(long[::2] ^ long[1::2], bitorder="little")
        p, q = (half, q) if len(p) > len(q) else (p, half)
    return 9 * int(np.bitwise_count(p ^ q).sum()) <= n


def _narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        ok = pa.array([_fits(x, y, n) for x, y, n in zip(b["x"].to_pylist(), b["y"].to_pylist(), b["n"].to_pylist())], pa.bool_())
        yield pa.RecordBatch.from_arrays([b["a"].filter(ok), b["b"].filter(ok)], ["a", "b"])


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        sets = [shingles(t) for t in b["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64))], ["shingle"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        sets = [shingles(t) for t in b["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b["set_key"], pa.array([s.tobytes() for s in sets], pa.binary())], ["set_key", "shingles"])


def _firsts(frequent: np.ndarray):
    """Of every set the shingles that a set of similarity 0.8 shares one of. ``frequent``: shingles that come last, in this order."""
    by_hash = np.argsort(frequent)
    known = frequent[by_hash]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            keys, first = [], [np.empty(0, np.uint64)]
            for k, t in zip(b["set_key"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
                s = shingles(t)
                if not len(s):
                    continue
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    late = known[at] == s
                    s = np.concatenate((s[~late], s[late][np.argsort(by_hash[at[late]])]))
                keys.append((k, len(s)))
                first.append(s[:len(s) - -(-4 * len(s) // 5) + 1])
            sizes = [len(f) for f in first[1:]]
            k, n = (np.array([x[i] for x in keys], np.int64) for i in (0, 1))
            place = np.concatenate([np.arange(0), *[np.arange(x) for x in sizes]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(first).view(np.int64)), pa.array(np.repeat(k, sizes)), pa.array(np.repeat(n, sizes).astype(np.int32)), pa.array(place)], ["shingle", "set_key", "n", "place"])

    return run


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        x, y = ([np.frombuffer(s, np.uint64) for s in b[c].to_pylist()] for c in ("x", "y"))
        ok = [9 * len(np.intersect1d(s, t, assume_unique=True)) >= 4 * (len(s) + len(t)) for s, t in zip(x, y)]
        yield pa.RecordBatch.from_arrays([b["a"].filter(pa.array(ok, pa.bool_())), b["b"].filter(pa.array(ok, pa.bool_()))], ["a", "b"])


def _may(x: str, y: str) -> Column:
    """If the parities allow a similarity of 0.8: at least as many shingles as parities differ are in one set only."""
    differ = reduce(lambda s, t: s + t, [F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in PARITIES])
    return (5 * F.least(f"{x}.n", f"{y}.n") >= 4 * F.greatest(f"{x}.n", f"{y}.n")) & (9 * differ <= F.col(f"{x}.n") + F.col(f"{y}.n"))


def _pairs(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Those of ``a, b`` (set keys) that sizes and parities allow."""
    near = pairs.join(bits.alias("x"), F.col("a") == F.col("x.set_key")).join(bits.alias("y"), (F.col("b") == F.col("y.set_key")) & _may("x", "y"))
    return near.select("a", "b", F.col("x.wide").alias("x"), F.col("y.wide").alias("y"), (F.col("x.n") + F.col("y.n")).alias("n")).mapInArrow(_narrowed, "a long, b long")


def _verified(pairs: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """Those of ``a, b`` whose whole sets have a similarity of 0.8."""
    pairs = written(pairs, f"{label}-pairs")
    asked = pairs.select(F.col("a").alias("set_key")).unionByName(pairs.select(F.col("b").alias("set_key"))).distinct()
    whole = written(rows.join(asked, "set_key", "left_semi").select("set_key", "text").mapInArrow(_whole, "set_key long, shingles binary"), f"{label}-whole")
    x, y = (whole.select(F.col("set_key").alias(k), F.col("shingles").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    links = written(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_similar, "a long, b long"), f"{label}-links")
    dropped(pairs, whole)
    return links


def golay_pairs(bits: DataFrame) -> DataFrame:
    """``a, b``: sets whose fingerprints are equal, each with the least of them, and one pair for each Golay link of two fingerprints."""
    of = written(bits.select("fp", "set_key"), "near-fp")
    least = of.groupBy("fp").agg(F.min("set_key").alias("rep"))
    links = written(fingerprint_links(least.select("fp")), "near-golay")
    same = of.join(least, "fp").where("set_key != rep").select(F.col("rep").alias("a"), F.col("set_key").alias("b"))
    end = lambda c: least.select(F.col("fp").alias(c), F.col("rep").alias(f"{c}_rep"))
    between = links.join(end("a"), "a").join(end("b"), "b").select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b"))
    out = written(same.unionByName(between).distinct(), "near-golay-pairs")
    dropped(of, links)
    return out


def set_links(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """``a, b`` (set keys): links that join all sets of similarity 0.8 or more. ``rows``: a text of every set; ``bits``: their sizes, fingerprints and parities."""
    counted = rows.where(F.pmod(F.xxhash64("set_key"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(_exploded, "shingle long").groupBy("shingle").count()
    frequent = [r["shingle"] for r in counted.where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "shingle").limit(MOST_FREQUENT).collect()]
    firsts = rows.select("set_key", "text").mapInArrow(_firsts(np.array(frequent[::-1], np.int64).view(np.uint64)), "shingle long, set_key long, n int, place int")
    w = Window.partitionBy("shingle").orderBy("n", "set_key")
    shared = written(
        firsts.withColumn("before", F.lag("set_key").over(w)).withColumn("after", F.lead("set_key").over(w))
        .where("before != set_key or after != set_key"), "near-shared")
    golay = golay_pairs(bits)
    beside = shared.where("before != set_key").select(F.least("before", "set_key").alias("a"), F.greatest("before", "set_key").alias("b"))
    first = _verified(_pairs(beside.unionByName(golay).distinct(), bits), rows, "near-1")
    dropped(golay)
    joined = components(first, "near-cc-1")
    rest = written(
        shared.select("shingle", "set_key", "place").distinct().join(bits.drop("fp", "wide"), "set_key").join(joined.withColumnRenamed("node", "set_key"), "set_key", "left")
        .withColumn("group", F.coalesce("component", "set_key")).drop("component"), "near-rest")
    dropped(shared)
    # where all are joined by now there is nothing to compare
    mixed = rest.groupBy("shingle").agg(F.min("group").alias("g"), F.max("group").alias("h")).where("g != h").select("shingle")
    rest = rest.join(mixed, "shingle", "left_semi")
    left = [F.col(f"{x}.n") - F.col(f"{x}.place") for x in ("x", "y")]
    # sets of similarity 0.8 have sizes of one band or of neighbouring ones: the smaller of a pair meets its own and the next
    rest = rest.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.26))).cast("int"))
    larger = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.set_key") < F.col("y.set_key")))
    meet = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.band") == F.col("y.band")) & larger & (F.col("x.group") != F.col("y.group"))
    meet = meet & (9 * F.least(*left) >= 4 * (F.col("x.n") + F.col("y.n"))) & _may("x", "y")
    upward = rest.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    left_over = upward.alias("x").join(rest.alias("y"), meet).select(F.least("x.set_key", "y.set_key").alias("a"), F.greatest("x.set_key", "y.set_key").alias("b")).distinct()
    second = _verified(_pairs(left_over, bits), rows, "near-2")
    return first.unionByName(second)


def near_copy_groups(rows: DataFrame) -> DataFrame:
    """``row`` (unique), ``doc_id, text`` -> ``row, doc_id, text_hash, group`` of every row; a group is what links of similarity 0.8 join."""
    made = rows.select("row", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    digests = written(made.mapInArrow(_sets, f"row long, doc_id long, text_hash long, digest binary, n int, fp long, {', '.join(f'{c} long' for c in PARITIES)}, wide binary"), "near-digests")
    least = digests.groupBy("digest").agg(F.min("row").alias("set_key"))
    sets = written(digests.select("row", "doc_id", "text_hash", "digest").join(least, "digest").drop("digest"), "near-sets")
    own = sets.where("row = set_key").select("row")
    bits = written(digests.join(own, "row", "left_semi").select(F.col("row").alias("set_key"), "n", "fp", *PARITIES, "wide"), "near-bits")
    dropped(digests)
    texts = rows.join(own, "row", "left_semi").select(F.col("row").alias("set_key"), "text")
    groups = components(set_links(texts, bits), "near-cc-2").withColumnRenamed("node", "set_key")
    out = written(sets.join(groups, "set_key", "left").select("row", "doc_id", "text_hash", F.coalesce("component", "set_key").alias("group")), "near-groups")
    dropped(sets, bits)
    return out


def keep_one_of_near_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near copies, all columns kept: of the smallest doc_id, and of its rows the one of least text hash. Nulls come last."""
    name = "row"
    while name in docs.columns:
        name += "_"
    numbered = written(docs.withColumn(name, F.monotonically_increasing_id()), "near-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "row"))
    rows = numbered.select(F.col(name).alias("row"), "doc_id", "text")
    kept = written(near_copy_groups(rows).groupBy("group").agg(first.alias("k")).select(F.col("k.row").alias(name)), "near-keep")
    return numbered.join(kept, name, "left_semi").drop(name)
