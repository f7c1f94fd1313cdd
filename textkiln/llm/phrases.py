"""Phrases of two and three words that occur together more than their parts let expect, mined by pivot partitioning.

1. A task interns the words of its texts in chunks: a chunk is one row of word numbers and one row for each of its distinct
   words with its count. Counts meet by (language, word); words of ``least`` occurrences or more get global numbers from the
   most frequent to the rarest, by prefix sums over ranges, and go back to the chunks that hold them.
2. An n-gram belongs to its pivot, its rarest word (the leftmost of equal ones), so exactly one place of a text gives it.
   Each place is rewritten to a fragment: the word and up to two neighbours on each side, cut at the first that is
   infrequent or rarer than the pivot. Equal fragments of a chunk are counted, and travel packed in blocks by bucket of pivots.
3. A bucket mines its fragments and emits the n-grams that hold their pivot, with counts. Every occurrence is there, so what
   is below ``least`` ends here. A bucket with more n-grams than a task may hold sends them on in parts, which are summed.
4. Scores, cuts and the covering rule are joins of these counts.

Frequent words have few fragments (their neighbours must be more frequent still) and rare ones few places, so a word that
a third of all rows hold makes no large group. Nothing is broadcast or collected but one count.

Defined results: a null ``lang`` is ``und``, a null text is empty, repeated rows count as often as they occur, other columns
are not read. Texts are whole; an empty table gives no rows. Phrases that agree in score and count are in byte order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.arrow import small
from textkiln.llm.prefix import running_totals
from textkiln.llm.tables import dropped, written

LEAST = 10
TOP = 2000
#: Per cent of a phrase's occurrences that a longer phrase must have to replace it.
COVER = 50
#: Words of a chunk; a longer text is a chunk of its own.
CHUNK = 1 << 20
#: Rows of n-grams that a mining task holds.
HOLD = 1 << 21
_BREAK = b"."
_BYTES = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNKS = "chunk long, tokens binary, lang string, word string, local int, n long"


def pieces(text: bytes) -> list[bytes]:
    """Lower-cased words, with ``_BREAK``, which no word can be, where a piece ends."""
    return text.translate(_BYTES).replace(b"\n", b" . ").split()


def _interned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a task: a row of local word numbers (-1: a piece ends), then a row for each word."""
    number = TaskContext.get().partitionId() << 33
    ids, fresh, held, size = {}, count(), [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate(held)
        times = np.bincount(tokens[tokens >= 0])
        none = lambda kind: pa.nulls(1, kind)
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([tokens.tobytes()], pa.binary()), none(pa.string()), none(pa.string()), none(pa.int32()), none(pa.int64())], ["chunk", "tokens", "lang", "word", "local", "n"])
        for lang, words in ids.items():
            del words[_BREAK]
            local = np.fromiter(words.values(), np.int32, len(words))
            whole = pa.RecordBatch.from_arrays([
                pa.array(np.full(len(words), number)), pa.nulls(len(words), pa.binary()), pa.array([lang] * len(words), pa.string()),
                pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(local), pa.array(times[local])], ["chunk", "tokens", "lang", "word", "local", "n"])
            yield from small(iter([whole]), 1 << 14)

    for b in small(batches):
        for lang, text in zip(b["lang"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
            if not (words := pieces(text or b"")):
                continue
            if lang not in ids:
                ids[lang] = defaultdict(fresh.__next__, {_BREAK: -1})
            held.append(np.fromiter(map(ids[lang].__getitem__, words), np.int32, len(words)))
            held.append(np.array([-1], np.int32))
            size += len(words)
            if size >= CHUNK:
                yield from flush()
                ids, fresh, held, size = {}, count(), [], 0
                number += 1
    if held:
        yield from flush()


def _mixed(*columns: np.ndarray) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint32)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def fragments(words: np.ndarray) -> list[np.ndarray]:
    """Places of a number sequence (-1: no frequent word) as pivots: second and first word to the left, pivot, first and second to the right.

    A blank is -1. A left neighbour must be more frequent than the pivot (less, as a number), a right one as frequent at least, so
    the leftmost of equal pivots owns an n-gram.
    """
    n = len(words)
    padded = np.full(n + 4, -1, np.int32)
    padded[2:-2] = words
    l2, l1, p, r1, r2 = (padded[i:i + n] for i in range(5))
    left = (l1 >= 0) & (l1 < p)
    right = (r1 >= 0) & (r1 <= p)
    at = np.flatnonzero((left | right) & (p >= 0))
    l2, l1, p, r1, r2, left, right = (x[at] for x in (l2, l1, p, r1, r2, left, right))
    return [np.where(left & (l2 < p), l2, -1), np.where(left, l1, -1), p, np.where(right, r1, -1), np.where(right & (r2 <= p), r2, -1)]


def _packed(columns: list[np.ndarray], cuts: np.ndarray) -> list[pa.Array]:
    """Slices of each column as bytes, the four bytes of a number apart, so that they compress."""
    return [pa.array([c[a:b].astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()) for c in columns]


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


_BLOCK = "bucket int, l2 binary, l1 binary, p binary, r1 binary, r2 binary, n binary"


def _blocks(buckets: int):
    """Fragments of each chunk, equal ones counted, in one block for each bucket of pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1):
            tokens = np.frombuffer(b["tokens"][0].as_py(), np.int32)
            pairs = b["ids"][0].values.to_numpy()
            name = np.full(int(tokens.max(initial=0)) + 2, -1, np.int32)  # the last is a break's
            name[pairs >> 32] = pairs & 0xFFFFFFFF
            found = fragments(name[tokens])
            if not len(found[2]):
                continue
            bucket = (_mixed(found[2]) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket << np.uint64(48) | (found[2].astype(np.uint64) & np.uint64(0xFFFF)) << np.uint64(32) | _mixed(*found) >> np.uint64(32))
            found, bucket = [c[order] for c in found], bucket[order]
            new = np.ones(len(order), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in found])
            first = np.flatnonzero(new)
            found, bucket, times = [c[first] for c in found], bucket[first], np.diff(np.append(first, len(order)))
            cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(first))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), *_packed([*found, times], cuts)], ["bucket", "l2", "l1", "p", "r1", "r2", "n"])

    return run


def summed(grams: list[np.ndarray]) -> list[np.ndarray]:
    """Distinct rows of the first three columns with the sum of the fourth."""
    a, b, c, n = grams
    if not len(a):
        return grams
    h = _mixed(a, b, c)
    order = np.argsort(h)
    new = np.ones(len(a), bool)

    def apart() -> np.ndarray:
        return np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in (a, b, c)])

    new[1:] = apart()
    if (new[1:] & (h[order[1:]] == h[order[:-1]])).any():  # two grams of one hash may lie mixed
        order = np.lexsort((c, b, a))
        new[1:] = apart()
    first = np.flatnonzero(new)
    at = order[first]
    return [a[at], b[at], c[at], np.add.reduceat(n[order], first)]


def owned(l2: np.ndarray, l1: np.ndarray, p: np.ndarray, r1: np.ndarray, r2: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """n-grams of fragments that hold the pivot: three words (-1: only two) and the count."""
    none = np.full(len(p), -1, np.int32)
    parts = [(l1 >= 0, (l1, p, none)), (r1 >= 0, (p, r1, none)), (l2 >= 0, (l2, l1, p)), ((l1 >= 0) & (r1 >= 0), (l1, p, r1)), (r2 >= 0, (p, r1, r2))]
    return [*(np.concatenate([words[i][on] for on, words in parts]) for i in range(3)), np.concatenate([n[on] for on, _ in parts]).astype(np.int64)]


def _mined(least: int, hold: int):
    """Counts of the n-grams that a bucket's pivots own; whole, or in parts where they are more than a task holds."""
    def out(grams: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in grams], ["a", "b", "c", "n"])

    def joined(held: list[list[np.ndarray]]) -> list[np.ndarray]:
        return summed([np.concatenate(x) for x in zip(*held)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, size, parts = None, [], 0, False

        def end() -> Iterator[pa.RecordBatch]:
            if held:
                grams = joined(held)
                yield out(grams if parts else [x[grams[3] >= least] for x in grams])

        for b in small(batches, 16):
            columns = [b[c].to_pylist() for c in ("bucket", "l2", "l1", "p", "r1", "r2", "n")]
            for k, *packed in zip(*columns):
                if k != bucket:
                    yield from end()
                    bucket, held, size, parts = k, [], 0, False
                grams = owned(*map(_unpacked, packed))
                held.append(grams)
                size += len(grams[0])
                if size >= hold:
                    held = [joined(held)]
                    size = len(held[0][0])
                    if 2 * size >= hold:
                        yield out(held[0])
                        held, size, parts = [], 0, True
        yield from end()

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, hold: int = HOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: frequent words (``id, lang, word, n``), phrases of ids (``a, b, c, n``; c is -1 for two words), and words of each language (``lang, total``)."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = written(read.mapInArrow(_interned, _CHUNKS), "phrases-chunks")
    words = chunks.where("word IS NOT NULL")
    counted = written(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrases-words")
    totals = written(counted.groupBy("lang").agg(F.sum("n").alias("total")), "phrases-totals")
    often = counted.where(F.col("n") >= least).withColumn("less", -F.col("n"))
    vocabulary = written(running_totals(often, ["less", "lang", "word"], "n", label="phrases-order").select(F.col("index").alias("id"), "lang", "word", "n"), "phrases-vocabulary")
    dropped(counted)
    places = vocabulary.agg(F.sum("n")).first()[0] or 0
    buckets = min(4096, max(4 * tasks, places * 4 // hold))
    named = words.join(vocabulary.select("id", "lang", "word"), ["lang", "word"]).groupBy("chunk").agg(F.collect_list(F.shiftleft(F.col("local").cast("long"), 32) + F.col("id")).alias("ids"))
    sequences = chunks.where("tokens IS NOT NULL").select("chunk", "tokens").join(named, "chunk").select("tokens", "ids")
    blocks = sequences.mapInArrow(_blocks(buckets), _BLOCK).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    mined = written(blocks.mapInArrow(_mined(least, hold), "a int, b int, c int, n long"), "phrases-mined")
    dropped(chunks)
    grams = written(mined.groupBy("a", "b", "c").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "phrases")
    dropped(mined)
    return vocabulary, grams, totals


def _score(n: str, left: str, right: str) -> Column:
    """floor(1000000 n n / (left right)), in integers of 38 digits."""
    big = lambda c: F.col(c).cast("decimal(15,0)")
    top, bottom = F.lit(1_000_000).cast("decimal(7,0)") * big(n) * big(n), big(left) * big(right)
    return F.call_function("div", top, bottom)


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, cover: int = COVER, hold: int = HOLD) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by score, count and bytes."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vocabulary, grams, totals = phrase_counts(docs, least, hold)
    pairs, triples = grams.where("c < 0").select("a", "b", "n"), grams.where("c >= 0")

    def words(of: str) -> DataFrame:
        return vocabulary.select(F.col("id").cast("int").alias(of), F.col("word").alias(f"w{of}"), F.col("n").alias(f"n{of}"), *([F.col("lang")] if of == "a" else []))

    # two words: one cut, unless a longer phrase has most of the occurrences
    longer = triples.select("a", "b", "n").unionByName(triples.select(F.col("b").alias("a"), F.col("c").alias("b"), "n")).groupBy("a", "b").agg(F.max("n").alias("longer"))
    two = (
        pairs.join(longer, ["a", "b"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("n"))).drop("longer").join(words("a"), "a").join(words("b"), "b")
        .select("lang", F.concat_ws(" ", "wa", "wb").alias("phrase"), F.col("n").alias("a"), F.col("na").alias("l"), F.col("nb").alias("r"), _score("n", "na", "nb").alias("score"))
    )
    # three words: the cut of lower score, the first of equal ones
    three = (
        triples.join(pairs.withColumnRenamed("n", "nab"), ["a", "b"]).join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("nbc")), ["b", "c"])
        .join(words("a"), "a").join(words("b"), "b").join(words("c"), "c")
        .withColumns({"s1": _score("n", "na", "nbc"), "s2": _score("n", "nab", "nc")})
        .withColumn("first", F.col("s1") <= F.col("s2"))
        .select("lang", F.concat_ws(" ", "wa", "wb", "wc").alias("phrase"), F.col("n").alias("a"), F.when(F.col("first"), F.col("na")).otherwise(F.col("nab")).alias("l"),
                F.when(F.col("first"), F.col("nbc")).otherwise(F.col("nc")).alias("r"), F.least("s1", "s2").alias("score"))
    )
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # parts of a language first, so that no task sorts all its phrases
    parted = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(tasks)))
    some = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top).drop("part")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
