"""Maximal periodic runs of words, and texts with their repetitions collapsed.

Words are interned to numbers. A run of three periods or more holds no eight words that occur once only in their stretch, so
a text is first cut at such words (``stretches``; nearly nothing of plain prose stays). Each stretch is divided at its
middle after Main and Lorentz: a run that crosses the middle has its first or last period wholly on one side, so two
Z-functions, of the right half before the stretch and of the reversed left half before the reversed stretch, tell for every
period how far words agree on both sides of the middle. The halves follow in the same way. A part that a neighbouring word
extends belongs to a run that crosses an outer middle and was found there; of equal intervals the smallest period stays.

A document is worked on in its own task, whole, in time n log n and memory proportional to it; nothing is shuffled.

Defined results: a null or blank text has no words, no runs and an empty collapsed text. Rows are judged one by one, so
repeated rows and null ids need no rule; other columns pass through as they are.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.arrow import bounded, small
from textkiln.llm.words import words

#: Words and periods of the shortest run.
LEAST, TIMES = 24, 3
_GRAM = 8
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def z_function(s: list[int], upto: int) -> array:
    """For each place up to ``upto``, how many words from there agree with the beginning."""
    n = len(s)
    z = array("q", bytes(8 * upto))
    if upto:
        z[0] = n
    left = right = 0
    for i in range(1, upto):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _crossing(s: list[int], lo: int, hi: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """``start, end, period`` of repetitions of ``s[lo:hi]`` that cross its middle."""
    mid = (lo + hi) // 2
    n_left, n_right = mid - lo, hi - mid
    most = (hi - lo) // times
    part = s[lo:hi]
    # the right half, then the stretch: how far two places agree to the right, one of them the middle
    ahead = z_function(s[mid:hi] + [-1] + part, n_right + 1 + n_left)
    # the reversed left half, then the reversed stretch: how far they agree to the left
    behind = z_function(part[:n_left][::-1] + [-1] + part[::-1], n_left + 1 + n_right)
    for q in range(1, most + 1):
        if q < n_right:  # the middle and a period after it
            to_right, to_left = ahead[q], behind[n_left + 1 + n_right - q]
            if to_right + to_left >= (times - 1) * q and to_right + to_left + q >= least:
                yield mid - to_left, mid + q + to_right, q
        if q < n_left:  # a period before the middle, and the middle
            to_right, to_left = ahead[n_right + 1 + n_left - q], behind[q]
            if to_right + to_left >= (times - 1) * q and to_right + to_left + q >= least:
                yield mid - q - to_left, mid + to_right, q


def runs_of(s: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all maximal runs of ``s`` of ``least`` words and ``times`` periods or more, by start and period."""
    found: dict[tuple[int, int], int] = {}
    work = [(0, len(s))]
    while work:
        lo, hi = work.pop()
        if hi - lo < least:
            continue
        for a, b, q in _crossing(s, lo, hi, least, times):
            if (a and s[a - 1] == s[a - 1 + q]) or (b < len(s) and s[b] == s[b - q]):
                continue
            if q < found.get((a, b), q + 1):
                found[a, b] = q
        mid = (lo + hi) // 2
        work += [(lo, mid), (mid, hi)]
    return sorted((a, b - a, q) for (a, b), q in found.items())


def _repeated(s: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places of ``s`` (``_GRAM`` - 1 fewer) whose eight words occur again with the same owner, or seem to by their hash."""
    n = len(s) - _GRAM + 1
    h = s.astype(np.uint64) + np.uint64(1)
    for k in (1, 2, 4):
        h = h[:-k] * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + h[k:]
        h ^= h >> np.uint64(29)
    h = (h + owner[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    out = np.zeros(n, bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def stretches(s: np.ndarray, owner: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Maximal ``start, end`` of ``s`` within one owner that can hold a run: every eight words in them occur twice there."""
    if len(s) < _GRAM:
        return []
    spans = [(0, len(s))]
    while True:
        # places of all spans, end to end, each span its own owner
        at = np.concatenate([np.arange(a, b) for a, b in spans])
        own = owner[at] if len(spans) == 1 else np.repeat(np.arange(len(spans)), [b - a for a, b in spans])
        keep = _repeated(s[at], own)
        m = len(keep)
        keep &= own[:m] == own[_GRAM - 1:]
        parted = own[1:m] != own[:m - 1]
        first = np.flatnonzero(keep & np.concatenate(([True], ~keep[:-1] | parted)))
        last = np.flatnonzero(keep & np.concatenate((~keep[1:] | parted, [True])))
        new = [(int(x), int(y) + _GRAM) for x, y in zip(at[first], at[last]) if y + _GRAM - x >= least]
        # cutting is only to save work, so it ends once it saves little
        if not new or 10 * sum(b - a for a, b in new) > 9 * len(at):
            return new
        spans = new


def _found(least: int, times: int, names: list[str]):
    """Adds ``runs`` and ``collapsed`` to each row of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts = [(t or b"").split() for t in b["__text"].cast(pa.binary()).to_pylist()]
            ids = defaultdict(count().__next__)
            lengths = [len(t) for t in texts]
            s = np.fromiter(map(ids.__getitem__, chain.from_iterable(texts)), np.int64, sum(lengths))
            owner = np.repeat(np.arange(len(texts)), lengths)
            begin = np.concatenate(([0], np.cumsum(lengths)))
            runs: list[list[dict]] = [[] for _ in texts]
            for a, e in stretches(s, owner, least):
                d = int(owner[a])
                base = a - int(begin[d])
                runs[d] += [{"start": base + x, "length": n, "period": q} for x, n, q in runs_of(s[a:e].tolist(), least, times)]
            left = []
            for t, rs in zip(texts, runs):
                if rs:
                    go = np.zeros(len(t) + 1, np.int64)
                    for r in rs:
                        go[r["start"] + r["period"]] += 1
                        go[r["start"] + r["length"]] -= 1
                    t = [w for w, x in zip(t, np.cumsum(go).tolist()) if not x]
                left.append(b" ".join(t))
            arrays = [b[c] for c in b.schema.names if c != "__text"]
            kind = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in RUN.names]))
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(runs, kind), pa.array(left, pa.binary()).cast(pa.string())], names)

    return run


def periodic_runs(docs: DataFrame, text: str | Column = "text", keep: tuple[str, ...] = ("doc_id",), least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The columns ``keep`` of every row, with ``runs`` (array of start, length, period in words, by start and period) and ``collapsed``
    (the text's words, one blank between, without those that a run repeats)."""
    if least < 3 * _GRAM or times < 3:
        raise ValueError("runs have 24 words and three periods or more")
    read = bounded(docs).select(*keep, (F.col(text) if isinstance(text, str) else text).alias("__text"))
    schema = T.StructType([*(read.schema[c] for c in keep), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    return read.mapInArrow(_found(least, times, schema.names), schema)


def collapse_repetitions(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with each text that holds a run replaced by its collapsed form; other texts, null included, stay as they are."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index("text")
    out = periodic_runs(plain, f"c{at}", tuple(plain.columns), least, times)
    kept = [F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col(f"c{i}")) if i == at else F.col(f"c{i}") for i in range(len(names))]
    return out.select(*[c.alias(n) for c, n in zip(kept, names)])


def looped(text: Column, doc_id: Column) -> Column:
    """The text as the query's contract rereads it: one document in ten, by crc32 of its id, repeats a part of itself to its end."""
    div = lambda x, y: F.call_function("div", x, y)
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = div(h, F.lit(10))
    w = words(text)
    n = F.size(w).cast("long")
    a = g % F.nullif(n, F.lit(0).cast("long"))
    p = 1 + div(n - a, 3 + g % 8)
    whole = lambda x: x.cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(w, whole(a + 1), whole(p)), whole(div(n - a + p - 1, p)))), 1, whole(n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(w, 1, whole(a)), again), " ")).otherwise(text)


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_runs``, the run of greatest exponent (``start, length, period, exponent_milli``), ``runs_sha256, collapsed_sha256``."""
    found = periodic_runs(docs.withColumn("doc_id", F.col("doc_id").cast("long")), looped(F.col("text"), F.col("doc_id")))
    # length / period compared exactly, then the smallest start and period
    ahead = lambda x, y: F.when(x["length"] * y["period"] != y["length"] * x["period"], y["length"] * x["period"] - x["length"] * y["period"]).when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["period"] - y["period"])
    best = F.get(F.array_sort("runs", lambda x, y: F.signum(ahead(x, y)).cast("int")), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in RUN.names],
        F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
