"""Where references of a text are in a later version of it, from which parts were masked, moved or repeated.

Two versions are aligned by word sequences that each holds once, and by the longest run of these that keeps its order. Between two
neighbouring anchors of that run the occurrences of a reference's text are matched by their number, so repeated texts find their own place; a
text that left its place is looked for everywhere else. A document's two bodies and its references meet in one row, and are worked on whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of an anchor.
GRAM = 4


def _once(body: str) -> dict[tuple[str, ...], int]:
    """Word sequences that a body holds once, and the character where each begins."""
    found = [(m[0], m.start()) for m in re.finditer(r"\S+", body)]
    grams = [(tuple(w for w, _ in found[i:i + GRAM]), found[i][1]) for i in range(len(found) - GRAM + 1)]
    n = Counter(g for g, _ in grams)
    return {g: at for g, at in grams if n[g] == 1}


def anchors(old: str, new: str) -> list[tuple[int, int]]:
    """Places (old, new) of common sequences, the most that rise in both bodies."""
    there = _once(new)
    pairs = [(a, there[g]) for g, a in _once(old).items() if g in there]
    # the longest rising subsequence: the least end of one of each length, and what each place follows
    ends, last, before = [], [], []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(ends, b)
        ends[k:k + 1], last[k:k + 1] = [b], [i]
        before.append(last[k - 1] if k else -1)
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def _places(text: str, body: str, lo: int, hi: int) -> list[int]:
    """Where a text begins in body[lo:hi], overlaps included."""
    out, at = [], body.find(text, lo, hi)
    while at >= 0:
        out.append(at)
        at = body.find(text, at + 1, hi)
    return out


def relocate(old: str, new: str, spans: list[tuple[int, int]]) -> list[tuple[int | None, str]]:
    """New start and ``kept``, ``moved``, ``ambiguous`` or ``vanished`` of each span (start, end) of ``old``; one outside it is an ``error``."""
    run = anchors(old, new)
    olds, news = [a for a, _ in run], [b for _, b in run]
    out: list[tuple[int | None, str]] = []
    for start, end in spans:
        if not 0 <= start < end <= len(old):
            out.append((None, "error"))
            continue
        text = old[start:end]
        # anchors at or before the start, and at or after the end
        i, j = bisect_right(olds, start) - 1, bisect_left(olds, end)
        a, b = (olds[i], news[i]) if i >= 0 else (0, 0)
        c, d = (olds[j], news[j]) if j < len(olds) else (len(old), len(new))
        mine, theirs = _places(text, old, a, c), _places(text, new, b, d)
        if len(mine) == len(theirs):
            out.append((theirs[mine.index(start)], "kept"))
            continue
        if theirs:
            out.append((None, "ambiguous"))
            continue
        elsewhere = _places(text, new, 0, len(new))
        # places that other references of the old body have don't count as this one's
        others = len(_places(text, old, 0, len(old))) - 1
        out.append((elsewhere[0], "moved") if len(elsewhere) == 1 and not others else (None, "ambiguous" if len(elsewhere) > others else "vanished"))
    return out


def relocated(before: DataFrame, after: DataFrame, references: DataFrame, key: str, body: str) -> DataFrame:
    """``key, start, end, new_start, outcome`` of ``references`` (key, start, end); a document without a later version has lost all of its.

    ``before`` and ``after`` hold one row for each key.
    """
    refs = references.select(key, "start", "end").groupBy(key).agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))).alias("refs"))
    rows = before.select(key, F.coalesce(body, F.lit("")).alias("old")).join(after.select(key, F.coalesce(body, F.lit("")).alias("new")), key, "left").join(refs, key)
    names = [key, "start", "end", "new_start", "outcome"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, old, new, held in zip(b[key], b["old"].to_pylist(), b["new"].to_pylist(), b["refs"].to_pylist()):
                spans = [(r["start"], r["end"]) for r in held]
                found = relocate(old, new or "", spans)
                yield pa.RecordBatch.from_arrays([
                    pa.array([k.as_py()] * len(spans), k.type), pa.array([s for s, _ in spans], pa.int64()), pa.array([e for _, e in spans], pa.int64()),
                    pa.array([p for p, _ in found], pa.int64()), pa.array([o for _, o in found], pa.string())], names)

    return rows.mapInArrow(run, T.StructType([rows.schema[key], *[T.StructField(c, T.LongType()) for c in names[1:4]], T.StructField("outcome", T.StringType())]))
