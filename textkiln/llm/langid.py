"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased, runs of other characters become one space, and the 1- to 3-grams of code
points are hashed to ``DIMS`` columns. Document frequencies come from every training document. The
classifier is fitted on a bounded sample (``PER_LANGUAGE`` texts a language, least by hash) with
follow-the-regularised-leader updates and elastic-net (L1 and L2) penalties, whose L1 part leaves a
sparse weight table. A part of the sample that isn't fitted sets the temperature of the scores.

Defined results: ``und`` with score 0 where a text is null, has no letter, or nothing was learned.
Texts are read whole, whatever their length. Rows with a null or blank language teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.arrow import bounded, small

DIMS = 1 << 14
#: Bound of the fitted sample: at most this many texts of each language, and languages.
PER_LANGUAGE = 400
MAX_LANGUAGES = 500
UNKNOWN = "und"
CHUNK = 1 << 18


@lru_cache(1)
def _folded() -> np.ndarray:
    """Lower-case code point of each letter or mark; 32 for all else."""
    out = np.full(sys.maxunicode + 1, 32, np.int32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _grams(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None if it has no letter."""
    c = _folded()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    space = c == 32
    if space.all():
        return None
    keep = np.ones(len(c), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    c = np.concatenate(([32], c[keep], [32])).astype(np.uint32)
    out = np.zeros(DIMS, np.int64)
    for s in range(0, len(c), CHUNK):
        x = c[s:s + CHUNK + 2]
        h1 = x * np.uint32(0x9E3779B1)
        h2 = (h1[:-1] ^ (x[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
        h3 = (h2[:-1] ^ (x[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        n = min(CHUNK, len(c) - s)
        for h in (h1[:n], h2[:n], h3[:n]):
            out += np.bincount(h >> np.uint32(32 - 14), minlength=DIMS)
    return out


def _tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    v = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((v * v).sum())
    return at, v / norm if norm else v


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # [DIMS, languages]
    temperature: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        at, v = _tfidf(counts, self.idf)
        z = v @ self.weights[at] / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each column, and documents with a letter, over all rows of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, np.int64), 0
        for b in small(batches):
            for t in b["text"].to_pylist():
                if t and (g := _grams(t)) is not None:
                    df += g > 0
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], n))], ["gram", "n"])

    sums = bounded(docs).select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # at most DIMS + 1 rows
    df, n = np.zeros(DIMS, np.int64), 0
    for r in sums:
        if r["gram"] < 0:
            n = r["n"]
        else:
            df[r["gram"]] = r["n"]
    return df, n


def _sample(docs: DataFrame, per_language: int) -> list[tuple[str, np.ndarray, np.ndarray, int]]:
    """(language, columns, counts, hash) of the ``per_language`` texts of each language whose hash of id and text is least; no more, at any size."""
    first = Window.partitionBy("lang").orderBy("h")
    keyed = docs.withColumn("h", F.xxhash64(F.lit("langid"), F.col("doc_id").cast("string"), "text"))
    # tasks send on no more than the first rows of each language
    ends = keyed.select("lang", "h").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).groupBy("lang").agg(F.max("h").alias("end"))
    cuts = {r["lang"]: r["end"] for r in ends.limit(MAX_LANGUAGES + 1).collect()}
    if len(cuts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not cuts:
        return []
    within = F.col("h") <= F.element_at(F.create_map(*[F.lit(x) for kv in cuts.items() for x in kv]), F.col("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            rows = [(lang, g, h) for lang, t, h in zip(b["lang"].to_pylist(), b["text"].to_pylist(), b["h"].to_pylist()) if t and (g := _grams(t)) is not None]
            at = [np.flatnonzero(g) for _, g, _ in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())), pa.array([r[1][a].astype(np.int32) for r, a in zip(rows, at)], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.int64())], ["lang", "at", "n", "h"])

    # equal rows have equal hashes; of those only so many stay
    chosen = keyed.where(within).select("lang", "text", "h").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).select("lang", "text", "h")
    chosen = chosen.mapInArrow(run, "lang string, at array<int>, n array<int>, h long")
    rows = [(r["lang"], np.array(r["at"], np.int64), np.array(r["n"], np.int64), r["h"]) for r in chosen.collect()]
    return sorted(rows, key=lambda r: (r[3], r[0], len(r[1]), r[1].sum()))


def _ftrl(xs: list[tuple[np.ndarray, np.ndarray]], ys: list[int], k: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    z, n = np.zeros((DIMS, k)), np.zeros((DIMS, k))

    def weights(at) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for (at, v), y in zip(xs, ys):
            w = weights(at)
            s = v @ w
            e = np.exp(s - s.max())
            p = e / e.sum()
            p[y] -= 1
            g = v[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def _temperature(logits: np.ndarray, ys: np.ndarray) -> float:
    """Least cross-entropy over a grid of temperatures, against targets smoothed by one count a language
    (else texts that are all told apart would drive the temperature to zero)."""
    if not len(ys):
        return 1.0
    n, k = logits.shape
    target = np.full((n, k), 1 / (n + k))
    target[np.arange(n), ys] = (n + 1) / (n + k)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float((target * (np.log(np.exp(z).sum(axis=1, keepdims=True)) - z)).sum())

    return min(np.geomspace(0.02, 20, 151).tolist(), key=loss)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fits on rows of ``doc_id, text, lang``; None if no text with a letter has a language."""
    taught = docs.where("lang is not null and trim(lang) != '' and text is not null").select("doc_id", "text", "lang")
    sample = _sample(taught, per_language)
    if not sample:
        return None
    df, n = document_frequencies(taught)
    idf = np.log((1 + n) / (1 + df)) + 1
    languages = sorted({r[0] for r in sample})
    ys = [languages.index(r[0]) for r in sample]
    xs = []
    for _, at, c, _ in sample:
        v = (1 + np.log(c)) * idf[at]
        xs.append((at, v / np.sqrt((v * v).sum())))
    held = [i % 5 == 4 for i in range(len(xs))] if len(xs) >= 50 else [False] * len(xs)
    w = _ftrl([x for x, h in zip(xs, held) if not h], [y for y, h in zip(ys, held) if not h], len(languages))
    logits = np.array([v @ w[at] for (at, v), h in zip(xs, held) if h]).reshape(-1, len(languages))
    return Model(languages, idf, w.astype(np.float32), _temperature(logits, np.array([y for y, h in zip(ys, held) if h])))


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row; only ``text`` is looked at."""
    from pyspark.sql import types as T

    rows = bounded(docs).select(*keep, F.col("text").alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            said, score = [], []
            for t in b["__text"].to_pylist():
                g = _grams(t) if t and model else None
                if g is None:
                    said.append(UNKNOWN)
                    score.append(0.0)
                else:
                    p = model.scores(g)
                    said.append(model.languages[int(p.argmax())])
                    score.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(said, pa.string()), pa.array(score, pa.float64())], [*b.schema.names[:-1], "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
