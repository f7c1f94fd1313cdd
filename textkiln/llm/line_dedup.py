"""Exact line dedup over all documents that moves hashes and bitmaps, never text.

Each kept-length line gives (128-bit BLAKE2b of its key, document, position). The rows are range-
partitioned and sorted by (hash, document, position), so a line held by a third of all documents
spreads over many partitions. One streaming pass a partition sees first occurrences; what the first
document of a partition's first hash depends on is settled against the partitions' tails, of which
there is one each. The result is one compressed keep bitmap for each document that loses a line.

Defined results: a null or empty text is one empty line. Rows that share a doc_id are one document
for the rule "smallest doc_id"; each row keeps its own bitmap. A null doc_id counts as the largest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.llm.arrow import bounded, small
from textkiln.llm.tables import written

LEAST = 10
_LAST = (1 << 63) - 1


def _row() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))


def _text_key() -> Column:
    t = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(t, F.octet_length(t))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        keys, ds, rids, at = [], [], [], []
        for d, rid, text in zip(b["d"].to_pylist(), b["rid"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
            for i, line in enumerate((text or b"").split(b"\n")):
                k = line.strip().lower()
                if len(k) >= LEAST and (k.isascii() or len(k.decode("utf-8", "replace")) >= LEAST):
                    keys.append(hashlib.blake2b(k, digest_size=16).digest())
                    ds.append(d)
                    rids.append(rid)
                    at.append(i)
        h = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ds, pa.int64()), pa.array(rids, pa.int64()), pa.array(at, pa.int32())], ["hi", "lo", "d", "rid", "pos"])


_FOUND = "kind int, part int, hi long, lo long, d long, rid long, pos int"


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows known to go (kind 0), rows that an earlier partition decides (1), and the partition's tail (2)."""
    part = TaskContext.get().partitionId()
    hash_, first, head = None, None, None

    def out(kind: int, hi, lo, d, rid, pos) -> pa.RecordBatch:
        n = len(hi)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)), *(pa.array(np.asarray(x)) for x in (hi, lo, d, rid)), pa.array(np.asarray(pos, np.int32))], ["kind", "part", "hi", "lo", "d", "rid", "pos"])

    for b in batches:
        if not b.num_rows:
            continue
        hi, lo, d, rid, pos = (b[c].to_numpy() for c in ("hi", "lo", "d", "rid", "pos"))
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        if hash_ is not None:
            new[0] = (hi[0], lo[0]) != hash_
        start = np.maximum.accumulate(np.where(new, np.arange(len(hi)), -1))
        least = np.where(start >= 0, d[np.maximum(start, 0)], first if first is not None else 0)
        if head is None:
            head = (hi[0], lo[0], d[0])
        gone = d != least
        if gone.any():
            yield out(0, hi[gone], lo[gone], d[gone], rid[gone], pos[gone])
        open_ = (hi == head[0]) & (lo == head[1]) & (d == head[2])
        if open_.any():
            yield out(1, hi[open_], lo[open_], d[open_], rid[open_], pos[open_])
        hash_, first = (hi[-1], lo[-1]), least[-1]
    if hash_ is not None:
        yield out(2, [hash_[0]], [hash_[1]], [first], [0], [0])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep bits (1: stays) up to the last line that goes, packed little-endian and deflated."""
    def one(at: np.ndarray) -> bytes:
        keep = np.ones(int(at.max()) + 1, np.uint8)
        keep[at] = 0
        return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6)

    for b in batches:
        at = [np.array(x, np.int64) for x in b["gone"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["d"], b["rid"], pa.array([int(x.max()) + 1 for x in at], pa.int32()), pa.array([one(x) for x in at], pa.binary())], ["d", "rid", "upto", "bitmap"])


def keep_bits(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines, bitorder="little").astype(bool)


def line_bitmaps(docs: DataFrame) -> DataFrame:
    """``d, rid, upto, bitmap`` of every document row that loses a line (``d``: doc_id; ``rid``: hash of the row's text)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = written(docs.select(_row().alias("d"), _text_key().alias("rid"), "text").mapInArrow(_hashed, "hi long, lo long, d long, rid long, pos int"), "lines")
    order = ("hi", "lo", "d", "pos")
    found = written(lines.repartitionByRange(n, *order, "rid").sortWithinPartitions(*order).mapInArrow(_first_seen, _FOUND), "lines-seen")
    # one row for each partition
    tails = F.broadcast(found.where("kind = 2").select(F.col("hi").alias("thi"), F.col("lo").alias("tlo"), F.col("d").alias("td"), F.col("part").alias("tp")))
    heads = found.where("kind = 1").join(tails, (F.col("hi") == F.col("thi")) & (F.col("lo") == F.col("tlo")) & (F.col("td") < F.col("d")) & (F.col("tp") < F.col("part")), "left_semi")
    gone = found.where("kind = 0").unionByName(heads).groupBy("d", "rid").agg(F.collect_set("pos").alias("gone"))
    return gone.mapInArrow(_bitmaps, "d long, rid long, upto int, bitmap binary")


def with_bitmaps(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__bitmap`` and ``__upto`` (null: every line stays; lines past ``__upto`` stay too)."""
    maps = written(line_bitmaps(docs), "lines-bitmaps").select(F.col("d").alias("__d"), F.col("rid").alias("__rid"), F.col("bitmap").alias("__bitmap"), F.col("upto").alias("__upto"))
    return docs.join(maps, (_row() == F.col("__d")) & (_text_key() == F.col("__rid")), "left").drop("__d", "__rid")


def kept_lines(text: bytes | None, bitmap: bytes | None, upto: int | None) -> tuple[int, int, bytes]:
    """Lines before, lines dropped, and what is left of one text."""
    text = text or b""
    if bitmap is None:
        return text.count(b"\n") + 1, 0, text
    lines = text.split(b"\n")
    keep = keep_bits(bitmap, upto)
    left = [x for i, x in enumerate(lines) if i >= upto or keep[i]]
    return len(lines), len(lines) - len(left), b"\n".join(left)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines removed from ``text``; texts that lose nothing stay as they are, null included."""
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts = [t if m is None else kept_lines(t.encode(), m, u)[2].decode() for t, m, u in zip(b["text"].to_pylist(), b["__bitmap"].to_pylist(), b["__upto"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if f == "text" else b[f] for f in schema.names], schema.names)

    return with_bitmaps(bounded(docs)).mapInArrow(cut, schema)


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            rows = [kept_lines(*x) for x in zip(b["text"].cast(pa.binary()).to_pylist(), b["__bitmap"].to_pylist(), b["__upto"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return with_bitmaps(bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
