"""Removal of repeated byte strings with a distributed difference-cover suffix sort.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller id. The
suffixes of the whole corpus are far more than a cluster should shuffle, so they are dealt out first,
without loss:

1. Every 50-byte window picks an anchor, its 20-gram of least hash: equal windows pick equal anchors
   at equal offsets. An anchor that one document alone holds can't lie in a repeated window. Anchors
   travel packed (hash, row, position) in binary blocks by hash bucket; a task that sees an anchor
   in two of its own documents settles that itself and sends the anchor once.
2. Rows that hold repeated anchors give, for each anchor, the stretch of text its windows span. A
   task keeps equal stretches once, under their smallest document; later ones are settled at once.
3. A bucket has all windows that any of its windows can equal. Its stretches are laid end to end and
   their suffixes sorted by difference cover: positions 1 and 2 modulo 3 are sorted by triples of
   eight-byte words and named; a second round sorts names of names (24 + 24 bytes and two more, the
   depth of a window, so the recursion ends there); positions 0 modulo 3 follow from one byte and
   their successor's rank; the three lists are merged by rank. Neighbours in suffix order whose
   50-byte prefixes agree form a class, and a window goes if its class has a smaller document.
4. What goes returns to its row as (first window, bits), and the row's bytes are cut.

Copies of a whole text follow from digests before all this: rows are ranged by (digest, id), so that only
the first document of each text (in each range) takes part.

Defined results: a null text is empty. Rows with one doc_id never remove each other's bytes. A null
doc_id counts as the largest. Texts shorter than a window stay whole. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.llm.arrow import bounded, small
from textkiln.llm.tables import dropped, written

WINDOW = 50
GRAM = 20
SPREAD = WINDOW - GRAM + 1  # anchors that a window can choose from
BUCKETS = 4  # a shuffle partition
_LAST = (1 << 63) - 1
_POS = np.uint64((1 << 26) - 1)
#: Bytes of text that are hashed at once.
CHUNK = 1 << 21


def _words8(b: np.ndarray) -> np.ndarray:
    """Big-endian value of the eight bytes from each position; ``b`` has eight or more bytes to spare."""
    w = b.astype(np.uint64)
    w = (w[:-1] << np.uint64(8)) | w[1:]
    w = (w[:-2] << np.uint64(16)) | w[2:]
    return (w[:-4] << np.uint64(32)) | w[4:]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text of at least ``WINDOW`` bytes: anchor positions, their hashes, first and last window of each."""
    n = len(text)
    at, hashes, first, last = [], [], [], []
    step = 1 << 25
    for s in range(0, n - WINDOW + 1, step):
        part = text[s:min(n, s + step + WINDOW - 1)]
        w = _words8(np.concatenate((part, np.zeros(8, np.uint8))))
        m = len(part) - GRAM + 1
        # bytes 0-7, 8-15 and 12-19 of the gram
        h = _mix(_mix(_mix(w[:m]) + w[8:8 + m]) + w[12:12 + m])
        least = (h & ~_POS) | np.arange(m, dtype=np.uint64)  # equal hashes: the leftmost
        for k in (1, 2, 4, 8, 15):  # minima over 2, 4, 8, 16 and 31
            least = np.minimum(least[:-k], least[k:])
        p = (least & _POS).astype(np.int64)
        lo = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        hi = np.concatenate((lo[1:], [len(p)])) - 1
        at.append(p[lo] + s)
        hashes.append(_mix(h[p[lo]] + np.uint64(1)))  # least hashes are small; mixed again they fill buckets evenly
        first.append(lo + s)
        last.append(hi + s)
    return tuple(np.concatenate(x) for x in (at, hashes, first, last))


_ROWS = "row long, d long, kind int, n long, text string"
_FIRST, _COPY, _SHORT = 0, 1, 2


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (digest, d): the first document of each text takes part, later ones are copies.

    A text that continues from the partition before has a first row here too, which only costs work.
    """
    part, count = TaskContext.get().partitionId() << 33, 0
    digest, first = None, None
    for b in small(batches):
        kinds, lengths = [], b["n"].to_pylist()
        for x, d, n in zip(b["digest"].to_pylist(), b["d"].to_pylist(), lengths):
            if x != digest:
                digest, first = x, d
            kinds.append(_FIRST if d == first else _COPY if n >= WINDOW else _SHORT)
        text = pa.array([None if k == _COPY else t for k, t in zip(kinds, b["text"].to_pylist())], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count, count + len(kinds)) + part), b["d"], pa.array(kinds, pa.int32()), b["n"], text], ["row", "d", "kind", "n", "text"])
        count += len(kinds)


def _several(key: np.ndarray, order: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each element in sorted order: does its key have two different rows?"""
    k, r = key[order], row[order]
    cut = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    two = np.minimum.reduceat(r, cut) != np.maximum.reduceat(r, cut)
    return np.repeat(two, np.diff(np.concatenate((cut, [len(k)]))))


def _anchor_blocks(n_buckets: int):
    """Task's anchors: those seen in two of its rows are settled (bucket -1), one of each goes out in blocks.

    A task flushes after ``FLUSH`` anchors, so its memory is bounded whatever its input.
    """
    FLUSH = 1 << 19

    def flush(h: np.ndarray, row: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(h, kind="stable")
        two = _several(h, order, row)
        h, row, pos = h[order], row[order], pos[order]
        if two.any():
            yield _blocks(np.array([-1]), np.array([0, two.sum()]), h[two], row[two], pos[two], two[two])
        # one of each settled anchor, every place of the others
        out = np.concatenate(([True], h[1:] != h[:-1])) | ~two
        h, row, pos, two = h[out], row[out], pos[out], two[out]
        bucket = (h >> np.uint64(32)).astype(np.int64) * n_buckets >> 32  # rises with the hash
        start = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        yield _blocks(bucket[start], np.concatenate((start, [len(h)])), h, row, pos, two)

    def _blocks(buckets, cuts, h, row, pos, two) -> pa.RecordBatch:
        def packed(x: np.ndarray, kind: str) -> pa.Array:
            raw, size = np.ascontiguousarray(x.astype(kind)).tobytes(), np.dtype(kind).itemsize
            return pa.Array.from_buffers(pa.binary(), len(buckets), [None, pa.py_buffer((cuts * size).astype(np.int32).tobytes()), pa.py_buffer(raw)])

        return pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), packed(h, "<u8"), packed(row, "<i8"), packed(pos, "<i4"), packed(two, "u1")], ["bucket", "h", "row", "pos", "two"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in small(batches):
            for row, t in zip(b["row"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
                if t and len(t) >= WINDOW:
                    at, h, _, _ = anchors(np.frombuffer(t, np.uint8))
                    held.append((h, np.full(len(h), row, np.int64), at.astype(np.int32)))
                    n += len(h)
            if n >= FLUSH:
                yield from flush(*(np.concatenate(x) for x in zip(*held)))
                held, n = [], 0
        if n:
            yield from flush(*(np.concatenate(x) for x in zip(*held)))

    return run


_BLOCK = "bucket int, h binary, row binary, pos binary, two binary"


def _by_bucket(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Columns of each bucket from rows sorted by bucket; a row of bucket -1 comes alone."""
    bucket, held = None, [[] for _ in names]
    for b in small(batches, 16):
        cols = [b[n].to_pylist() for n in names]
        for i, k in enumerate(b["bucket"].to_pylist()):
            if k != bucket or k < 0:
                if held[0]:
                    yield bucket, held
                bucket, held = k, [[] for _ in names]
            for h, c in zip(held, cols):
                h.append(c[i])
    if held[0]:
        yield bucket, held


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, pos`` of anchors that two rows hold."""
    for bucket, (h, row, pos, two) in _by_bucket(batches, ["h", "row", "pos", "two"]):
        h, row, pos, two = (np.frombuffer(b"".join(x), k) for x, k in ((h, "<u8"), (row, "<i8"), (pos, "<i4"), (two, "?")))
        if bucket >= 0:
            order = np.argsort(h, kind="stable")
            yes = _several(h, order, row)
            # settled ones are in the task's own block already
            at = order[yes & ~two[order]]
            row, pos = row[at], pos[at]
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(pos)], ["row", "pos"])


_STRETCH = "bucket int, row binary, d binary, lo binary, windows binary, off binary, size binary, bytes binary"
#: Bytes of distinct stretches that a reducer sorts at once; whole anchors go together, so one anchor's can be more.
PART = 1 << 20


def _stretches(n_buckets: int):
    """Stretches of flagged anchors in blocks by bucket; what the task can settle itself has bucket -1.

    A task holds stretches until they come to ``FLUSH`` bytes, then sends what it has.
    """
    FLUSH = 24 << 20

    def emit(found: dict[bytes, list], settled: list[tuple]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, tuple[list, list]] = {}
        for s, (k, d, places) in found.items():
            of, text = blocks.setdefault(k, ([], []))
            for row, lo in places:
                of.append((row, d, lo, len(s) - WINDOW, s[0]))  # the first byte is the anchor's offset
                text.append(s[1:])
        rows = [(k, of, text) for k, (of, text) in blocks.items()]
        if settled:
            rows.append((-1, settled, []))

        def column(i: int, kind: str) -> pa.Array:
            return pa.array([np.array([x[i] for x in r[1]], kind).tobytes() for r in rows], pa.binary())

        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), column(0, "<i8"), column(1, "<i8"), column(2, "<i4"), column(3, "u1"), column(4, "u1"),
            pa.array([bytes(map(len, r[2])) for r in rows], pa.binary()), pa.array([b"".join(r[2]) for r in rows], pa.binary())],
            ["bucket", "row", "d", "lo", "windows", "off", "size", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, list] = {}
        settled: list[tuple] = []
        size = 0
        for b in small(batches):
            for row, d, t, flags in zip(b["row"].to_pylist(), b["d"].to_pylist(), b["text"].cast(pa.binary()).to_pylist(), b["at"].to_pylist()):
                at, h, first, last = anchors(np.frombuffer(t, np.uint8))
                on = np.flatnonzero(np.isin(at, np.array(flags, np.int64)))
                bucket = ((h[on] >> np.uint64(32)).astype(np.int64) * n_buckets >> 32).tolist()
                for k, p, lo, hi in zip(bucket, at[on].tolist(), first[on].tolist(), last[on].tolist()):
                    s = bytes((p - lo,)) + t[lo:hi + WINDOW]
                    old = found.get(s)
                    if old is None:
                        found[s] = [k, d, [(row, lo)]]
                        size += len(s) + 200
                    elif d > old[1]:
                        settled.append((row, d, lo, hi - lo + 1, 0))
                        size += 100
                    elif d < old[1]:
                        settled += [(r, old[1], x, hi - lo + 1, 0) for r, x in old[2]]
                        old[1], old[2] = d, [(row, lo)]
                    else:
                        old[2].append((row, lo))
                        size += len(s)
            if size >= FLUSH:
                yield from emit(found, settled)
                found, settled, size = {}, [], 0
        if found or settled:
            yield from emit(found, settled)

    return run


def _names(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by several keys, and the dense rank of each element."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def sorted_suffixes(text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``wanted`` positions in the order of the ``WINDOW``-byte prefixes of their suffixes.

    ``text``: bytes with 80 zeros or more at the end. Difference cover {1, 2} modulo 3.
    """
    w = _words8(text)
    n = len(text) - 80
    need = np.zeros(n + 8, bool)
    need[wanted] = need[wanted + 1] = need[wanted + 2] = True
    second = np.flatnonzero(need)
    second = second[second % 3 != 0]
    # first round: triples of words name 24 bytes
    far = np.zeros(len(need) + 24, bool)
    far[second] = far[second + 24] = True
    first = np.flatnonzero(far)
    name = np.zeros(len(far), np.int64)
    name[first] = _names(w[first], w[first + 8], w[first + 16])[1]
    # second round: names of names, 50 bytes in all
    two = (text[second + 48].astype(np.int64) << 8) | text[second + 49]
    size = int(name.max(initial=0)) + 1
    if size < 1 << 23:
        keys = (((name[second] * size + name[second + 24]) << 16) | two,)
    else:
        keys = (name[second], name[second + 24], two)
    rank = np.zeros(n + 8, np.int64)
    rank[second] = _names(*keys)[1]
    top = int(rank.max(initial=0)) + 1
    zero, one, twos = (wanted[wanted % 3 == k] for k in (0, 1, 2))

    def by_one(p: np.ndarray) -> np.ndarray:
        return text[p].astype(np.int64) * top + rank[p + 1]

    def by_two(p: np.ndarray) -> np.ndarray:
        return (text[p].astype(np.int64) * 256 + text[p + 1]) * top + rank[p + 2]

    # the merge: a suffix of class 0 meets class 1 one byte on, class 2 two bytes on; 1 and 2 by rank
    zero = zero[np.argsort(by_one(zero), kind="stable")]
    sample = np.concatenate((one, twos))
    sample = sample[np.argsort(rank[sample], kind="stable")]
    ones, pairs = np.sort(by_one(one)), np.sort(by_two(twos))
    before = np.searchsorted(ones, by_one(zero)) + np.searchsorted(pairs, by_two(zero))
    # equal prefixes get equal places before they are told apart by more bytes, so keep the order of zero
    before = np.maximum.accumulate(before)
    out = np.empty(len(wanted), np.int64)
    at = before + np.arange(len(zero))
    mask = np.ones(len(out), bool)
    mask[at] = False
    out[at] = zero
    out[mask] = sample
    return out


def classes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Where a new class starts in ``order``: neighbours whose first ``WINDOW`` bytes differ."""
    w = _words8(text)
    new = np.ones(len(order), bool)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in (0, 8, 16, 24, 32, 40, 42):
        x = w[order + k]
        same &= x[1:] == x[:-1]
    new[1:] = ~same
    return new


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, lo, bits``: windows (bit j: the one at lo + j) that a smaller document holds too."""
    names = ["row", "d", "lo", "windows", "off", "size", "bytes"]
    for bucket, cols in _by_bucket(batches, names):
        row, d, lo, windows, off, size = (np.frombuffer(b"".join(x), k) for x, k in zip(cols, ("<i8", "<i8", "<i4", "u1", "u1", "u1")))
        windows = windows.astype(np.int64)
        if bucket < 0:
            yield _windows(row, lo, (np.int64(1) << windows) - 1)
            continue
        joined = b"".join(cols[6])
        ends = np.cumsum(size.astype(np.int64)).tolist()
        # parts by the anchor's gram: what can be equal stays together
        n_parts = 1 + len(joined) // PART
        parts: list[tuple[list[int], list[bytes]]] = [([], []) for _ in range(n_parts)]
        begin = 0
        for i, (end, o) in enumerate(zip(ends, off.tolist())):
            s = joined[begin:end]
            at, held = parts[hash(s[o:o + GRAM]) % n_parts]
            at.append(i)
            held.append(s)
            begin = end
        del joined, cols
        for at, held in parts:
            i = np.array(at, np.int64)
            if len(i) > 1 and (bits := _bits(held, d[i], windows[i])).any():
                go = bits != 0
                yield _windows(row[i[go]], lo[i[go]], bits[go])


def _windows(row: np.ndarray, lo: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(row), pa.array(lo), pa.array(bits.astype(np.int32))], ["row", "lo", "bits"])


def _bits(held: list[bytes], d: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each stretch, the windows that a stretch of a smaller document holds too."""
    seen: dict[bytes, int] = {}
    which = np.fromiter((seen.setdefault(s, len(seen)) for s in held), np.int64, len(held))
    least = np.full(len(seen), _LAST)
    np.minimum.at(least, which, d)
    # stretches end to end, three zeros between, so that what follows a window is defined
    text = np.frombuffer(bytes(3).join(seen) + bytes(100), np.uint8)
    lens = np.fromiter(map(len, seen), np.int64, len(seen))
    start = np.cumsum(lens + 3) - lens - 3
    count = lens - WINDOW + 1
    off = np.concatenate(([0], np.cumsum(count)))
    owner = np.repeat(np.arange(len(seen)), count)
    wanted = start[owner] + np.arange(off[-1]) - off[owner]
    order = sorted_suffixes(text, wanted)
    cut = np.flatnonzero(classes(text, order))
    number = np.empty(len(text), np.int32)
    number[wanted] = np.arange(len(wanted))
    index = number[order]
    low = np.minimum.reduceat(least[owner[index]], cut)
    of_window = np.empty(len(wanted), np.int64)
    of_window[index] = np.repeat(low, np.diff(np.concatenate((cut, [len(order)]))))
    bits = np.zeros(len(d), np.int64)
    for j in range(int(windows.max())):
        has = windows > j
        bits[has] |= (of_window[off[which[has]] + j] < d[has]).astype(np.int64) << j
    return bits


def removed_bytes(n: int, lo: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """True for bytes that a removed window covers."""
    edge = np.zeros(n + 1, np.int64)
    for j in range(SPREAD):
        p = lo[(bits >> j) & 1 == 1] + j
        np.add.at(edge, p, 1)
        np.add.at(edge, p + WINDOW, -1)
    return np.cumsum(edge)[:n] > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        spans, gone, left = [], [], []
        for t, lo, bits in zip(b["text"].cast(pa.binary()).to_pylist(), b["lo"].to_pylist(), b["bits"].to_pylist()):
            t = t or b""
            if lo:
                off = removed_bytes(len(t), np.array(lo, np.int64), np.array(bits, np.int64))
                gone.append(int(off.sum()))
                spans.append(int(off[0]) + int((off[1:] > off[:-1]).sum()))
                left.append(np.frombuffer(t, np.uint8)[~off].tobytes())
            else:
                gone.append(0)
                spans.append(0)
                left.append(t)
        yield pa.RecordBatch.from_arrays([b["d"], pa.array([len(t) + g for t, g in zip(left, gone)], pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(left, pa.binary())], ["d", "n_bytes", "n_removed", "n_spans", "kept"])


_RESULT = "d long, n_bytes long, n_removed long, n_spans long, kept binary"


def removed_windows(rows: DataFrame) -> DataFrame:
    """``row, d, text`` (written, ``row`` unique) -> ``row, lo, bits``."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = n * BUCKETS
    packed = rows.select("row", "text").mapInArrow(_anchor_blocks(k), _BLOCK)
    flags = written(packed.repartition(n, "bucket", F.when(F.col("bucket") < 0, F.xxhash64("row"))).sortWithinPartitions("bucket").mapInArrow(_repeated, "row long, pos int"), "suffix-anchors")
    flagged = flags.groupBy(F.col("row").alias("__row")).agg(F.collect_list("pos").alias("at"))
    stretches = rows.join(flagged, F.col("row") == F.col("__row")).select("row", "d", "text", "at").mapInArrow(_stretches(k), _STRETCH)
    out = written(stretches.repartition(n, "bucket", F.when(F.col("bucket") < 0, F.xxhash64("row"))).sortWithinPartitions("bucket").mapInArrow(_settled, "row long, lo int, bits int"), "suffix-windows")
    dropped(flags)
    return out


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``d`` (doc_id; null: the largest long), ``n_bytes, n_removed, n_spans, kept`` (bytes) of every row."""
    n = int(bounded(docs).sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = named.select("d", F.octet_length("text").cast("long").alias("n"), F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    # ranges of (digest, d) spread a text with many copies over partitions
    table = written(keyed.repartitionByRange(n, "digest", "d").sortWithinPartitions("digest", "d").mapInArrow(_firsts, _ROWS), "suffix-rows")
    rows = table.where(F.col("kind") == _FIRST).select("row", "d", "text")
    windows = removed_windows(rows).groupBy(F.col("row").alias("__row")).agg(F.collect_list("lo").alias("lo"), F.collect_list("bits").alias("bits"))
    cut = rows.join(windows, F.col("row") == F.col("__row"), "left").select("d", "text", "lo", "bits").mapInArrow(_cut, _RESULT)
    # a copy of WINDOW bytes or more goes whole; a shorter one stays
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    whole = table.where(F.col("kind") == _COPY).select("d", F.col("n").alias("n_bytes"), F.col("n").alias("n_removed"), one.alias("n_spans"), F.lit(b"").alias("kept"))
    short = table.where(F.col("kind") == _SHORT).select("d", F.col("n").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    return cut.unionByName(whole).unionByName(short)


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    return dedup_substrings(docs).select(
        F.when(F.col("d") != _LAST, F.col("d")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
