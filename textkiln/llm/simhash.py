"""SimHash near-dedup with Golay-code fuzzy keys.

Fingerprints are 64 bits. They are cut into segments of 22, 21 and 21 bits; zeros fill each up to a
23-bit word of the perfect binary Golay code. A word within two bits of a codeword has that codeword
as its only key. A word at distance three also takes the five codewords at distance four: six keys.
Any two words that differ in at most two bits share a key (the five other codewords split the 20
remaining positions into five blocks of four; two errors in two blocks leave both at distance four).
Four errors over three segments leave two segments with at most two errors together, so every
linked pair shares a pair of keys of some two segments. Buckets are those key pairs; inside a
bucket fingerprints are compared bit by bit (verify) and only a spanning forest of the links goes
on, so a bucket of g equal-looking texts gives at most g - 1 edges.

Only distinct fingerprints take part; copies share one. A bucket costs eight bytes a fingerprint, and
its forest is searched without a matrix of all pairs.

Defined results: a text without words has fingerprint zero and links like any other; null texts
count as empty; fewer words than a shingle make one shingle; repeated rows link to each other;
null ids are kept and never name a component unless nothing else does.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.llm.arrow import small
from textkiln.llm.components import components
from textkiln.llm.tables import dropped, written

SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
MOST = 4
#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the binary Golay code.
GENERATOR = 0b110001110101


@lru_cache(1)
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainder of each word by syndrome table parts, and for each syndrome its leaders.

    Returns (syndromes of the low 12 bits, of the high 11 bits, leaders [2048, 6], number of leaders).
    """
    def rem(v: int) -> int:
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= GENERATOR << (i - 11)
        return v

    unit = [rem(1 << i) for i in range(23)]
    lead: dict[int, list[int]] = {0: [0]}
    from itertools import combinations

    def syn(bits: tuple[int, ...]) -> int:
        s = 0
        for i in bits:
            s ^= unit[i]
        return s

    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            lead.setdefault(syn(bits), []).append(sum(1 << i for i in bits))
    three = {s for s, v in lead.items() if bin(v[0]).count("1") == 3}
    for bits in combinations(range(23), 4):
        if (s := syn(bits)) in three:
            lead[s].append(sum(1 << i for i in bits))
    leaders, n = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for s, v in lead.items():
        leaders[s, :len(v)], n[s] = v, len(v)
    low = np.array([syn(tuple(i for i in range(12) if v >> i & 1)) for v in range(4096)])
    high = np.array([syn(tuple(12 + i for i in range(11) if v >> i & 1)) for v in range(2048)])
    return low, high, leaders, n


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (0..4095) of the codewords near each 23-bit word: [n, 6] and how many of the six count."""
    low, high, leaders, n = _code()
    s = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ leaders[s]) >> 11, n[s]  # the top 12 bits of a codeword are its information bits


def fingerprint(text: bytes | None, size: int = 4) -> int:
    w = (text or b"").lower().split()
    if not w:
        return 0
    if len(w) <= size:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(w), 42)], np.uint64)
    else:
        joined = b" ".join(w)
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
        starts = [0, *ends[:-(size)].tolist()]
        stops = (ends[size - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.fromiter([digest(joined[s:e], 42) for s, e in zip(starts, stops)], np.uint64, len(starts))
    return majority(h)


def majority(h: np.ndarray) -> int:
    """The 64 bits that more than half of some hashes have set; none for no hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(h)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's 64 bits as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            fps = [signed(fingerprint(t)) for t in b["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b["fp"].to_numpy()
        u = fp.view(np.uint64) if fp.dtype == np.int64 else fp.astype(np.int64).view(np.uint64)
        parts = [golay_keys(((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)) for at, n in SEGMENTS]
        for p, (i, j) in enumerate(PAIRS):
            (ki, ni), (kj, nj) = parts[i], parts[j]
            ok = ((np.arange(6)[None, :, None] < ni[:, None, None]) & (np.arange(6)[None, None, :] < nj[:, None, None])).reshape(len(u), 36)
            keys = ((p << 24) | (ki[:, :, None] << 12) | kj[:, None, :]).reshape(len(u), 36)
            yield pa.RecordBatch.from_arrays([pa.array(keys[ok].astype(np.int32)), pa.array(np.repeat(fp, ok.sum(axis=1)))], ["bucket", "fp"])


def _forest(fp: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints.

    A search from one fingerprint takes every one it links to out of what is left, so in a tight group
    of near copies few comparisons remain after the first, and memory is linear in any case.
    """
    edges = []
    left = np.arange(len(fp))
    while len(left) > 1:
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            i = frontier.pop()
            near = np.bitwise_count(fp[left] ^ fp[i]) <= MOST
            if near.any():
                met = left[near].tolist()
                edges += [(i, j) for j in met]
                frontier += met
                left = left[~near]
    return edges


def _pairs(buckets: np.ndarray) -> np.ndarray:
    """Of two-row buckets ([n, 2]): those that link."""
    return np.bitwise_count(buckets[:, 0] ^ buckets[:, 1]) <= MOST


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams buckets in order; a bucket that continues in the next batch is carried over."""
    key, held = None, []

    def out(a: list, b: list) -> pa.RecordBatch:
        x = [np.concatenate(v).view(np.int64) if v else np.empty(0, np.int64) for v in (a, b)]
        return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1])], ["a", "b"])

    def links(f: np.ndarray, a: list, b: list) -> None:
        if len(f) > 1 and (e := _forest(f)):
            i = np.array(e)
            a.append(f[i[:, 0]])
            b.append(f[i[:, 1]])

    for batch in batches:
        k, f = batch["bucket"].to_numpy(), batch["fp"].to_numpy().astype(np.int64).view(np.uint64)
        if not len(k):
            continue
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        cut = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        ends = np.concatenate((cut[1:], [len(k)]))
        if key is not None and k[0] != key:
            links(np.concatenate(held), a, b)
            held = []
        elif key is not None and len(cut) > 1:
            links(np.concatenate([*held, f[:ends[0]]]), a, b)
            held, cut, ends = [], cut[1:], ends[1:]
        size = (ends - cut)[:-1]
        two = cut[:-1][size == 2]
        p = f[two[:, None] + np.arange(2)]
        near = _pairs(p)
        a.append(p[near, 0])
        b.append(p[near, 1])
        for s, e in zip(cut[:-1][size > 2].tolist(), ends[:-1][size > 2].tolist()):
            links(f[s:e], a, b)
        held.append(f[cut[-1]:])
        key = k[-1]
        yield out(a, b)
    if held:
        a, b = [], []
        links(np.concatenate(held), a, b)
        yield out(a, b)


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """``fp`` (distinct) -> ``a, b``: links that join all fingerprints at ``MOST`` bits or fewer, a forest a bucket."""
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        fps.mapInArrow(_keyed, "bucket int, fp long")
        .repartition(n, "bucket").sortWithinPartitions("bucket")
        .mapInArrow(_linked, "a long, b long").distinct()
    )


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest doc_id reachable over links, its own included."""
    prints = written(with_fingerprints(docs), "simhash-fp")
    reps = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    links = written(fingerprint_links(reps.select("fp")), "simhash-links")
    comps = components(links, "simhash-cc")
    labelled = reps.join(comps, reps["fp"] == comps["node"], "left").select("fp", "rep", F.coalesce("component", "fp").alias("c"))
    labelled = written(labelled, "simhash-labels")
    least = labelled.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = written(labelled.join(least, "c").select(F.col("fp").alias("__fp"), "component_id"), "simhash-named")
    dropped(links, reps, labelled)
    return prints.join(named, F.col("fp") == F.col("__fp")).select("doc_id", "fp", "component_id")


def hex_fingerprint(c):
    return F.lower(F.lpad(F.hex(c), 16, "0"))
