"""Benchmark phrases in training texts, found by an FM-index of each training shard.

A shard is what a task reads until it has ``SHARD`` words. Words become numbers of the test phrases' vocabulary; a word of no
phrase can lie in no occurrence, so it parts the texts into strings, strings shorter than the shortest phrase go, and equal
strings are indexed once. ``FMIndex`` sorts their suffixes by doubling, and keeps the Burrows-Wheeler transform as a wavelet
matrix of packed bits with ranks, and every ``SAMPLE``-th suffix position of a string. All phrases are searched backwards
together, those whose range is empty leave, and the occurrences of the others are located by steps to a sampled position.
Removal spans are the merged occurrences.

Phrases come in blocks of ``BLOCK`` bytes of text, cut so that no phrase is lost; each block is sent to the tasks and passes
over all texts, so a benchmark of any size is whole and what is broadcast stays bounded.

Defined results: a null or wordless text has no words and no spans; a null or wordless item has no phrases. An item without an
id marks words but isn't listed. Items that share an id are one item, items of one text are all listed. Rows are judged one by
one, so repeated rows and null document ids need no rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.arrow import bounded, small
from textkiln.llm.prefix import running_totals
from textkiln.llm.tables import written

#: Words of a phrase; a shorter item is one phrase.
WINDOW = 10
SHARD = 1 << 21
SAMPLE = 16
#: Bytes of item text in a block, and words of an item in one row of it.
BLOCK, PART = 2 << 20, 1 << 16
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SPAN = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False)])


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and other characters than ASCII."""
    return (text or b"").translate(_BYTES).split()


class Phrases:
    """Distinct phrases of some items: number sequences by length, and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        of: dict[tuple[int, ...], set] = {}
        for item, words in items:
            s = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            for i in range(max(1, len(s) - window + 1)) if s else ():
                of.setdefault(tuple(s[i:i + window]), set()).add(item)
        self.items = [sorted(x for x in held if x is not None) for held in of.values()]
        self.lengths = np.fromiter(map(len, of), np.int64, len(of))
        self.shortest = int(self.lengths.min(initial=window))
        #: Words from the last to the first, 0 where a phrase has ended.
        self.backwards = np.zeros((window, len(of)), np.int64)
        for j, p in enumerate(of):
            self.backwards[:len(p), j] = p[::-1]


def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each place, where the places of its key begin in ``order``."""
    k = key[order]
    first = np.concatenate(([True], k[1:] != k[:-1]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return rank


def suffix_order(s: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Places of ``s`` in the order of their suffixes. ``end``: where the string of a place ends; there ``s`` is 0, less than any word.

    Equal suffixes of several strings are in the order of the strings. Prefixes of doubled length are compared among places that are equal so far.
    """
    n = len(s)
    bits = max(1, int(s.max(initial=0)).bit_length())
    depth = max(1, 63 // bits)
    key = np.zeros(n, np.uint64)
    place = np.arange(n)
    for k in range(depth):  # as many words as a key holds; what follows the end is 0
        at = place + k
        w = np.where(at <= end, s[np.minimum(at, n - 1)], 0).astype(np.uint64)
        key = key << np.uint64(bits) | w
    order = np.argsort(key)
    rank = _ranks(key, order)
    while True:
        sorted_rank = rank[order]
        same = np.concatenate(([False], sorted_rank[1:] == sorted_rank[:-1]))
        tied = np.flatnonzero(same | np.concatenate((same[1:], [False])))
        if not len(tied):
            return order
        p = order[tied]
        after = p + depth
        # an ended suffix equals the others of its rank but for its string's place
        over = after > end[p]
        second = np.where(over, p - n, rank[np.minimum(after, n - 1)])
        moved = np.lexsort((second, rank[p]))
        order[tied] = p[moved]
        first, value = rank[p][moved], second[moved]
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (value[1:] != value[:-1])))
        rank[order[tied]] = np.maximum.accumulate(np.where(new, tied, 0))
        depth *= 2


class FMIndex:
    """Strings of numbers from 1, each followed by a 0."""

    def __init__(self, s: np.ndarray, end: np.ndarray, sample: int = SAMPLE):
        n = len(s)
        order = suffix_order(s, end)
        begins = np.concatenate(([True], s[:-1] == 0))
        last = s[order - 1]  # the first row takes the last 0 of the text
        self.levels = max(1, int(s.max(initial=0)).bit_length())
        #: Rows whose suffix begins with a lesser word.
        self.less = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=(1 << self.levels) + 1))))
        # the wavelet matrix: at each level, from the highest bit, words whose bit is 0 come first
        self.bits, self.ones, self.zeros = [], [], []
        w = last
        for level in range(self.levels - 1, -1, -1):
            bit = (w >> level & 1).astype(bool)
            packed = np.packbits(np.concatenate((bit, np.zeros(-n % 64 + 64, bool))), bitorder="little").view("<u8")
            self.bits.append(packed)
            self.ones.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(n - int(bit.sum()))
            w = np.concatenate((w[~bit], w[bit]))
        # positions of suffixes, one in ``sample`` of a string and its first
        starts = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
        sampled = ((order - starts[order]) % sample == 0)
        self.marks = np.packbits(np.concatenate((sampled, np.zeros(-n % 64 + 64, bool))), bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)))
        self.places = order[sampled]
        self.n = n

    @staticmethod
    def _ones(bits: np.ndarray, ones: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Set bits before place i."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return ones[word] + np.bitwise_count(bits[word] & mask)

    def rank(self, w: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often word ``w`` stands in the transform before place ``i``."""
        lo, hi = np.zeros_like(i), i
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            a, b = self._ones(self.bits[k], self.ones[k], lo), self._ones(self.bits[k], self.ones[k], hi)
            one = (w >> level & 1).astype(bool)
            lo, hi = np.where(one, self.zeros[k] + a, lo - a), np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo

    def search(self, backwards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of rows whose suffixes begin with each phrase; ``backwards`` holds its words from the last to the first."""
        lo, hi = np.zeros(backwards.shape[1], np.int64), np.full(backwards.shape[1], self.n, np.int64)
        for step in backwards:
            on = np.flatnonzero((step > 0) & (hi > lo))
            if not len(on):
                break
            w = step[on]
            known = w < 1 << self.levels
            at = np.where(known, w, 0)
            lo[on] = np.where(known, self.less[at] + self.rank(at, lo[on]), 0)
            hi[on] = np.where(known, self.less[at] + self.rank(at, hi[on]), 0)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back to the last sampled one, a word a step."""
        row, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            r = row[left]
            known = (self.marks[r >> 6] >> (r & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            hit = left[known]
            out[hit] = self.places[self._ones(self.marks, self.before, row[hit])] + steps[hit]
            left = left[~known]
            r = row[left]
            # the word before a row, and how often it stands before, level by level
            w, lo, at = np.zeros_like(r), np.zeros_like(r), r
            for k in range(self.levels):
                one = (self.bits[k][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
                a, b = self._ones(self.bits[k], self.ones[k], lo), self._ones(self.bits[k], self.ones[k], at)
                lo, at = np.where(one, self.zeros[k] + a, lo - a), np.where(one, self.zeros[k] + b, at - b)
                w = w << 1 | one
            row[left] = self.less[w] + at - lo
            steps[left] += 1
        return out


def _strings(texts: list[np.ndarray], shortest: int) -> tuple[list[bytes], list[list[tuple[int, int]]]]:
    """Distinct strings of known words, and the (text, first word) of each place that has one."""
    seen: dict[bytes, list[tuple[int, int]]] = {}
    for t, s in enumerate(texts):
        known = np.concatenate(([0], (s > 0).view(np.int8), [0]))
        edge = np.diff(known)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = last - first >= shortest
        for a, b in zip(first[long].tolist(), last[long].tolist()):
            seen.setdefault(s[a:b].tobytes(), []).append((t, a))
    return list(seen), list(seen.values())


def occurrences(texts: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, first word, phrase`` of every occurrence in a shard's texts (numbers of words, 0 for others)."""
    strings, places = _strings(texts, phrases.shortest)
    none = np.zeros(0, np.int64)
    if not strings:
        return none, none, none
    parts = [np.frombuffer(x, np.int32) for x in strings]
    size = np.array([len(p) + 1 for p in parts])
    start = np.cumsum(size) - size
    s = np.zeros(int(size.sum()), np.int64)
    for a, p in zip(start.tolist(), parts):
        s[a:a + len(p)] = p
    index = FMIndex(s, np.repeat(start + size - 1, size))
    lo, hi = index.search(phrases.backwards)
    count = np.maximum(hi - lo, 0)
    phrase = np.repeat(np.arange(len(lo)), count)
    rows = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(len(phrase))
    at = index.locate(rows)
    string = np.searchsorted(start, at, "right") - 1
    # every place that has the string
    times = np.array([len(x) for x in places])
    first = np.cumsum(times) - times
    flat = np.array([x for held in places for x in held], np.int64).reshape(-1, 2)
    n = times[string]
    one = np.repeat(np.arange(len(at)), n)
    place = flat[first[string][one] + np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n)]
    return place[:, 0], place[:, 1] + (at - start[string])[one], phrase[one]


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans, in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > end[:-1])) if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1] if len(start) else end


def _search(items: list[tuple[str | None, str]], window: int, shard: int, names: list[str]):
    """Adds a block's occurrences to ``spans`` and ``items`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases([(i, words_of(t.encode())) for i, t in items], window)
        get = phrases.number.get
        held, texts, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            text, at, phrase = occurrences(texts, phrases)
            order = np.argsort(text, kind="stable")
            text, at, phrase = text[order], at[order], phrase[order]
            base = 0
            for b, n_words in held:
                spans, found = b["spans"].to_pylist(), b["items"].to_pylist()
                lo, hi = np.searchsorted(text, [base, base + b.num_rows])
                cuts = lo + np.flatnonzero(np.diff(text[lo:hi], prepend=-1))
                for x, y in zip(cuts, np.append(cuts[1:], hi)):
                    t = int(text[x]) - base
                    length = phrases.lengths[phrase[x:y]]
                    old = np.array([(s["start"], s["start"] + s["length"]) for s in spans[t]], np.int64).reshape(-1, 2)
                    a, e = merged(np.concatenate((old[:, 0], at[x:y])), np.concatenate((old[:, 1], at[x:y] + length)))
                    spans[t] = [{"start": p, "length": q - p} for p, q in zip(a.tolist(), e.tolist())]
                    found[t] = sorted({*found[t], *(i for p in np.unique(phrase[x:y]) for i in phrases.items[p])})
                kind = pa.list_(pa.struct([pa.field("start", pa.int64(), False), pa.field("length", pa.int64(), False)]))
                new = {"n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, kind), "items": pa.array(found, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new[c] if c in new else b[c] for c in names], names)
                base += b.num_rows

        for b in small(batches):
            n_words = []
            for t in b["text"].cast(pa.binary()).to_pylist():
                w = words_of(t)
                n_words.append(len(w))
                texts.append(np.fromiter(map(get, w, repeat(0)), np.int32, len(w)))
            size += sum(n_words)
            held.append((b, n_words))
            if size >= shard:
                yield from flush()
                held, texts, size = [], [], 0
        if held:
            yield from flush()

    return run


def _parts(items: DataFrame, window: int) -> DataFrame:
    """``item, text``: lower-cased words of each item, in parts that overlap so that every phrase is in one."""
    tidy = F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " ")
    words = items.select(F.col("item_id").cast("string").alias("item"), F.filter(F.split(tidy, " "), lambda w: w != "").alias("words")).where(F.size("words") > 0)
    starts = words.withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)), F.lit(PART))))
    return starts.select("item", F.array_join(F.slice("words", F.col("at"), F.lit(PART + window - 1)), " ").alias("text"))


def blocks(items: DataFrame, window: int = WINDOW, size: int = BLOCK) -> Iterator[list[tuple[str | None, str]]]:
    """Items' parts in blocks of about ``size`` bytes, one at a time at the driver; a block has one part at least."""
    parts = written(_parts(items, window).distinct().withColumn("size", F.octet_length("text").cast("long")), "phrases-parts")
    numbered = written(running_totals(parts.withColumn("nth", F.coalesce("item", F.lit(""))), ["nth", "text"], "size", label="phrases-blocks").select("item", "text", F.floor(F.col("before") / size).alias("block")), "phrases-numbered")
    last = numbered.agg(F.max("block")).first()[0]
    for k in range(0 if last is None else last + 1):
        yield [(r["item"], r["text"]) for r in numbered.where(F.col("block") == k).select("item", "text").collect()]


def contaminated_spans(docs: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The columns ``keep`` of every row, with ``text``, ``n_words``, ``spans`` (merged occurrences in words: start, length) and ``items`` (ids as strings, sorted)."""
    if {*keep} & {"n_words", "spans", "items"}:
        raise ValueError("rename columns n_words, spans and items first")
    now = bounded(docs).select(*keep, *([] if "text" in keep else ["text"]), F.lit(0).cast("long").alias("n_words"), F.array().cast(T.ArrayType(SPAN, False)).alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in now.schema])
    done = False
    for found in blocks(items, window, block):
        # between blocks the texts are a written table, so a lost executor repeats one block
        now = (written(now, "phrases-pass") if done else now).mapInArrow(_search(found, window, shard, schema.names), schema)
        done = True
    return now if done else now.mapInArrow(_search([], window, shard, schema.names), schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the text of the removal spans: from a span's first word to its last, what lies between included. Texts without a span stay as they are."""
    names = docs.columns
    at = names.index("text")
    plain = docs.toDF(*["text" if i == at else f"c{i}" for i in range(len(names))])
    schema = plain.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
        for b in small(batches):
            texts = []
            for t, spans in zip(b["text"].to_pylist(), b["spans"].to_pylist()):
                if spans:
                    raw = t.encode()
                    where = [m.span() for m in word.finditer(raw)]
                    done, left = 0, []
                    for s in spans:
                        left.append(raw[done:where[s["start"]][0]])
                        done = where[s["start"] + s["length"] - 1][1]
                    t = b"".join([*left, raw[done:]]).decode()
                texts.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else b[c] for c in schema.names], schema.names)

    return contaminated_spans(plain, items, tuple(plain.columns), window).mapInArrow(cut, schema).toDF(*names)


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row."""
    found = contaminated_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), items)
    n_hit: Column = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
