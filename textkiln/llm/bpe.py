"""Byte-level BPE with vectorised pre-tokenisation.

A batch of texts becomes one array of code points; a table maps them to classes, shifted copies add
what a class needs to know of the next characters. Each class is a transition function over a small
set of states. The functions form a finite monoid, so states everywhere come from an associative
scan over function numbers (one table look-up a step, many rows at once) and token boundaries
from a table of (state, class). No regular expression runs. Slices between boundaries go through a
cache of pair merges; byte offsets of every token are kept, and ids decode through the vocabulary.

Defined results: null and empty texts have no tokens. Texts of any length are handled whole; slices
of thousands of bytes merge in n log n. The cache is cleared at a fixed size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.arrow import bounded, small

#: Fixed value: the pre-tokenisation that the classes and states below express.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 300_000
#: Pieces up to so many bytes are merged with plain lists, longer ones with a heap.
SHORT = 64
NEVER = 1 << 62
#: Characters of a batch that are scanned at once.
SCAN_CHARS = 1 << 20

# classes: letter, number, other, apostrophe before a one- or two-letter ending, last white space
# before something else (space or not), white space before white space or the end
_LETTER, _NUMBER, _OTHER, _END1, _END2, _SPACE, _BLANK, _INNER = range(8)
# states after a character: token closed, in letters, numbers, others, a space that joins what
# follows, inner white space, one or two letters of an ending still to come
_SHUT, _IN_L, _IN_N, _IN_O, _JOIN, _WHITE, _LEFT1, _LEFT2 = range(8)
_FIRST = 8  # added to the class of a text's first character


def _step(state: int, cls: int) -> tuple[int, bool]:
    """Next state, and whether a token starts at this character."""
    if cls >= _FIRST:
        return _step(_SHUT, cls - _FIRST)[0], True
    if state == _LEFT2:
        return _LEFT1, False
    if state == _LEFT1:
        return _SHUT, False
    if cls in (_LETTER, _NUMBER):
        own = _IN_L if cls == _LETTER else _IN_N
        return own, state not in (own, _JOIN)
    if cls == _OTHER or cls in (_END1, _END2) and state in (_IN_O, _JOIN):
        return _IN_O, state not in (_IN_O, _JOIN)
    if cls in (_END1, _END2):
        return _LEFT1 if cls == _END1 else _LEFT2, True
    if cls == _INNER:
        return _WHITE, state != _WHITE
    return _JOIN if cls == _SPACE else _SHUT, True


@lru_cache(1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function number of each class, composition table, value at each state, and starts by (state, class)."""
    base = [tuple(_step(s, c)[0] for s in range(8)) for c in range(16)]
    found = {tuple(range(8)): 0}
    todo = [*dict.fromkeys(base)]
    while todo:
        f = todo.pop()
        if f not in found:
            found[f] = len(found)
            todo += [tuple(b[x] for x in f) for b in base]
    fs = list(found)
    comp = np.array([[found.get(tuple(g[x] for x in f), 0) for g in fs] for f in fs], np.uint16)
    # a product of members is a member, since every member is a product of base functions
    starts = np.array([[_step(s, c)[1] for c in range(16)] for s in range(8)])
    return np.array([found[b] for b in base], np.uint16), comp, np.array(fs, np.uint8), starts


@lru_cache(1)
def _char_classes() -> np.ndarray:
    out = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            out[c] = _LETTER
        elif k == "N":
            out[c] = _NUMBER
    # Code points with the Unicode property White_Space.
    for c in (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288):
        out[c] = _BLANK
    return out


def _scan(f: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Inclusive scan of function numbers under composition."""
    n, width = len(f), 256
    if n <= width:
        out, acc = np.empty_like(f), 0
        for i, x in enumerate(f.tolist()):
            acc = out[i] = comp[acc, x]
        return out
    rows = -(-n // width)
    m = np.zeros(rows * width, f.dtype)
    m[:n] = f
    m = np.ascontiguousarray(m.reshape(rows, width).T)
    flat, k = comp.ravel(), comp.shape[1]
    for j in range(1, width):
        m[j] = flat[m[j - 1].astype(np.int64) * k + m[j]]
    before = np.zeros(rows, f.dtype)
    before[1:] = _scan(m[-1].copy(), comp)[:-1]
    m = flat[before.astype(np.int64)[None, :] * k + m]
    return m.T.reshape(-1)[:n]


def boundaries(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a token starts. ``codes``: code points of texts laid end to end; ``first``: where texts start."""
    kind = _char_classes()[codes]
    n = len(codes)
    opens = np.zeros(n + 3, bool)
    opens[first] = True
    opens[n:] = True
    c = np.zeros(n + 2, np.int32)
    c[:n] = codes
    c1, c2 = np.where(opens[1:n + 1], 0, c[1:n + 1]), np.where(opens[1:n + 1] | opens[2:n + 2], 0, c[2:n + 2])
    quote = np.flatnonzero(codes == 39)
    q1, q2 = c1[quote], c2[quote]
    # Endings that stand alone after an apostrophe: s t m d, re ve ll.
    kind[quote[np.isin(q1, [115, 116, 109, 100])]] = _END1
    kind[quote[((q1 == 114) | (q1 == 118)) & (q2 == 101) | (q1 == 108) & (q2 == 108)]] = _END2
    white = kind == _BLANK
    after = np.zeros(n, bool)  # white space or the text's end comes next
    after[:-1] = white[1:]
    after |= opens[1:n + 1]
    kind[white & (codes == 32)] = _SPACE
    kind[white & after] = _INNER
    kind[first] += _FIRST
    of_class, comp, value, starts = _monoid()
    state = value[_scan(of_class[kind], comp), _SHUT]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = _SHUT, state[:-1]
    return starts[before, kind]


class Tokenizer:
    """Ranks from lines of ``base64 rank``."""

    def __init__(self, lines: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x.strip())}
        self.vocabulary = {v: k for k, v in self.ranks.items()}
        self.cache: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Repeatedly joins the adjacent pair of lowest rank, leftmost first."""
        ranks = self.ranks
        if (r := ranks.get(piece)) is not None:
            return [r]
        n = len(piece)
        if n <= SHORT:
            return self._merge_short(piece)
        end = list(range(1, n + 1))  # end of the part that starts here
        prev = list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != e:
                continue
            j = end[i]
            alive[j] = False
            end[i] = e
            if e < n:
                prev[e] = i
                if (r := ranks.get(piece[i:end[e]])) is not None:
                    heapq.heappush(heap, (r, i, end[e]))
            if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:e])) is not None:
                heapq.heappush(heap, (r, p, e))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _merge_short(self, piece: bytes) -> list[int]:
        """The same with plain lists, which is quicker for words."""
        get, ranks = self.ranks.get, self.ranks
        cut = list(range(len(piece) + 1))
        pairs = [get(piece[i:i + 2], NEVER) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) < NEVER:
            i = pairs.index(least)
            del cut[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(piece[cut[i]:cut[i + 2]], NEVER)
            if i:
                pairs[i - 1] = get(piece[cut[i - 1]:cut[i + 1]], NEVER)
        return [ranks[piece[a:b]] for a, b in zip(cut, cut[1:])]

    def _missing(self, piece: bytes) -> bytes:
        if len(self.cache) >= CACHE_ENTRIES:
            self.cache.clear()
        ids = np.array(self.merge(piece), "<u4").tobytes()
        if len(piece) <= 64:
            self.cache[piece] = ids
        return ids

    def encode_batch(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each UTF-8 text."""
        out: list[np.ndarray] = []
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= SCAN_CHARS:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        full = [t for t in texts if t]
        if not full:
            return [np.empty(0, "<u4") for _ in texts]
        joined = b"".join(full)
        codes = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int32)
        at_byte = np.flatnonzero((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80)  # first byte of each character
        ends = np.cumsum([len(t) for t in full])
        first = np.searchsorted(at_byte, np.concatenate(([0], ends[:-1])))
        cut = at_byte[boundaries(codes, first)]
        lows, lo = np.searchsorted(cut, np.concatenate(([0], ends))).tolist(), 0
        marks = [*cut.tolist(), len(joined)]
        get, missing, done = self.cache.get, self._missing, []
        for k in range(len(full)):
            lo, hi = lows[k], lows[k + 1]
            done.append(np.frombuffer(b"".join([get(p := joined[s:e]) or missing(p) for s, e in zip(marks[lo:hi], marks[lo + 1:hi + 1])]), "<u4"))
        it = iter(done)
        return [next(it) if t else np.empty(0, "<u4") for t in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset at which each token starts, and the text's length."""
        return np.concatenate(([0], np.cumsum([len(self.vocabulary[i]) for i in ids.tolist()], dtype=np.int64)))


@lru_cache(2)
def tokenizer(lines: bytes) -> Tokenizer:
    """One for each Python worker and vocabulary."""
    return Tokenizer(lines)


def vocabulary_lines(path: str) -> bytes:
    """A vocabulary file, read by the driver; tasks get its bytes (about a megabyte) and need no such path."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``ids`` (array<int>) and ``offsets`` (array<int>, one more than ids); columns of these names are replaced."""
    docs = docs.drop("ids", "offsets")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("offsets", T.ArrayType(T.IntegerType()))])
    lines = vocabulary_lines(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(lines)
        for b in small(batches):
            ids = tok.encode_batch([t or b"" for t in b[text].cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([tok.offsets(x).astype(np.int32) for x in ids], pa.list_(pa.int32()))], [*b.schema.names, "ids", "offsets"])

    return bounded(docs).mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``rows`` plus ``decoded`` (binary), which replaces a column of that name."""
    rows = rows.drop("decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    lines = vocabulary_lines(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(lines)
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([tok.decode(np.asarray(x or [], np.int64)) for x in b[ids].to_pylist()], pa.binary())], [*b.schema.names, "decoded"])

    return bounded(rows).mapInArrow(run, schema)


def roundtrip(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes each whole text, then decodes its ids.

    ``with_ids`` adds ``ids``: the ids as little-endian unsigned 32-bit integers.
    """
    lines = vocabulary_lines(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(lines)
        for b in small(batches):
            ids = tok.encode_batch([t or b"" for t in b["text"].cast(pa.binary()).to_pylist()])
            raw = [x.tobytes() for x in ids]
            columns = {
                "doc_id": b["doc_id"],
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(tok.decode(x)).hexdigest() for x in ids], pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.array(raw, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
