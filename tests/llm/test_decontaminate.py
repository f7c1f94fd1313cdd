"""The FM-index against plain search: suffix order, ranks, positions, and documents with every kind of item."""

import hashlib
import re

import numpy as np
import pytest
from cases import LONG, SENTENCE, fixture_docs, table
from hypothesis import given, settings
from hypothesis import strategies as st

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def named(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def want(docs, items, window=10):
    of = {}
    for i, t in items:
        w = named(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            of.setdefault(tuple(w[k:k + window]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = named(t), set(), set()
        for n in {len(p) for p in of}:
            for k in range(len(w) - n + 1):
                if held := of.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= held
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))) for r in df.collect())


def laid(strings):
    s = np.array([x for p in strings for x in [*p, 0]], np.int64)
    size = np.array([len(p) + 1 for p in strings])
    return s, np.repeat(np.cumsum(size) - 1, size)


@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=40), min_size=1, max_size=8), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=5), min_size=1, max_size=6), st.sampled_from([1, 2, 7]))
@settings(max_examples=300, deadline=None)
def test_index(strings, asked, sample):
    from textkiln.llm.decontaminate import FMIndex, suffix_order

    s, end = laid(strings)
    wide = s * 100_003  # two words fill a key
    # the 0 of a string is less than those of later ones
    suffix = lambda p, v: [(v[i], 0 if v[i] else end[i]) for i in range(p, end[p] + 1)]
    for v in (s, wide):
        assert suffix_order(v, end).tolist() == sorted(range(len(v)), key=lambda p: suffix(p, v))
    index = FMIndex(s, end, sample)
    backwards = np.zeros((5, len(asked)), np.int64)
    for j, p in enumerate(asked):
        backwards[:len(p), j] = p[::-1]
    lo, hi = index.search(backwards)
    for p, a, b in zip(asked, lo, hi):
        places = [i for i in range(len(s)) if s[i:i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_merged():
    from textkiln.llm.decontaminate import merged

    a, b = merged(np.array([5, 0, 2, 20]), np.array([8, 3, 5, 21]))
    assert list(zip(a.tolist(), b.tolist())) == [(0, 8), (20, 21)]
    assert [len(x) for x in merged(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]


ITEMS = [
    (1, SENTENCE), (2, SENTENCE.upper() + "and more"), (2, "word17x17"), (3, None), (4, " ... "), (5, "own-words,HERE"), (None, "a shared line of text"), (10, "don't we'll"),
    (11, LONG[5000:9000]), (1, SENTENCE), (12, "É a line with"), (13, "no item has these words at all or nearly so"),
]


def item_table(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string").repartition(2)


@pytest.mark.parametrize("which", ["awkward", "documents", "empty"])
def test_digest(spark, which):
    from textkiln.llm.decontaminate import digest

    docs = {"awkward": lambda: table(spark), "documents": lambda: fixture_docs(spark), "empty": lambda: table(spark, "none")}[which]()
    pairs = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    items = ITEMS if which != "documents" else [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()] + [(99, pairs[3][1][:40])]
    assert got(digest(docs, item_table(spark, items))) == want(pairs, items)


def test_no_items(spark):
    from textkiln.llm.decontaminate import digest

    assert got(digest(table(spark), item_table(spark, []))) == want([(r["doc_id"], r["text"]) for r in table(spark).collect()], [])


def test_many_blocks_and_shards(spark, monkeypatch):
    """Items over several blocks and parts, and shards of a few texts, give the spans of one pass."""
    from textkiln.llm import decontaminate as D

    docs = table(spark)
    plain = {repr((r["doc_id"], r["n_words"], r["spans"], r["items"])) for r in D.contaminated_spans(docs, item_table(spark)).collect()}
    monkeypatch.setattr(D, "PART", 40)
    assert len(list(D.blocks(item_table(spark), size=1500))) > 2
    assert {repr((r["doc_id"], r["n_words"], r["spans"], r["items"])) for r in D.contaminated_spans(docs, item_table(spark), shard=100, block=1500).collect()} == plain


def test_texts_without_their_spans(spark):
    """From the first word of a span to its last; other texts and columns, null, repeated and clashing ones too, stay."""
    from textkiln.llm.decontaminate import decontaminate

    rows = [(1, "Before. " + SENTENCE + "After", "s", "i"), (2, None, "s", None), (3, "nothing of it", None, "i"), (3, "nothing of it", None, "i"), (None, "“A Shared Line of text”", "s", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, items string")
    out = decontaminate(docs, item_table(spark))
    assert out.columns == docs.columns
    assert sorted(map(repr, (tuple(r) for r in out.collect()))) == sorted(map(repr, [(1, "Before.  After", "s", "i"), *rows[1:4], (None, "“A Shared Line of text”", "s", "i")]))
