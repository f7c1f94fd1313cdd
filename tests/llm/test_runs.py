"""Periodic runs against all periods tried one by one."""

import functools
import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from cases import fixture_docs, table
from hypothesis import given, settings
from hypothesis import strategies as st


@functools.cache
def plain_runs(w, least=24, times=3):
    n, found = len(w), {}
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    v = np.array([number[x] for x in w], np.int64)
    for q in range(1, n // times + 1):  # periods rise, so the smallest stays
        edge = np.diff(np.concatenate(([0], (v[q:] == v[:-q]).astype(np.int8), [0])))
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_digest(d, text, again=True):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(w)
    if again and d is not None and n:
        h = zlib.crc32(str(d).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(tuple(w))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (d, len(runs), *first, sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 12)), max_size=8))
@settings(max_examples=400, deadline=None)
def test_runs_of_made_up_sequences(parts):
    from textkiln.llm.runs import runs_of

    w = [x for p, k in parts for x in p * k]
    assert runs_of(w) == plain_runs(tuple(w))


@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 5), min_size=1, max_size=12), st.integers(1, 9)), max_size=5), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_stretches_hold_every_run(texts):
    from textkiln.llm.runs import runs_of, stretches

    words = [[x for p, k in t for x in p * k] for t in texts]
    s = np.array([x for w in words for x in w], np.int64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    found = [(a + x, m, q) for a, e in stretches(s, owner) for x, m, q in runs_of(s[a:e].tolist())]
    base = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    assert sorted(found) == sorted((int(base[i]) + x, m, q) for i, w in enumerate(words) for x, m, q in plain_runs(tuple(w)))


def test_z_function():
    from textkiln.llm.runs import z_function

    s = [1, 1, 2, 1, 1, 2, 1, 1, 1]
    assert list(z_function(s, len(s))) == [9, 1, 0, 5, 1, 0, 2, 2, 1] and list(z_function([], 0)) == []


@pytest.mark.parametrize("which", ["awkward", "documents", "empty"])
def test_digest(spark, which):
    from textkiln.llm.runs import digest

    docs = {"awkward": lambda: table(spark), "documents": lambda: fixture_docs(spark), "empty": lambda: table(spark, "none")}[which]()
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    expected = sorted(map(repr, (plain_digest(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())))
    got = sorted(repr(tuple(r[c] for c in names)) for r in digest(docs).collect())
    assert got == expected
    assert which != "documents" or any("None" not in x for x in got)


def test_collapsed_texts(spark):
    """Nulls, blanks, one word, a long loop beside prose, equal exponents; clashing and repeated column names stay."""
    from textkiln.llm.runs import collapse_repetitions

    texts = [None, "", " \n", "ja " * 24, "ja " * 23, "a b c " * 8 + "x " + "d e f " * 8, "one two three " * 9000 + "end", "own words only here", "own words only here"]
    docs = spark.createDataFrame([(t, i, "r") for i, t in enumerate(texts)], "text string, collapsed long, runs string").repartition(3)
    out = collapse_repetitions(docs)
    assert out.columns == docs.columns
    got = {r["collapsed"]: r["text"] for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == [None, "", " \n", "ja", "ja " * 23, "a b c x d e f", "one two three end", texts[7], texts[8]]
