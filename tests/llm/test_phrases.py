"""Collocations against counts by hand: awkward rows, small buckets, ties, counts past 64 bits."""

import re
from collections import Counter, defaultdict

import pytest
from cases import fixture_docs, table
from pyspark.sql import functions as F


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def want(rows, top=2000, least=10):
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", ascii_lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        cands = {g: v for g, v in c.items() if len(g) > 1 and v >= least}
        longer = Counter()
        for g, v in cands.items():
            for i in range(len(g) - 1) if len(g) == 3 else ():
                longer[g[i:i + 2]] = max(longer[g[i:i + 2]], v)
        found = []
        for g, a in cands.items():
            if len(g) == 2 and 100 * longer[g] >= 50 * a and longer[g]:
                continue
            s, _, l, r = min((1_000_000 * a * a // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            found.append((-s, -a, " ".join(g).encode(), l, r))
        out |= {(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])}
    return out


def got(df):
    rows = [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("which", ["awkward", "documents", "empty"])
def test_collocations(spark, which):
    from textkiln.llm.phrases import collocations

    docs = {"awkward": lambda: table(spark), "documents": lambda: fixture_docs(spark), "empty": lambda: table(spark, "none")}[which]()
    expected = want([(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()])
    assert bool(expected) == (which != "empty")
    assert got(collocations(docs)) == expected


def test_a_bucket_larger_than_a_task_holds(spark):
    """Parts of buckets are summed, and cuts at few rows keep their ties."""
    from textkiln.llm.phrases import collocations

    docs = fixture_docs(spark).unionByName(fixture_docs(spark))
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert got(collocations(docs, top=7, least=3, hold=300)) == want(rows, 7, 3)


def test_one_word_everywhere(spark):
    """Repeated words, a word as its own neighbour, breaks and marks that are words, one language with a third of all rows."""
    from textkiln.llm.phrases import collocations

    rows = [("a", "x x x x. X x\ty"), ("a", "y\x00 \x00   y\x00 \x00  ;"), (None, "-- -- q"), ("a", None), ("b", "É é É é,É")] * 12 + [("a", "x " * 5000)]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("word", F.lit(1)).withColumn("rank", F.lit("r")).repartition(5)
    assert got(collocations(docs)) == want(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    from textkiln.llm.phrases import _score

    cases = [(123_456_789_012, 987_654_321_098, 123_456_789_013), (10**13, 10**13, 10**13), (10**13 - 1, 10**13, 10**13), (10, 10, 11)]
    df = spark.createDataFrame(cases, "n long, l long, r long").select("n", "l", "r", _score("n", "l", "r").alias("s"))
    assert {tuple(r) for r in df.collect()} == {(n, l, r, 1_000_000 * n * n // (l * r)) for n, l, r in cases}


def test_summed_keeps_grams_apart():
    import numpy as np

    from textkiln.llm import phrases as P

    g = [np.array(x, np.int32) for x in ([1, 2, 1, 3], [5, 5, 5, 5], [-1, -1, -1, 7])] + [np.array([1, 2, 3, 4])]
    held = P._mixed
    P._mixed = lambda *c: np.zeros(len(c[0]), np.uint64)  # every gram collides
    try:
        one = sorted(zip(*P.summed(g)))
    finally:
        P._mixed = held
    assert one == sorted(zip(*P.summed(g))) == [(1, 5, -1, 4), (2, 5, -1, 2), (3, 5, 7, 4)]
