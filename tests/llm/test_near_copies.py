"""The pipeline's near-dedup against brute force over five-word shingles."""

import random
from collections import defaultdict

import pytest
from cases import fixture_docs, table


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def groups(rows):
    """Row numbers by group."""
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0:
                root[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(rows)):
        out[find(i)].append(i)
    return list(out.values())


def edited(spark):
    """Texts with one to four words in a hundred changed, around the similarity of 0.8, a passage that all hold, and short texts."""
    rng, rows = random.Random(4), []
    passage = [f"p{i}" for i in range(30)]
    for k in range(60):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(6, 200))] + passage
        rows.append(" ".join(base))
        for n in range(rng.randrange(4)):
            w = list(base)
            for i in rng.sample(range(len(w)), max(1, len(w) * (n + 1) // 100)):
                w[i] = f"x{rng.randrange(5000)}"
            rows.append(" ".join(w))
    rows += ["", None, " ", "one two", "One  two", "one two three four five", "one two three four five six"]
    rng.shuffle(rows)
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


@pytest.mark.parametrize("docs, frequent", [("awkward", 8), ("documents", 1), ("edited", 8), ("edited", 1)])
def test_stage_keeps_one_of_each_group(spark, docs, frequent, monkeypatch):
    import corpus_pipeline
    from textkiln.llm import near_copies

    monkeypatch.setattr(near_copies, "FREQUENT", frequent)
    docs = {"awkward": table, "documents": fixture_docs, "edited": edited}[docs](spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = {min((rows[i][0] for i in g if rows[i][0] is not None), default=None) for g in groups(rows)} - {None}
    out = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} - {None} == want


def test_repeated_rows_and_null_ids_leave_one_row(spark):
    import corpus_pipeline

    rng = random.Random(6)
    a, b, c = (" ".join(f"w{rng.randrange(5000)}" for _ in range(80)) for _ in range(3))
    rows = [(1, a, "s"), (1, a, "s"), (1, a, "t"), (1, a + " end", "s"), (2, a, "s"), (None, a, "s"), (None, b, "s"), (None, b, "s"), (None, b + " end", "t"), (3, c, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [(r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()]
    assert len(out) == 3 and set(out) <= set(rows)
    assert sorted(d or 0 for d, _, _ in out) == [0, 1, 3]


def test_parities_never_exclude_a_similar_pair():
    import numpy as np
    from textkiln.llm.near_copies import FEW, _fits, parities

    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(FEW + 1, 3000))
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        cut, extra = base[: n - int(rng.integers(0, n // 9))], rng.integers(0, 1 << 63, int(rng.integers(0, n // 9)), dtype=np.uint64)
        x, y = np.unique(base), np.unique(np.concatenate((cut, extra)))
        wide = [parities(s, 2 << len(s).bit_length()).tobytes() for s in (x, y)]
        common = len(np.intersect1d(x, y))
        if 9 * common >= 4 * (len(x) + len(y)):
            assert _fits(*wide, len(x) + len(y))
        z = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert not _fits(wide[0], parities(z, 2 << len(z).bit_length()).tobytes(), len(x) + len(z))


def test_values_that_move_between_columns_and_columns_of_any_kind(spark):
    """Rows that differ in where a value stands are two documents; maps, arrays and names of the stage's own pass."""
    import corpus_pipeline

    rows = [(7, None, "x", None, {"k": 1}, [1], 5), (7, "x", None, None, {"k": 1}, [1], 5), (8, "x", None, None, None, None, None), (8, "x", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, m map<string, int>, row array<int>, set_key long")
    out = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert out.columns == docs.columns and sorted(map(repr, (tuple(r) for r in out.collect()))) == sorted(map(repr, rows[:2]))
    assert corpus_pipeline.simhash_near_dedup(spark, docs.limit(0), "").count() == 0
