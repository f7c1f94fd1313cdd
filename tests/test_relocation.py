"""References after masking, against places known from how the later version was made."""

import random

from textkiln.operators.relocation import anchors, relocate, relocated


def lines(rng, n):
    return [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(6, 12))) for _ in range(n)]


def test_anchors_rise_and_are_the_most():
    rng = random.Random(1)
    for _ in range(60):
        parts = [f"a{i} b{i} c{i} d{i}" for i in range(rng.randrange(1, 9))]
        order = rng.sample(parts, len(parts))
        got = anchors("\n".join(parts), "\n".join(order))
        assert got == sorted(got) and [b for _, b in got] == sorted(b for _, b in got)
        places, best = [order.index(p) for p in parts], [1] * len(parts)
        for i in range(len(parts)):
            best[i] += max((best[j] for j in range(i) if places[j] < places[i]), default=0)
        # each part gives one anchor, and pairs of neighbours that stayed together give more
        assert len({old.count("\n") for old in ("\n".join(parts)[:a] for a, _ in got)}) >= max(best) - sum(abs(places[i + 1] - places[i]) == 1 for i in range(len(parts) - 1))


def test_kept_masked_moved_and_repeated(spark):
    rng = random.Random(3)
    old_rows, new_rows, refs, want = [], [], [], set()
    for k in range(25):
        body = lines(rng, 14)
        body[5] = body[9] = "the same words stand here twice"
        gone, moved = {2, 11}, 7
        after = [x for i, x in enumerate(body) if i not in gone and i != moved] + [body[moved]]
        after[0] = "masked: " + after[0]
        old, new = "\n".join(body), "\n".join(after)
        old_rows.append((k, old))
        new_rows.append((k, new))
        for i, x in enumerate(body):
            start = len("\n".join(body[:i])) + (i > 0)
            end = start + len(x)
            refs.append((k, start, end))
            if i in gone:
                want.add((k, start, end, None, "vanished"))
            elif i == moved:
                want.add((k, start, end, len(new) - len(x), "moved"))
            else:
                j = i - sum(g < i for g in (*gone, moved))
                place = len("\n".join(after[:j])) + (j > 0) + 8 * (j == 0)
                want.add((k, start, end, place, "kept"))
    df = lambda rows: spark.createDataFrame(rows, "doc int, text string")
    refs += [(0, 5, 5), (0, -1, 3), (99, 0, 4)]
    got = {tuple(r) for r in relocated(df([*old_rows, (99, "left over")]), df(new_rows), spark.createDataFrame(refs, "doc int, start int, end int"), "doc", "text").collect()}
    assert got == want | {(0, 5, 5, None, "error"), (0, -1, 3, None, "error"), (99, 0, 4, None, "vanished")}


def test_a_repeat_that_lost_one_of_two_is_ambiguous():
    old = "x x a b c d x x"
    assert [o for _, o in relocate(old, "x x", [(0, 3)])] == ["ambiguous"]
    assert relocate(old, old, [(0, 3), (12, 15)]) == [(0, "kept"), (12, "kept")]


def test_query_holds_what_it_says(spark):
    """Every line of the documents: kept ones are where it says, lost ones occur less often than before."""
    from textkiln import registry

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    seen = {"kept": 0, "vanished": 0, "moved": 0, "ambiguous": 0}
    n = 0
    for r in registry.QUERIES["relocated_references"](spark, sf).collect():
        old = docs[r["doc_id"]]
        new = "\n".join("masked" if k % 4 == 1 else x for k, x in enumerate(old.split("\n")))
        text = old[r["start"]:r["end"]]
        seen[r["outcome"]] += 1
        n += 1
        if r["new_start"] is not None:
            assert new[r["new_start"]:r["new_start"] + len(text)] == text
        elif r["outcome"] == "vanished":
            assert new.count(text) < old.count(text)
        if old.count(text) == 1:
            assert r["outcome"] == ("vanished" if old[:r["start"]].count("\n") % 4 == 1 else "kept")
    assert n == sum(len(x) >= 20 for t in docs.values() for x in t.split("\n")) and min(seen["kept"], seen["vanished"]) > 100
