"""Edits brought together, placements, ranges after edits, exchanged policies and worklists, against plain versions."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from textkiln.operators import merging as M
from textkiln.operators import policydiff as D
from textkiln.operators import resolution as R
from textkiln.operators import worklist as K
from textkiln.operators.matching import longest_prefix

EDITS = "doc int, start long, end long, sha256 string, replacement string"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def clash(x, y):
    (a, b, _), (c, d, _) = x, y
    if (a, b) == (c, d):
        return True
    return max(a, c) < min(b, d) or (a == b and c < a < d) or (c == d and a < c < b)


def test_any_order_of_edits_gives_one_body(spark):
    rng = random.Random(2)
    bodies = {i: "".join(rng.choice("abcdef ") for _ in range(60)) for i in range(30)}
    sides = {i: [(a := rng.randrange(56), a + rng.randrange(5), rng.choice("XYZ")) for _ in range(rng.randrange(7))] for i in bodies}
    docs = spark.createDataFrame(list(bodies.items()), "doc int, text string")
    want = {}
    for i, es in sides.items():
        one = sorted(set(es))
        bad = {e for e, f in itertools.permutations(one, 2) if clash(e, f)}
        t = bodies[i]
        for a, b, r in sorted((e for e in one if e not in bad), reverse=True):
            t = t[:a] + r + t[b:]
        want[i] = (t, bool(bad))
    seen = []
    for order in (1, 2):
        rows = [(i, a, b, sha(bodies[i][a:b]), r) for i, es in sides.items() for a, b, r in es[::-1 if order == 2 else 1]]
        rng.shuffle(rows)
        edits = spark.createDataFrame(rows + rows[:5], EDITS)
        got = {r["doc"]: (r["body"], r["conflicts"] > 0, r["error"]) for r in M.assembled(docs, edits, "doc", "text").collect()}
        assert got == {i: (*w, None) for i, w in want.items()}
        seen.append(sorted(map(repr, M.conflicts(M.merged_edits(edits, "doc"), "doc").collect())))
    assert seen[0] == seen[1] != []


def test_edits_belong_to_their_section(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc int, text string")
    edits = spark.createDataFrame([(1, 0, 3, sha("one"), "1", "a"), (1, 4, 7, sha("two"), "2", "b"), (1, 8, 13, sha("three"), "3", "c"), (1, 14, 18, sha("for"), "4", "b")], EDITS + ", section string")
    sections = spark.createDataFrame([(1, "a", 0, 4), (1, "b", 8, 18)], "doc int, section string, start int, end int")
    r = M.assembled(docs, edits, "doc", "text", sections).first()
    assert (r["body"], r["refused"], r["error"]) == ("one two three four", 2, "stale edit")
    r = M.assembled(docs, edits.where("replacement != '4'"), "doc", "text", sections).first()
    assert (r["body"], r["refused"], r["conflicts"], r["error"]) == ("1 two three four", 2, 0, None)


def test_placements_over_long_edits(spark):
    long = "x" * 1_000_000
    edits = spark.createDataFrame([(1, 10, 20, "a", "y" * 5), (1, 30, 31, "b", long), (1, 40, 40, "c", "zz")], EDITS)
    find = lambda s, e, h, r: (1, s, e, h, r)
    after = 30 - 5  # where the long replacement begins
    findings = spark.createDataFrame([find(11, 14, "a", "y" * 5), find(11, 16, "a", "y" * 5), find(after + 999_000, after + 1_000_000, "b", long), find(after + 5, after + 9, "b", "other"), find(after + 999_999, after + 1_000_001, "b", long), find(1_000_035 - 1, 1_000_035, "c", "zz"), find(12, 12, "a", "y" * 5)], EDITS)
    got = {(r["start"], r["end"], r["original_start"], r["original_end"], r["candidate_start"]) for r in M.guarded_placements(edits, findings, "doc").collect()}
    assert got == {(11, 14, 10, 20, 10), (after + 999_000, after + 1_000_000, 30, 31, after)}


def test_smallest_enclosing_over_all_scales(spark):
    rng = random.Random(4)
    blocks = [(1, a := rng.randrange(10**6), a + rng.choice([3, 70, 5000, 300_000, 10**6])) for _ in range(300)]
    spans = list({(1, a := rng.randrange(10**6), a + rng.randrange(1, 40)) for _ in range(200)})
    want = {}
    for g, a, b in spans:
        held = [(e - s, s, e) for _, s, e in blocks if s <= a and b <= e]
        if held:
            _, s, e = min(held)
            want[a, b] = (s, e)
    df = lambda rows: spark.createDataFrame(rows, "g int, start long, end long")
    assert {(r["start"], r["end"]): (r["b_start"], r["b_end"]) for r in R.smallest_enclosing(df(spans), df(blocks), "g").collect()} == want


def test_ranges_after_edits(spark):
    rng = random.Random(8)
    changes, ranges, want = [], [], set()
    for g in range(25):
        at, mine = 0, []
        for _ in range(6):
            at += rng.randrange(1, 12)
            end = at + rng.randrange(0, 6)
            mine.append((at, end, rng.randrange(9)))
            at = end
        own = [(a := rng.randrange(60), a + rng.randrange(1, 25)) for _ in range(8)]
        changes += [(g, *c) for c in mine]
        ranges += [(g, *r) for r in own + own[:1]]
        for a, b in own:
            bad = any(s < b and e > a and not (a <= s < e <= b) for s, e, _ in mine)
            move = lambda p: p + sum(n - (e - s) for s, e, n in mine if e <= p)  # noqa: B023, E731
            want.add((g, a, b, None if bad else move(a), None if bad else move(b)))
    got = R.project_range(spark.createDataFrame(ranges, "g int, start long, end long"), spark.createDataFrame(changes, "g int, start long, end long, new_length long"), "g").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(ranges)
    alone = R.project_range(spark.createDataFrame([(1, 2, 5)], "g int, start long, end long"), spark.createDataFrame([], "g int, start long, end long, new_length long"), "g")
    assert [tuple(r) for r in alone.collect()] == [(1, 2, 5, 2, 5)]


def test_another_policy_judges_what_it_can_touch(spark):
    rng = random.Random(1)
    path = lambda: "/" + "/".join(rng.choice("abc") for _ in range(rng.randrange(1, 5)))
    rules = lambda: {path(): (rng.choice("xyz"), rng.randrange(3)) for _ in range(12)}
    old = rules()
    new = dict(list(old.items())[:9]) | {path(): ("x", 9) for _ in range(2)} | {next(iter(old)): ("changed", 0)}
    table = lambda d: spark.createDataFrame([(p, *v) for p, v in d.items()], "prefix string, label string, rank int")
    rows = spark.createDataFrame([(i, path()) for i in range(300)] + [(-1, None)], "id int, path string")
    kept = longest_prefix(rows, "path", table(old), "prefix", "rule")
    got = D.reclassified(kept, "path", table(old), table(new), "prefix", "rule").collect()
    full = {r["id"]: r["rule"] for r in longest_prefix(rows, "path", table(new), "prefix", "rule").collect()}
    assert {r["id"]: r["rule"] for r in got} == full and len(got) == 301
    assert 0 < sum(r["again"] for r in got) < 300
    assert D.changed_rules(table(old), table(old), "prefix").count() == 0


def test_worklists_are_taken_up(spark, tmp_path, monkeypatch):
    graph = {"root": ["a", "b", "root"], "a": ["c", "x1", "x2"], "b": ["c", "a", "x2"], "c": ["root", "x3"]}
    edges = spark.createDataFrame([(p, u, "item" if u.startswith("x") else "index") for p, us in graph.items() for u in us], "parent string, url string, kind string")
    expand = lambda f: edges.join(f.withColumnRenamed("url", "parent"), "parent", "left_semi")
    seeds = spark.createDataFrame([("root",), (None,)], "url string")
    whole = sorted(map(repr, K.Worklist(spark, str(tmp_path / "a")).drain(seeds, expand).collect()))
    for k in range(4):
        w = K.Worklist(spark, str(tmp_path / f"b{k}"))
        w.drain(seeds, expand, k) if k else None

        def killed(self, rows, n):
            rows.select("url", "parent", "kind", "loop").limit(1).write.mode("overwrite").parquet(f"{self.root}/round={n}")
            next((tmp_path / f"b{k}" / f"round={n}").glob("_SUCCESS")).unlink()
            raise KeyboardInterrupt

        with monkeypatch.context() as m:
            m.setattr(K.Worklist, "_write", killed)
            with pytest.raises(KeyboardInterrupt):
                w.step(seeds, expand)
        assert sorted(map(repr, K.Worklist(spark, str(tmp_path / f"b{k}")).drain(seeds, expand).collect())) == whole
    found = K.Worklist(spark, str(tmp_path / "a")).known(4)
    assert {r["url"] for r in found.where("kind = 'item'").collect()} == {"x1", "x2", "x3"}
    assert {(r["parent"], r["url"]) for r in found.where("loop and kind = 'index'").collect()} == {("root", "root"), ("b", "a"), ("b", "c"), ("c", "root")}


def test_listings_that_turn_in_a_circle(spark):
    rows = [("a", i, d) for i, d in enumerate("pqrqrs")] + [("b", i, d) for i, d in enumerate("pq")]
    out = K.before_loops(spark.createDataFrame(rows, "listing string, page int, digest string"), "listing", "page", "digest")
    assert {(r["listing"], r["page"]) for r in out.collect()} == {("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1)}
    assert K.sitemap_entries(spark.createDataFrame([("m", "<urlset><url><loc>\nh/?a&amp;b</loc></url></urlset>"), ("n", None), ("o", "<sitemap><loc>m</loc></sitemap>")], "url string, xml string")).orderBy("parent").collect() == [("m", "h/?a&b", "item"), ("o", "m", "index")]
    assert out.where(F.col("page") > 3).count() == 0
