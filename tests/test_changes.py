"""State that changes by commits: killed commits, conflicts, seals, contents from many tasks, hash trees, rechecks, streams over restarts."""

import hashlib
import random
import uuid
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textkiln.operators import hashtree as H
from textkiln.operators import recheck as R
from textkiln.sources import committed as C
from textkiln.sources import contents as S
from textkiln.streaming import events as E


def rows(spark, data):
    return spark.createDataFrame(list(data.items()), "path string, text string")


def held(table):
    return {r["path"]: r["text"] for r in table.read().collect()}


def test_a_commit_is_whole_or_absent(spark, tmp_path, monkeypatch):
    t = C.CommittedTable(spark, str(tmp_path / "t"), buckets=4)
    assert t.version() == 0 and t.read() is None
    old, new = {f"p{i}": f"{i}" for i in range(40)}, {f"p{i}": f"new {i}" for i in range(30)}
    assert t.commit(rows(spark, old)) == 1
    for step in ("_written", "_checked", "_named"):
        whole = getattr(C.CommittedTable, step)

        def killed(self, *args, whole=whole):
            whole(self, *args) if step != "_named" else None
            raise KeyboardInterrupt

        with monkeypatch.context() as m:
            m.setattr(C.CommittedTable, step, killed)
            with pytest.raises(KeyboardInterrupt):
                t.commit(rows(spark, new))
        assert t.version() == 1 and held(t) == old and t.verify().count() == 0
    assert t.commit(rows(spark, new)) == 2 and held(t) == new
    assert {r["path"]: r["text"] for r in t.read(version=1).collect()} == old
    assert t.vacuum() == 4 and held(t) == new


def test_only_touched_buckets_change(spark, tmp_path):
    t = C.CommittedTable(spark, str(tmp_path / "t"), buckets=4)
    t.commit(rows(spark, {f"p{i}": "a" for i in range(40)}))
    b = t.read().where("path = 'p7'").first()["bucket"]
    part = t.read([b])
    t.commit(part.withColumn("text", F.lit("b")), [b])
    m = t.manifest()
    assert len({v["run"] for v in m["buckets"].values()}) == 2
    assert {r["text"] for r in t.read([b]).collect()} == {"b"} and t.read().where("text = 'b'").count() == part.count()
    with pytest.raises(ValueError):
        t.commit(t.read(), [b])
    t.commit(part.limit(0), [b])
    assert t.read().where(F.col("bucket") == b).count() == 0


def test_two_writers_of_one_state(spark, tmp_path):
    t = C.CommittedTable(spark, str(tmp_path / "t"), buckets=2)
    t.commit(rows(spark, {"a": "1"}))
    t.commit(rows(spark, {"a": "2"}), base=1)
    with pytest.raises(C.CommitConflict):
        t.commit(rows(spark, {"a": "3"}), base=1)
    assert held(t) == {"a": "2"}


def test_what_is_read_back_is_compared(spark, tmp_path, monkeypatch):
    t = C.CommittedTable(spark, str(tmp_path / "t"), buckets=2)
    t.commit(rows(spark, {"a": "1", "b": None}))
    plain = C.CommittedTable._written

    def lost(self, df, run):
        n = plain(self, df, run)
        next(Path(self.root, "data", run).rglob("*.parquet")).unlink()
        return n

    with monkeypatch.context() as m:
        m.setattr(C.CommittedTable, "_written", lost)
        with pytest.raises(C.CommitFailed):
            t.commit(rows(spark, {"a": "2", "b": "3", "c": "4"}))
    assert held(t) == {"a": "1", "b": None}


def test_a_seal_is_verified(spark, tmp_path):
    t = C.CommittedTable(spark, str(tmp_path / "t"), buckets=3)
    digest = C.seal(t, rows(spark, {f"p{i}": "accepted" if i else "open" for i in range(9)}), F.col("text") == "accepted", source="a")
    assert t.manifest()["facts"] == {"source": "a", "review_complete": False, "open": 1}
    assert t.verify(digest).count() == 0
    with pytest.raises(ValueError):
        t.verify("0" * 64)
    m = t.manifest()
    bucket, v = next(iter(m["buckets"].items()))
    folder = Path(t.root, "data", v["run"], f"bucket={bucket}")
    n = t.read([int(bucket)]).count()
    for p in folder.glob(".*"):
        p.unlink()
    victim = next(folder.glob("*.parquet"))
    spark.createDataFrame([(f"x{i}", "y", "z") for i in range(n)], "path string, text string, row_sha256 string").coalesce(1).write.parquet(str(tmp_path / "other"))
    victim.write_bytes(next((tmp_path / "other").glob("*.parquet")).read_bytes())
    assert {r["bucket"] for r in t.verify(digest).collect()} >= {int(bucket)}


def test_contents_are_stored_once(spark, tmp_path):
    root = str(tmp_path / "store")
    files = [(f"a/{i}", f"text {i % 7}".encode()) for i in range(60)] + [("none", None), ("empty", b"")]
    df = spark.createDataFrame(files, "name string, content binary").repartition(6)
    S.store(df, root)
    S.store(df.where("name like 'a/1%'"), root)
    assert {r["sha256"] for r in S.contents(spark, root).where("intact").collect()} == {hashlib.sha256(c).hexdigest() for _, c in files if c is not None}
    found = S.names(spark, root).where("name != 'empty'").collect()
    assert {(r["name"], r["sha256"]) for r in found} == {(n, hashlib.sha256(c).hexdigest()) for n, c in files if c}
    assert S.unnamed(spark, root).count() == 0 and not any((tmp_path / "store" / "staging").iterdir())


def test_failed_jobs_leave_no_names(spark, tmp_path):
    root = str(tmp_path / "store")
    S.store(spark.createDataFrame([("a", b"1")], "name string, content binary"), root)

    def broken(batches):
        for b in batches:
            yield b
            raise RuntimeError("lost")

    df = spark.createDataFrame([(f"b{i}", f"{i}".encode()) for i in range(20)], "name string, content binary").repartition(3)
    with pytest.raises(Exception):
        S.store(df.mapInArrow(broken, df.schema), root)
    assert [r["name"] for r in S.names(spark, root).collect()] == ["a"]
    S.store(df, root)
    assert S.names(spark, root).count() == 21 and S.contents(spark, root).count() == 20 and S.unnamed(spark, root).count() == 0


def test_hash_trees_read_what_differs(spark, tmp_path):
    a = {f"content/{i}": f"{i}" for i in range(3000)}
    b = a | {"content/5": "x", "new": "y", "content/6": None}
    del b["content/77"]
    files = lambda d: spark.createDataFrame(list(d.items()), "path string, sha256 string")
    x, y, same = (H.grown(files(d), str(tmp_path / n), digits=3) for d, n in ((a, "x"), (b, "y"), (a, "z")))
    want = {("content/5", "changed"), ("content/6", "changed"), ("new", "added"), ("content/77", "removed")}
    assert {tuple(r) for r in H.differences(x, y).collect()} == want
    prefixes = {r["prefix"] for r in H.differing_ranges(x, y).collect()}
    assert prefixes == {hashlib.sha256(p.encode()).hexdigest()[:3] for p, _ in want}
    assert x.digest() == same.digest() != y.digest() and H.differences(x, same).count() == 0
    parts = sorted({p[:2] for p in prefixes})
    assert {Path(f).parent.name for f in y.files(parts).inputFiles()} <= {f"part={p}" for p in parts}
    assert {tuple(r) for r in H.verify_snapshot(x, y, x.digest()).collect()} == {("content/5", "changed"), ("content/6", "changed"), ("new", "unexpected"), ("content/77", "missing"), (None, "receipt names another snapshot")}
    empty = H.grown(files({"k": "v"}).limit(0), str(tmp_path / "e"), digits=3)
    assert empty.digest() is None and H.differences(empty, y).count() == len(b)


def omitted(docs):
    """From path -> (excluded, repaired, links)."""
    back, out = defaultdict(set), {p for p, d in docs.items() if d[0]}
    for p, (_, repaired, links) in docs.items():
        for x in links if not repaired else ():
            back[x].add(p)
    work = list(out)
    while work:
        for p in back[work.pop()]:
            if p not in out:
                out.add(p)
                work.append(p)
    return out


def test_a_recheck_equals_a_full_run(spark, tmp_path):
    rng = random.Random(3)
    seen = []

    def judge(docs):
        seen.append(docs.count())
        return docs.select("path", "excluded", "repaired", "links")

    def made(path):
        return (rng.random() < 0.1, rng.random() < 0.2, [f"p{rng.randrange(150)}" for _ in range(rng.randrange(3))])

    table = C.CommittedTable(spark, str(tmp_path / "t"), buckets=16)
    docs = {f"p{i}": made(i) for i in range(120)}
    for turn in range(3):
        if turn:
            for p in rng.sample(sorted(docs), 4):
                docs[p] = made(p)
            del docs[rng.choice(sorted(docs))]
            docs[f"p{120 + turn}"] = made(turn)
        data = [(p, hashlib.sha256(repr(d).encode()).hexdigest(), *d) for p, d in docs.items()]
        inputs = spark.createDataFrame(data, "path string, input_sha256 string, excluded boolean, repaired boolean, links array<string>")
        done = R.recheck(table, inputs, judge, "policy")
        got = {r["path"]: r for r in R.judgements(table).collect()}
        assert got.keys() == docs.keys() and {p for p, r in got.items() if r["omitted"]} == omitted(docs) & docs.keys()
        if turn:
            assert seen[-1] <= 5 < done.affected < 120
    assert R.recheck(table, inputs, judge, "policy").stale == 0
    assert R.recheck(table, inputs, judge, "another").stale == len(docs)
    links = {(r["path"], r["src"]) for r in table.read().where("kind = 'link'").collect()}
    assert links == {(x, p) for p, d in docs.items() for x in d[2]}


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = C.CommittedTable(spark, str(tmp_path / "t"), buckets=32)
    data = [(f"p{i}", "1", False, False, [f"p{i // 2}"] if i else []) for i in range(400)]
    schema = "path string, input_sha256 string, excluded boolean, repaired boolean, links array<string>"
    judge = lambda d: d.select("path", "excluded", "repaired", "links")
    R.recheck(table, spark.createDataFrame(data, schema), judge, "a")
    data[390] = ("p390", "2", True, False, ["p195"])
    done = R.recheck(table, spark.createDataFrame(data, schema), judge, "a")
    assert done.stale == done.affected == 1 and len(done.buckets) <= 2
    assert [r["path"] for r in R.judgements(table).where("omitted").collect()] == ["p390"]


def test_pages_judged_anew_do_not_pass_through_the_driver_in_every_round(spark, tmp_path):
    sc, n, step = spark.sparkContext, 20_000, 5_000
    store = sc._jsc.sc().statusStore()

    def sent():
        """Bytes of results by stage, without what every task reports."""
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return {(x.stageId(), x.attemptId()): max(0, x.resultSize() - 10_000 * x.numCompleteTasks()) for x in (stages.apply(i) for i in range(stages.size()))}

    table = C.CommittedTable(spark, str(tmp_path / "t"), buckets=4)
    judge = lambda d: d.select("path", (F.col("input_sha256") == "2").alias("excluded"), F.lit(False).alias("repaired"), F.when(F.col("i") >= step, F.array(F.concat(F.lit("p"), F.sha1((F.col("i") - step).cast("string"))))).alias("links"))
    docs = lambda sha: spark.range(n).select(F.concat(F.lit("p"), F.sha1(F.col("id").cast("string"))).alias("path"), sha.alias("input_sha256"), F.col("id").alias("i"))
    R.recheck(table, docs(F.lit("1")), judge, "a")
    before = sent()
    done = R.recheck(table, docs(F.when(F.col("id") < step, "2").otherwise("1")), judge, "a")
    new = sum(v for k, v in sent().items() if k not in before)
    assert done.stale == step and done.affected == n == R.judgements(table).where("omitted").count()
    assert new < 6 * 41 * n  # new pages of a round and stale ones, a few times


def test_streams_over_files_restarts_and_replays(spark, tmp_path):
    rng = random.Random(5)
    data = [(f"p{rng.randrange(12)}", rng.choice(["success", "gone", "gone", "error"]), f"2025-01-{rng.randrange(1, 28):02d}", i) for i in range(300)] + [("p1", "gone", "2025-01-30", 5), ("p1", "gone", "2025-01-30", 5)]
    rng.shuffle(data)
    schema = "page string, kind string, at string, event_id long"
    stream = E.page_states(E.read_events(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema))
    for k in range(3):
        spark.createDataFrame(data[k * 101:(k + 1) * 101], schema).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        E.upsert(stream, str(tmp_path / "out"), str(tmp_path / "log"))
    want = {tuple(r) for r in E.folded(spark.createDataFrame(data, schema)).collect()}
    assert {tuple(r) for r in E.newest(spark, str(tmp_path / "out")).collect()} == want
    # the last batch is made again, as after a failure before it was logged
    last = max(int(p.name) for p in (tmp_path / "log" / "commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "log" / "commits").glob(f"*{last}*"):
        if p.name.strip(".").removesuffix(".crc") == str(last):
            p.unlink()
    E.upsert(stream, str(tmp_path / "out"), str(tmp_path / "log"))
    assert {tuple(r) for r in E.newest(spark, str(tmp_path / "out")).collect()} == want
    E.compact(spark, str(tmp_path / "out"), str(tmp_path / uuid.uuid4().hex))


def test_alias_rounds_write_only_what_goes_on(spark, monkeypatch):
    """Short chains beside one long and a cycle: rounds write what has not ended, and a cycle ends them."""
    from textkiln.operators import graph as G

    rows, plain = [], G.settled
    monkeypatch.setattr(G, "settled", lambda df: (out := plain(df), rows.append(out.count()))[0])
    pairs = [(f"s{i}", "end") for i in range(500)] + [(f"l{i}", f"l{i + 1}") for i in range(20)] + [("x", "y"), ("y", "x"), ("in", "x"), ("t", "a"), ("t", "b"), ("u", "t")]
    got = {r["path"]: (r["target"], r["hops"], r["cycle"], r["error"]) for r in G.resolve_aliases(spark.createDataFrame(pairs, "path string, target string")).collect()}
    assert got["s7"] == ("end", 1, False, None) and all(got[f"l{i}"] == ("l20", 20 - i, False, None) for i in range(20)) and len(got) == 525
    assert got["x"] == got["in"] == (None, None, True, "cycle") and got["u"][3] == "leads to several targets" and got["t"][3] == "several targets"
    assert sum(rows) < 3 * len(pairs)


def test_tasks_list_the_store(spark, tmp_path):
    root = str(tmp_path / "store")
    S.store(spark.createDataFrame([("a", b"1"), ("e", b"")], "name string, content binary"), root)
    held = S.contents(spark, root)
    assert "BatchScan contents" in held._jdf.queryExecution().executedPlan().toString() and held.rdd.getNumPartitions() == 256
    assert {(bytes(r["content"]), r["intact"]) for r in held.collect()} == {(b"1", True), (b"", True)}


def test_a_page_asks_the_state_for_nothing_it_does_not_hold():
    """Each call of the state is a message to the JVM; a page whose last event is a success needs two."""
    from pyspark.sql import Row

    from textkiln.streaming import events as E

    calls = []

    class State:
        def __init__(self, name):
            self.name, self.value = name, None

        def __getattr__(self, what):
            def call(*args):
                calls.append((self.name, what))
                if what == "update":
                    self.value = args[0]
                return self.value if what == "get" else None
            return call

    class Handle:
        def getValueState(self, name, schema):  # noqa: N802
            return State(name)

        getListState = getValueState  # noqa: N815

    fold = E.PageFold()
    fold.init(Handle())
    for n in (1, 2):
        out = list(fold.handleInputRows(("p",), iter([Row(page="p", kind="gone", at="1", event_id=2 * n), Row(page="p", kind="success", at="2", event_id=2 * n + 1)]), None))
        assert [(r["status"], r["attempts"], r["failures"]) for r in out] == [("success", 2 * n, 0)]
    assert calls == [("known", "get"), ("known", "update")] * 2
