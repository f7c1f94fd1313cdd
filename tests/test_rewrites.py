"""Guarded rewrites, retirement predicates, proofs and reports over small tables."""

import hashlib
import json
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from textkiln.functions import markdown as M
from textkiln.operators import graph as G
from textkiln.operators import proofs as P
from textkiln.operators import reports as R
from textkiln.operators import repetition
from textkiln.operators import resolution
from textkiln.operators import retirement as T
from textkiln.operators import rewrites as W

SF = "/root/testdata/sf0.001"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_spliced_refuses_what_changed_or_overlaps():
    body = "one two three"
    assert W.spliced(body, [(4, 7, sha("two"), "2"), (0, 3, sha("one"), "1")]) == "1 2 three"
    for edits in ([(0, 3, sha("two"), "")], [(0, 5, sha("one t"), ""), (4, 7, sha("two"), "")], [(0, 99, sha(body), "")]):
        with pytest.raises(ValueError):
            W.spliced(body, edits)


def test_origins_by_brute_force(spark):
    text, edits = "abcdefghijklmnopqrst", [(0, 2, "XYZ"), (5, 5, "+"), (8, 12, ""), (19, 20, "end")]
    out, origin, at = "", [], 0
    for s, e, new in edits:
        out += text[at:s] + new
        origin += [*range(at, s), *[None] * len(new)]
        at = e
    out, origin = out + text[at:], origin + list(range(at, len(text)))
    rows = W.origins(spark.createDataFrame([(1, len(text)), (2, 4), (3, 0)], "k int, length int"), spark.createDataFrame([(1, s, e, len(n)) for s, e, n in edits], "k int, start int, end int, new_length int"), "k").collect()
    got = [None] * len(out)
    for r in rows:
        if r["k"] == 1:
            for i in range(r["out_end"] - r["out_start"]):
                got[r["out_start"] + i] = r["source_start"] + i
    assert got == origin
    assert [tuple(r) for r in rows if r["k"] != 1] == [(2, 0, 4, 0)]


def test_units_to_remove_do_not_overlap():
    body = "# A https://x/1\n\ntext\n\n# B\n\n- item https://x/1\n\n  more https://x/1\n- other\n\n| a | b |\n|---|---|\n| https://x/1 | 2 |\n| 3 | 4 |\n"
    units = [b for b in M.blocks(body) if b.kind in W.UNIT_ORDER and "https://x/1" in (b.text.split("\n")[0] if b.kind == "section" else b.text)]
    chosen = W.units_to_remove(units)
    assert [(u.kind, u.start) for u in chosen] == [("section", 0), ("list_item", 6), ("table_row", 13)]


def test_media_need_their_file_and_one_destination(spark):
    docs = spark.createDataFrame([(1, "![a](x.png) ![b](y.png)"), (2, "![a](z.png)"), (3, "![a](w.png) (w.png)"), (4, None)], "k int, body string")
    to = spark.createDataFrame([("x.png", "n.png"), ("z.png", "gone.png"), ("w.png", "p.png"), ("w.png", "q.png")], "target string, replacement string")
    out = W.rewritten_media(docs, "k", "body", to, spark.createDataFrame([("n.png",), ("p.png",), ("q.png",)], "name string"))
    assert {r["k"]: (r["body"], r["error"]) for r in out.collect()} == {1: ("![a](n.png) ![b](y.png)", None), 2: ("![a](z.png)", "missing file"), 3: ("![a](w.png) (w.png)", "several destinations"), 4: (None, None)}


def test_literals_findings_and_quotes():
    assert W.literal_variants('a"é') == {'a"é', 'a\\"é', 'a\\"\\u00e9'}
    assert W.contains_finding('say a\\"b', "x", 'a"b') and not W.contains_finding("say x", "x", 'a"b')
    assert not W.contains_finding("<id-12>", "<id-12>", "12") and W.contains_finding("<id-12> 12", "<id-12>", "12")
    assert W.quote_signature("a “b” `c` [d](e)") == ("“”", "``", 2, 2)


def test_spans_address_their_text(spark):
    text = " a  bb\n\nc\td é"
    rows = W.addressed_spans(spark.createDataFrame([(1, text), (2, None)], "k int, t string"), "k", "t").collect()
    assert all(sha(text[r["start"]:r["end"]]) == r["sha256"] for r in rows if r["k"] == 1)
    assert Counter(r["address"] for r in rows if r["k"] == 1) == Counter(["line:0", "line:0/word:0", "line:0/word:1", "line:1", "line:2", "line:2/word:0", "line:2/word:1", "line:2/word:2"])
    assert [(r["address"], r["start"], r["end"]) for r in rows if r["k"] == 2] == [("line:0", 0, 0)]


def test_policy_text():
    assert T.policy_text(r"A\_B%20&amp;\*C") == "a_b &*c"


def test_links_take_their_base(spark):
    base = "https://h.org/a/b?q#f"
    text = "see https://x.org/p. and [l](c/d) [r](/root) <a href='//cdn/x'> [s](#t) mailto [m](mailto:x@y)\n[d]: ../e"
    got = spark.createDataFrame([(text, base)], "t string, b string").select(T.authored_links(F.col("t"), F.col("b")).alias("x")).first()["x"]
    assert got == ["https://x.org/p", "https://h.org/a/c/d", "https://h.org/root", "https://cdn/x", "https://h.org/a/b?q#t", "mailto:x@y", "https://h.org/a/../e"]


def test_obsolete_texts_by_brute_force(spark):
    """The registered query's operator over the smallest pages, against loops."""
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    words = sorted({w.lower() for _, _, h in pages for w in re.findall(r'href="/([A-Za-z]+)"', h)})[::3]
    prefixes = {f"{re.search('://([^/?#]*)', u.lower())[1]}/{w}" for _, u, _ in pages for w in words}
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["retired"], r["links"]) for r in T.obsolete_texts(df, "page_id", "html", "url", ("cheap-pills",), spark.createDataFrame([(p,) for p in prefixes], "prefix string")).collect()}
    want = {}
    for i, u, h in pages:
        links = spark.createDataFrame([(h, u)], "t string, b string").select(T.authored_links(F.col("t"), F.col("b")).alias("x")).first()["x"] if i < 6 else None
        if links is None:
            continue
        place = lambda x: (re.match(r"[a-z]+://([^?#]*)", x.lower()) or ["", ""])[1].rstrip("/")
        n = sum(any(place(x) == p or place(x).startswith(p + "/") for p in prefixes) for x in links)
        if n or "cheap-pills" in h:
            want[i] = ("cheap-pills" in h, n)
    assert {k: v for k, v in got.items() if k < 6} == want


def test_json_with_a_key_twice(spark):
    rows = spark.createDataFrame([(1, '{"b": 1, "a": [{"c": 2}]}'), (2, '{"a": 1, "a": 1}'), (3, '[{"x": {"y": 1, "y": 2}}]'), (4, "{"), (5, None)], "k int, t string")
    assert {r["k"]: (r["json"], r["error"]) for r in T.unique_json(rows, "k", "t").collect()} == {1: ('{"a":[{"c":2}],"b":1}', None), 2: (None, "duplicate key"), 3: (None, "duplicate key"), 4: (None, "no JSON"), 5: (None, None)}


def test_limitation_notices(spark):
    subject, other = "old stacks?", ("retired tools",)
    texts = ["> **Note:** It does not support old stack.", "> Note: does not support old stack", "> **NOTE:** does not support old stacks, nor retired tools", "> **Note:** does not support old stack, see `x`", "> **Note:** fine", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r["x"] for r in df.orderBy("i").select(T.limitation_notice(F.col("t"), subject, other).alias("x")).collect()] == [True, False, False, False, False, False]


def test_reviewed_exclusions_hold_their_guards(spark):
    docs = spark.createDataFrame([("https://h/a", "x", "s", ["m"]), ("https://h/b", "x", "s", ["m"]), ("https://h/c", "x", "s", []), ("https://h/d", "x", "s", [])], "url string, body string, source_sha256 string, media array<string>")
    dec = spark.createDataFrame([("https://H/A/", sha("x"), "s", ["m", "m"]), ("https://h/b", sha("y"), "s", ["m"]), ("https://h/c", sha("x"), "s", []), ("https://h/c/", sha("x"), "s", [])], "url string, input_sha256 string, source_sha256 string, media array<string>")
    assert {r["url"]: (r["excluded"], r["error"]) for r in T.reviewed_exclusions(docs, dec).collect()} == {"https://h/a": (True, None), "https://h/b": (False, "changed"), "https://h/c": (False, "several decisions")}


def test_reachable_for_some_rounds(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(2, 0)], "src int, dst int")
    seeds = spark.createDataFrame([(0,)], "node int")
    assert sorted(map(tuple, G.reachable(edges, seeds, 3).collect())) == [(i, i) for i in range(4)]
    assert G.reachable(edges, seeds).count() == 7 and G.reachable(edges, seeds.where("node > 5")).count() == 0


def test_dependency_rounds_stop_at_reviews(spark):
    one = lambda xs: spark.createDataFrame([(x,) for x in xs], "node int")
    links = spark.createDataFrame([(i + 1, i) for i in range(9)] + [(20, 0), (21, 20), (30, 0), (31, 30)], "src int, dst int")
    got = {r["node"]: (r["depth"], r["state"]) for r in P.dependency_rounds(links, one([0]), one([30]), one([20])).collect()}
    assert got == {0: (0, "omitted"), 1: (1, "omitted"), 2: (2, "omitted"), 3: (3, "open"), 20: (1, "unresolved")}


def test_packing_streams_over_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        rows = [(i % 3, i, (i * 37) % 50) for i in range(300)] + [(None, 1, 5), (None, 2, 99)]
        got = defaultdict(list)
        for r in resolution.pack(spark.createDataFrame(rows, "g int, o int, s int"), "g", "o", "s", 90, 4).collect():
            got[r["g"]].append((r["o"], r["s"], r["bin"]))
    finally:
        spark.conf.set(key, held)
    for g in (0, 1, 2, None):
        number, total, n, want = 0, 0, 0, []
        for _, o, s in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            if n and (total + s > 90 or n >= 4):
                number, total, n = number + 1, 0, 0
            total, n = total + s, n + 1
            want.append((o, s, number))
        assert sorted(got[g]) == want


def test_block_repetition_by_brute_force(spark):
    docs = [(i, f"# T{i}\n\nshared paragraph\n\n```\ncode {i % 2}\n```\n\nown {i}\n\nshared paragraph\n") for i in range(6)]
    seen = defaultdict(list)
    for i, t in docs:
        for b in M.blocks(t):
            if b.kind in repetition.REPEATED_KINDS:
                seen[b.sha256].append(i)
    want = {(h, len(v), len(set(v)), min(v)) for h, v in seen.items() if len(set(v)) >= 3}
    got = {(r["sha256"], r["occurrences"], r["n_docs"], r["first_doc"]) for r in repetition.block_repetition(spark.createDataFrame(docs, "doc_id long, body string"), "doc_id", "body").collect()}
    assert got == want and len(want) == 3


def test_reports_are_whole_files(spark, tmp_path):
    R.write_report(spark, str(tmp_path), "quality", {"b": 1, "a": [None]}, "# R\n")
    R.write_report(spark, str(tmp_path), "quality", {"b": 2, "a": [None]}, "# R\n")
    assert (tmp_path / "quality.json").read_text() == json.dumps({"a": [None], "b": 2}, indent=2) + "\n" and (tmp_path / "quality.md").read_text() == "# R\n"
    assert R.analysis_markdown([{"source": "b", "documents": 1, "estimated_tokens": 2}, {"source": "a", "documents": 3, "estimated_tokens": 4}], {"exact_repetition": 5}).splitlines()[4:6] == ["| a | 3 | 4 |", "| b | 1 | 2 |"]


def test_receipts(spark):
    one = spark.range(1).select(F.lit("v1").alias("tag"), F.lit("abc").alias("source_commit"), F.lit("t").alias("published_at"))
    assets = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, sha256 string")
    r = P.receipt(one, assets)
    good = r.first()
    errors = lambda r, sha256, names: {tuple(x) for x in P.receipt_errors(r, {"tag": "v1", "source_commit": "abc"}, sha256, spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert errors(r, good["sha256"], ["a", "b"]) == set()
    assert errors(r, "0", ["a", "c"]) == {("receipt", "digest"), ("b", "unexpected"), ("c", "missing")}


def test_policies_need_their_digest(spark, tmp_path):
    import gzip

    from pyspark.errors import PySparkException

    from textkiln.operators import projections as J

    path = tmp_path / "policy.json.gz"
    path.write_bytes(gzip.compress(b'{"url": "https://h/a", "disposition": "keep"}\n{"url": "https://h/b", "disposition": "omit"}\n', mtime=0))
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    assert [r["sha256"] for r in J.file_digests(spark, str(tmp_path), "*.gz").collect()] == [digest]
    assert J.pinned_policy(spark, str(path), digest, "url string, disposition string").count() == 2
    with pytest.raises(PySparkException):
        J.pinned_policy(spark, str(path), "0" * 64, "url string, disposition string").collect()


def test_routes(spark):
    from textkiln.operators import projections as J

    urls = ["https://h/docs/how-to/site_a/add.html?x", "https://h", "https://h/one/", None]
    m = J.route_metadata(F.col("u"))
    got = [tuple(r) for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i").select(*m.values()).collect()]
    assert got == [("add", "docs", "how-to", ["Docs", "How To", "Site A"]), (None, None, None, []), ("one", "one", None, []), (None, None, None, [])]


def test_spans_leave_a_task_in_bounded_batches():
    import pyarrow as pa

    texts = ["w " * 3 * W.MOST_SPANS, "a\n" * W.MOST_SPANS, "", "x y"]
    got = list(W.span_batches(iter([pa.RecordBatch.from_pydict({"k": [1, 2, 3, 4], "t": texts})]), "k"))
    assert len(got) > 5 and all(sum(map(len, b["spans"].to_pylist())) <= W.MOST_SPANS for b in got)
    found = defaultdict(list)
    for b in got:
        for k, spans in zip(b["k"].to_pylist(), b["spans"].to_pylist()):
            found[k] += [(s["address"], s["start"], s["end"], s["sha256"]) for s in spans]
    assert dict(found) == {k: list(W._spans(t)) for k, t in enumerate(texts, 1)}


def test_references_meet_each_key_of_a_catalog_once(spark):
    """Many operations under one name: the join makes no more rows than it was asked for."""
    catalog = spark.range(2_000).select(
        F.lit("op").alias("operation_id"), F.concat(F.lit("r"), "id").alias("resource"), F.lit("d").alias("domain"), F.when(F.col("id") < 1_999, "u").alias("url"), F.lit("o").alias("overview_url"), F.lit(None).cast("string").alias("legacy_url"))
    refs = spark.range(2_000).select(F.concat(F.lit("ref"), "id").alias("ref"), F.lit("c").alias("canonical"), F.lit("").alias("fragment"), F.lit("op").alias("leaf"))
    out = resolution.resolve_reference(refs, catalog, spark.createDataFrame([], "legacy_url string, destination string"), "f")
    assert {(r["destination"], r["reason"]) for r in out.collect()} == {("u", "exact_operation")}

    def joined(plan):
        kids = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName() == "AdaptiveSparkPlan":
            kids = [plan.executedPlan()]
        if "QueryStage" in plan.nodeName():
            kids = [plan.plan()]
        own = [plan.metrics().apply("numOutputRows").value()] if plan.nodeName().endswith("Join") else []
        return own + [n for k in kids for n in joined(k)]

    assert 0 < max(joined(out._jdf.queryExecution().executedPlan())) <= 10_000


def test_links_are_those_of_whole_pages_and_of_rendered_ones(spark, tmp_path):
    from textkiln.plans.contents import markdown_links

    html = '<html><body><a href="/a">x</a><a href="/a">y</a><p>text</p></body></html>'
    spark.createDataFrame([(1, "https://h/1", html), (2, None, "<p>none</p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = Counter(tuple(r) for r in markdown_links(spark, str(tmp_path)).collect())
    assert got == Counter([(1, "link", "/a"), (1, "link", "https://h/a"), (1, "link", "https://h/1"), (1, "media", "/img/1.png"), (2, "media", "/img/2.png")])


def test_parsers_take_and_give_back_a_few_texts_at_a_time(spark):
    import pandas as pd
    import pyarrow as pa
    from textkiln.operators import pages

    class Table:
        def mapInArrow(self, run, schema):
            return run

    taken = []

    def run(frames):
        for f in frames:
            taken.append(len(f))
            yield pd.DataFrame({"id": f["k"].repeat(3), "x": "b"})

    batch = pa.RecordBatch.from_pydict({"k": list(range(1_000))})
    out = list(pages.mapped(Table(), run, "id long, x string")(iter([batch])))
    assert max(taken) <= pages.ROWS and max(b.num_rows for b in out) <= 3 * pages.ROWS
    assert [x for b in out for x in b["id"].to_pylist()] == [k for k in range(1_000) for _ in range(3)]


def test_best_documents_are_those_of_all_scores(spark):
    from textkiln.operators import retrieval

    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.when(F.col("id") % n < 2, F.repeat(F.lit(f"w{n} "), (F.col("id") % 9).cast("int"))) for n in (2, 3, 5, 7)], F.lit("x")).alias("text"))
    asked = retrieval.asked_words(spark.createDataFrame([(1, "w2 w3"), (2, "w5 w7 w3"), (3, "none"), (4, "x")], "question_id long, text string"))
    tf = retrieval.term_counts(docs, asked).localCheckpoint()
    scored = retrieval.scored(tf, 300, asked)
    found = retrieval.best(tf, 300, asked)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, retrieval.top_k(scored).collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [question_id" not in plan and "MapInArrow" in plan
