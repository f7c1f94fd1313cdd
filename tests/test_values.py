"""Expressions over chosen values."""

import hashlib

from pyspark.sql import functions as F

from textkiln.functions import html as H
from textkiln.functions import text as X
from textkiln.operators import curation as C
from textkiln.operators import evidence as E
from textkiln.operators import quality as Q
from textkiln.operators import state as S


def column(spark, values, *exprs):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [tuple(r)[0] if len(exprs) == 1 else tuple(r) for r in df.orderBy("i").select(*exprs).collect()]


def test_normalised_bodies_agree_over_all_blanks_and_line_ends(spark):
    import duckdb

    marks = [c for c in map(chr, range(0x3100)) if c.isspace() or len(f"a{c}b".splitlines()) > 1] + ["\r\n", "\x1f", "\u200b", "\ufeff"]
    texts = [t for m in marks for t in (f"a{m}b", f"a{m}\nb", f"{m}a{m}", f"a{m}{m}{m}{m}b", f"a {m} \n\n{m}\n b{m}", m)] + ["", None, "\n\n\n", "a\r\r\nb \u3000"]
    want = [H.normalized(t or "") for t in texts]
    assert set(X.BLANKS) == {c for c in map(chr, range(0x110000)) if c.isspace()}
    assert set(X.LINE_ENDS) == {c for c in map(chr, range(0x110000)) if len(f"a{c}b".splitlines()) > 1}
    assert column(spark, texts, X.normalize_body(F.col("v"))) == want
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    assert [r[0] for r in con.execute(f"SELECT {X.normalize_body_sql('v')} FROM t ORDER BY i").fetchall()] == want


def test_long_runs_of_blanks_take_linear_time(spark):
    assert column(spark, ["a" + " " * 300_000 + "b"], F.length(X.normalize_body(F.col("v")))) == [300_003]


def test_dates(spark):
    v = F.col("v")
    got = column(spark, ["2025-01-02", "2025-02-30", "2025-03-04T05:06:07Z", "Wed, 02 Oct 2024 13:00:00 GMT", "2 Oct 2024", "Updated January 5, 2024", "Sep 01, 2025", "soon", "", None],
                 X.source_date(v), X.long_date(v), F.date_format(X.aware_time(v), "yyyy-MM-dd HH:mm:ss"))
    assert got == [
        ("2025-01-02", None, None), (None, None, None), ("2025-03-04", None, "2025-03-04 05:06:07"), ("2024-10-02", None, None), ("2024-10-02", None, None),
        (None, "2024-01-05", None), (None, "2025-09-01", None), (None, None, None), (None, None, None), (None, None, None)]


def test_transient_errors(spark):
    assert column(spark, ["HTTP 429 too many", "HTTP 503", "permanent: HTTP 503", "read timed out", "404 not found", "connection reset by peer", None], S.is_transient(F.col("v"))) == [True, True, False, True, False, True, False]


def test_structured_dates(spark):
    script = '<script type="application/ld+json">%s</script>'
    d = E.json_ld_dates(F.col("v"))
    got = column(spark, [script % '{"@graph":[{"@type":"X"},{"datePublished":"2025-09-10T12:00:00Z","dateModified":"2026-06-24"}]}', script % '[{"dateModified":"soon"}]', script % '{"datePublished":"2024-01-02"}', "<p>none</p>"], d["published"], d["modified"])
    assert got == [("2025-09-10", "2026-06-24"), (None, None), ("2024-01-02", None), (None, None)]


def test_payloads(spark):
    assert column(spark, ["`cmd 1` takes 20 ms of 1.5 GB", "100% of", "5 sheep", None], E.technical_payloads(F.col("v"))) == [["`cmd 1`", "20 ms", "1.5 GB"], [], [], []]


def test_decoded_texts(spark):
    rows = spark.createDataFrame(list(enumerate(["a%2520b", "&amp;lt;x&gt;", "\\*x\\*", "plain", "%26amp%3B", None])), "id int, t string")
    assert {r["id"]: r["text"] for r in C.decode_texts(rows, "id", "t").collect()} == {"0": "a b", "1": "<x>", "2": "*x*", "3": "plain", "4": "&", "5": None}


def test_structure(spark):
    bodies = ["# One\n\n- a\n- b\n1. c\n\n| x | y |\n|---|---|\n\n```\ncode\n```\n> note\n![f](a.png) [l](http://x/y)", "Text ![x](https://h/i.png)\nExplore our catalogue\nlearn more\n## Two\n\n* z", ""]
    df = spark.createDataFrame(list(enumerate(bodies)), "page_id int, body string")
    got = [tuple(r)[1:] for r in Q.page_structure(df, "page_id", "body").orderBy("page_id").collect()]
    assert got == [(1, 3, 1, 1, 1, 1, 1, 1, 0), (1, 1, 0, 0, 0, 1, 0, 0, 2), (0,) * 9]


def test_pages_that_lose_structure_are_regressed(spark):
    whole = "# Title\n\nSome words that stay here\n\n| a | b |\n|---|---|\n| 1 | 2 |\n| 3 | 4 |\n\n![f](x.png)\n"
    rows = [
        (1, whole, whole, "passed"), (2, whole.replace("# Title", "Title"), whole, "regressed"), (3, whole.replace("![f](x.png)", "f x png"), whole, "regressed"),
        (4, whole.replace("| 1 | 2 |\n| 3 | 4 |\n", "1 2 3 4\n"), whole, "regressed"), (5, whole, None, "not_compared"), (6, whole + "\nReturn to TOP \n", None, "regressed"), (7, "", whole, "regressed"),
        (8, whole.replace("#  title", ""), whole.replace("# Title", "#\ttitle "), "passed")]
    df = spark.createDataFrame([r[:3] for r in rows], "k int, c string, r string")
    pages = Q.compared_pages(df, ["k"], "c", "r")
    assert {r["k"]: r["status"] for r in pages.collect()} == {r[0]: r[3] for r in rows}
    s = Q.quality_summary(pages).first().asDict()
    assert (s["page_count"], s["compared_pages"], s["regressed_pages"], s["passed_pages"], s["quality_status"]) == (8, 6, 5, 1, "regressed")
    text = Q.quality_markdown(s, [{"url": "u", "status": "passed", "recall": None, "chrome": 0}])
    assert "| u | passed | n/a | 0 |" in text and "- Page count: 8" in text


def test_heading_titles_and_anchors_take_any_blank(spark):
    from textkiln.functions.markdown import anchors

    assert column(spark, ["#\tA  b\n## C\n#d\n####### e"], X.heading_titles(F.col("v"))) == [["a b", "c"]]
    assert anchors("#\tTitle\n# Title\n## Title two\n<a id='x'></a>") == {"title", "title-1", "title-two", "x"}


def test_private_data_on_pages(spark):
    from textkiln.operators.privacy import page_kinds

    pages = [
        ("<p>write to a.b@mail.org or 10.1.2.3</p>", "email,ipv4"), ('<img alt="key 123456789012">', "cloud-account"), ("<script>a@b.org</script><!-- a@b.org --><p>none</p>", ""),
        ("<a href='https://corp.console.example.net/x'>x</a>", "tenant-host"), ("<a href='https://example-corp.console.example.net/x'>x</a>", ""), ("<code>API_KEY = &quot;abcdefghijklmnop0&quot;</code>", "credential"),
        ("<p>Authorization: Bearer abcdefghijklmnop1</p>", "authorization-header"), ("<pre>--cookie sid=abcdefghijklmnop1</pre>", "session-cookie"), ("<p>vpc-0a1b2c3d and 01234567-89ab-cdef-0123-456789abcdef</p>", "resource-id,uuid"),
        ("-----BEGIN RSA PRIVATE KEY-----", "private-key"), (None, ""),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(pages)], "i int, h string")
    assert [",".join(r["k"]) for r in df.select("i", page_kinds(F.col("h")).alias("k")).orderBy("i").collect()] == [k for _, k in pages]


def test_normal_bodies_try_no_pattern_at_every_character(spark):
    plan = spark.range(1).select(X.normalize_body(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "(?<" not in plan and "\\z" not in plan


def test_normal_bodies_run_patterns_only_where_they_can_match(spark):
    plan = spark.range(1).select(X.normalize_body(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("contains(") >= len(X.LINE_ENDS) and plan.count("case when") >= 2


def test_only_pages_with_one_decision_are_digested(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", "y")], "url string, body string")
    decisions = spark.createDataFrame([("a", "keep", "0", "z")], "url string, disposition string, input_sha256 string, output string")
    out = C.apply_decisions(docs, decisions)
    assert {(r["url"], r["body"], r["error"]) for r in out.collect()} == {("a", "x", "stale decision"), ("b", "y", None)}
    assert "CASE WHEN (n#" in out._jdf.queryExecution().analyzed().toString()


def test_bodies_are_not_dealt_by_the_target_of_a_decision(spark):
    """Most documents have no target; they would all meet in one task."""
    import re

    docs = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z"), ("d", "u")], "document string, body string")
    sha = lambda t: hashlib.sha256(f"{t}\n".encode()).hexdigest()
    decisions = spark.createDataFrame(
        [("a", sha("x"), "alias", None, "b"), ("b", sha("y"), "alias", None, "gone"), ("c", sha("z"), "alias", None, "c"), ("d", sha("u"), "rewrite", "new", None), ("d", sha("u"), "retain", None, None)],
        "document string, input_sha256 string, disposition string, body string, target string")
    out = C.replay(docs, decisions)
    assert {(r["document"], r["disposition"], r["error"]) for r in out.collect()} == {("a", "alias", None), ("b", "fallback", "alias without target"), ("c", "fallback", "alias without target"), ("d", "fallback", "several decisions")}
    assert not re.search(r"Join \[target#\d+\], \[\w+#\d+\], LeftOuter", out._jdf.queryExecution().executedPlan().toString())


def test_pages_are_compared_where_they_are(spark):
    """No row per token is made, so nothing is shuffled or sorted."""
    df = spark.createDataFrame([(1, "one two two three three", "two two two three four"), (2, "one", None), (3, None, "one")], "k int, c string, r string")
    out = Q.compared_pages(df, ["k"], "c", "r")
    assert {r["k"]: r["recall"] for r in out.collect()} == {1: 0.6, 2: None, 3: 0.0}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
