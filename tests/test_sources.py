import io
import struct
import tarfile

import pytest
from pyspark.sql import functions as F

from textkiln.functions import text as X
from textkiln.functions import urls as U
from textkiln.operators import graph, pages, resolution, state
from textkiln.sources import archive, documents


def test_release_roundtrip(spark, tmp_path):
    rows = spark.createDataFrame([(f"content/s/{i}/index.md", f"text {i}".encode()) for i in range(20)], "name string, content binary")
    a = archive.write_release(rows.repartition(5), str(tmp_path / "a.tar.gz"))
    b = archive.write_release(rows.orderBy(F.desc("name")), str(tmp_path / "b.tar.gz"))
    assert a == b
    members = archive.read_release(spark, str(tmp_path / "a.tar.gz"))
    assert members.count() == 21 and archive.verify_release(members).count() == 0


def test_tampered_release(spark, tmp_path):
    p = tmp_path / "x.tar.gz"
    with tarfile.open(p, "w:gz") as t:
        for name, data in (("a.md", b"changed"), ("SHA256SUMS", b"0" * 64 + b"  a.md\n" + b"0" * 64 + b"  b.md\n")):
            i = tarfile.TarInfo(name)
            i.size = len(data)
            t.addfile(i, io.BytesIO(data))
    got = {(r["name"], r["error"]) for r in archive.verify_release(archive.read_release(spark, str(p))).collect()}
    assert got == {("a.md", "changed"), ("b.md", "missing")}


def test_unsafe_member(spark, tmp_path):
    rows = spark.createDataFrame([("../x", b"")], "name string, content binary")
    with pytest.raises(ValueError):
        archive.write_release(rows, str(tmp_path / "y.tar.gz"))


def test_gif_metadata():
    head = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6)
    image = b"\x2c" + bytes(9) + b"\x02" + b"\x01\x00\x00"
    comment = b"\x21\xfe\x03abc\x00"
    assert archive.strip_gif_metadata(head + comment + image + b"\x3b") == head + image + b"\x3b"


def test_svg():
    assert archive.svg_problems('<svg><path d="M0"/></svg>') == []
    assert archive.svg_problems('<svg onload="x()"><script/></svg>') == ["script", "handler"]


def test_documents_on_disk(spark, tmp_path):
    meta = {"title": F.lit('Café "x"\\y'), "url": F.lit("https://example.com/a"), "description": F.lit(None).cast("string")}
    text = spark.range(1).select(documents.serialize(meta, F.lit("a  \r\n\n\n\nb")).alias("t")).first()["t"]
    d = tmp_path / "content" / "s" / "a"
    d.mkdir(parents=True)
    (d / "index.md").write_text(text)
    r = documents.read_documents(spark, str(tmp_path)).first()
    assert r["path"] == "content/s/a/index.md" and r["body"] == "a\n\nb\n"
    assert r["metadata"]["title"] == 'Café "x"\\y' and r["metadata"]["description"] is None


def test_sums_sitemaps_routes(spark):
    h = "a" * 64
    sums = spark.createDataFrame([(f"{h}  a",), (f"{h}  b",), (f"{h}  b",), ("bad",)], "value string")
    assert {(r["name"], r["error"]) for r in documents.parse_sums(sums).collect()} == {("a", None), ("b", "duplicate"), ("", "format")}
    xml = spark.createDataFrame([("<urlset><url><loc>https://e/a?x=1&amp;y=2</loc><lastmod>2025-01-01</lastmod></url><url><loc> https://e/b </loc></url></urlset>",)], "xml string")
    assert {tuple(r) for r in documents.sitemap_urls(xml).collect()} == {("https://e/a?x=1&y=2", "2025-01-01"), ("https://e/b", None)}
    page = spark.createDataFrame([('<script id="__NEXT_DATA__" type="x">{"props":{"pageProps":{"routes":["/d/a","/d/../b","/x","/d/a?q"]}}}</script>',)], "html string")
    assert [r["route"] for r in documents.navigation_routes(page, "html", "/d").collect()] == ["/d/a"]


@pytest.mark.parametrize("url, want", [
    ("HTTPS://U:p@Example.com:443//a//b/?b=2&a=&a=1#f", "https://example.com/a/b?a=&a=1&b=2"),
    ("http://example.com:443", "http://example.com/"),
    ("https://example.com:8080/x/", "https://example.com:8080/x"),
    ("https://example.com/a b/é?q=a b", "https://example.com/a%20b/%C3%A9?q=a+b"),
])
def test_canonical_url(spark, url, want):
    once = spark.range(1).select(U.canonicalize(F.lit(url)).alias("u"))
    assert once.first()["u"] == want
    assert once.select(U.canonicalize(F.col("u"))).first()[0] == want


def test_normalized_body_is_idempotent(spark):
    for t in ("a \t\r\nb\r\r\n\n\n c", "", "\n\n", None, "x \ny"):
        a = spark.range(1).select(X.normalize_body(F.lit(t).cast("string")).alias("b"))
        assert a.select(X.normalize_body(F.col("b"))).first()[0] == a.first()[0]


@pytest.mark.parametrize("status, prior, want", [
    ("failed", None, "unavailable"), ("failed", (0, 0), "carried_forward"), ("removed_not_found", (0, 0), "removal_candidate"),
    ("removed_navigation", (1, 1), "confirmed_removal"), ("removed_not_found", None, "unavailable"), ("failed", (3, 1), "carried_forward"),
])
def test_reconcile_table(spark, status, prior, want):
    s = spark.createDataFrame([("u", status)], "url string, status string")
    p = spark.createDataFrame([("u", "p", "h", "2025", *prior)] if prior else [], "url string, path string, sha256 string, last_success_at string, failures int, terminals int")
    assert state.reconcile(s, p).first()["status"] == want


def test_frontier_ties(spark):
    q = spark.createDataFrame([("a", "s", "2025-01-01T00:00:00Z", ["x"]), ("b", "s", "2025-01-01T00:00:00Z", ["x"]), ("c", "s", "2024-01-01T00:00:00Z", ["x"]), ("d", "s", "2024-01-01", ["x"]), ("e", "t", "2020-01-01T00:00:00+02:00", ["x"])], "queue string, source string, started_at string, identities array<string>")
    assert {r["queue"]: r["verdict"] for r in state.frontier(q).collect()} == {"a": "selected", "b": "selected", "c": "deferred", "d": "uncertain", "e": "selected"}


def test_closure_ends_on_cycles(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src int, dst int")
    got = {tuple(r) for r in graph.reachable(e, spark.createDataFrame([(1,)], "node int")).collect()}
    assert got == {(1, 0), (2, 1), (3, 2), (4, 3)}


def test_pack_puts_large_rows_alone(spark):
    r = spark.createDataFrame([("g", i, s) for i, s in enumerate([5, 100, 3, 3, 3, 1])], "g string, i int, s long")
    assert [x["bin"] for x in resolution.pack(r, "g", "i", "s", 7, 2).orderBy("i").collect()] == [0, 1, 2, 2, 3, 3]


def test_bad_page_is_a_row():
    assert pages.render_page(1, None, None)[5] == "content"
    deep = "<div>" * 20_000
    assert pages.render_page(2, "u", deep)[8] is None or "Recursion" in pages.render_page(2, "u", deep)[8]


def test_a_document_is_written_once_however_often_its_parts_are_read(spark):
    from textkiln.plans.contents import frontmatter_roundtrip

    plan = frontmatter_roundtrip(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("sha2(") <= 3
