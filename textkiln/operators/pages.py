"""Pages to Markdown and Markdown to spans, in Arrow batches; the parsers live in ``textkiln.functions``.

Only the columns a parser needs go to Python; a page that can't be parsed gives an error, not a failed job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from textkiln.functions import html as H
from textkiln.functions import markdown as M

#: Rows that a parser takes at once; what it makes of them goes back before it takes more.
ROWS = 64


def mapped(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``run`` over frames of at most ``ROWS``: a batch from the JVM holds up to 10,000 rows, and neither their objects nor their blocks are made at once."""
    of = to_arrow_schema(StructType.fromDDL(schema))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                yield b.slice(i, ROWS).to_pandas()

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in run(slices(batches)):
            yield pa.RecordBatch.from_pandas(f, schema=of, preserve_index=False)

    return df.mapInArrow(parsed, schema)


RENDERED = "page_id long, url string, markdown string, assets array<struct<url:string,placeholder:string,alt:string>>, links array<string>, verdict string, title string, description string, error string"


@dataclass(frozen=True)
class Extractor:
    """What a source does between parsing and rendering: choose the container, drop its own chrome."""

    name: str
    container: Callable[[H.Node], H.Node] = H.container
    drop: Callable[[H.Node], bool] = lambda n: False


#: Extension point: extractors by source.
EXTRACTORS: dict[str, Extractor] = {}


def register(extractor: Extractor) -> Extractor:
    if extractor.name in EXTRACTORS:
        raise ValueError(f"extractor registered twice: {extractor.name}")
    EXTRACTORS[extractor.name] = extractor
    return extractor


DEFAULT = register(Extractor("default"))
register(Extractor("marketing", drop=lambda n: any(k in " ".join(n.classes()) for k in ("promo", "gated", "sticky", "cookie"))))
register(Extractor("article", drop=lambda n: n.tag in ("nav", "header", "footer", "button") or n.text().strip().lower() == "select service"))


register(Extractor("post", container=H.clean_post))


def render_page(page_id: int, url: str | None, html: str | None, extractor: Extractor = DEFAULT) -> tuple:
    try:
        root = H.parse(html or "")
        title = next((n.strings() for n in root.walk() if n.tag == "title"), "")
        metas = {n.attrs.get("name") or n.attrs.get("property"): n.attrs.get("content", "") for n in root.walk() if n.tag == "meta"}
        main = extractor.container(root)
        H.remove(main, lambda n: H.is_chrome(n) or extractor.drop(n))
        links = sorted({n.attrs["href"] for n in main.walk() if n.tag == "a" and n.attrs.get("href")})
        verdict = H.classify(title, main.strings(), H.page_measures(main))
        body, assets = H.render(main, url or "")
        return (page_id, url, body, assets, links, verdict, metas.get("og:title") or title, metas.get("description"), None)
    except Exception as e:  # whatever a parser meets in one page is that page's error
        return (page_id, url, None, [], [], None, None, None, f"{type(e).__name__}: {e}")


def render_pages(pages: DataFrame, source: str = "default") -> DataFrame:
    """``page_id, url, html`` -> Markdown, images, links, verdict and metadata of each page."""
    extractor = EXTRACTORS[source]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [render_page(*x, extractor=extractor) for x in zip(f["page_id"], f["url"], f["html"])]
            yield pd.DataFrame(rows, columns=["page_id", "url", "markdown", "assets", "links", "verdict", "title", "description", "error"])

    return mapped(pages.select("page_id", "url", "html"), run, RENDERED)


BLOCKS = "id long, address string, kind string, start int, end int, sha256 string, estimated_tokens int, text string"


def markdown_blocks(docs: DataFrame, key: str, body: str) -> DataFrame:
    """One row for each block, section, table row and reference definition of each body."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(k, b.location, b.kind, b.start, b.end, b.sha256, (len(b.text) + 3) // 4, b.text) for k, t in zip(f["k"], f["b"]) for b in M.addressed(t or "")]
            yield pd.DataFrame(rows, columns=["id", "address", "kind", "start", "end", "sha256", "estimated_tokens", "text"])

    return mapped(docs.select(F.col(key).cast("long").alias("k"), F.col(body).alias("b")), run, BLOCKS)


def markdown_links(docs: DataFrame, key: str, body: str) -> DataFrame:
    """``id, kind, target``: links and media of each body."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(k, kind, x) for k, t in zip(f["k"], f["b"]) for kind, xs in (("link", M.links(t or "")), ("media", M.media(t or ""))) for x in xs]
            yield pd.DataFrame(rows, columns=["id", "kind", "target"])

    return mapped(docs.select(F.col(key).cast("long").alias("k"), F.col(body).alias("b")), run, "id long, kind string, target string")


def markdown_sections(docs: DataFrame, key: str, body: str, most: int = 48_000) -> DataFrame:
    """``id, part, start, end``: line spans of each body, cut at headings."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(k, i, a, b) for k, t in zip(f["k"], f["b"]) for i, (a, b) in enumerate(M.sections(t or "", most))], columns=["id", "part", "start", "end"])

    return mapped(docs.select(F.col(key).cast("long").alias("k"), F.col(body).alias("b")), run, "id long, part int, start int, end int")


def guarded_removals(docs: DataFrame, rules: DataFrame, key: str, body: str) -> DataFrame:
    """Bodies without the blocks that rules (``id, location, sha256``) name; a stale rule gives ``error`` and keeps the body.

    Rules join their documents as one array each, so the edit of a document is one call.
    """
    r = rules.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("location", "sha256"))).alias("rules"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, t, rs in zip(f["k"], f["b"], f["rules"]):
                try:
                    rows.append((k, M.remove_blocks(t, [(x["location"], x["sha256"]) for x in rs]) if rs is not None else t, None))
                except ValueError as e:
                    rows.append((k, t, str(e)))
            yield pd.DataFrame(rows, columns=["id", "body", "error"])

    joined = docs.select(F.col(key).cast("long").alias("k"), F.col(body).alias("b")).join(r, F.col("k") == F.col("id"), "left").select("k", "b", "rules")
    return mapped(joined, run, "id long, body string, error string")


def unlinked(docs: DataFrame, retired: DataFrame, key: str, body: str, retired_url: str) -> DataFrame:
    """Bodies whose links to retired URLs are replaced by their labels, and how many were.

    Links are exploded and met with the retired URLs by an equi-join, so that list may be of any size.
    """
    wanted = markdown_links(docs, key, body).where("kind = 'link'").join(retired.select(F.col(retired_url).alias("target")).distinct(), "target", "left_semi").groupBy("id").agg(F.collect_set("target").alias("gone"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, t, gone in zip(f["k"], f["b"], f["gone"]):
                chosen = [r for r in M.references(t or "") if r["url"] in set(gone)] if gone is not None else []
                rows.append((k, M.unlink(t, chosen) if chosen else t, len(chosen)))
            yield pd.DataFrame(rows, columns=["id", "body", "unlinked"])

    joined = docs.select(F.col(key).cast("long").alias("k"), F.col(body).alias("b")).join(wanted, F.col("k") == F.col("id"), "left").select("k", "b", "gone")
    return mapped(joined, run, "id long, body string, unlinked int")


def resolve_redirects(links: DataFrame, redirects: DataFrame, most: int = 100) -> DataFrame:
    """``page_id, link, final``: links with their redirect target where there is one; only the first ``most`` of a page are asked for."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("page_id").orderBy("link"))
    asked = links.select("page_id", "link").distinct().withColumn("__n", place)
    r = redirects.groupBy("src").agg(F.min("dst").alias("dst"))
    return asked.join(r, F.col("link") == F.col("src"), "left").select("page_id", "link", F.when(F.col("__n") <= most, F.coalesce("dst", "link")).otherwise(F.col("link")).alias("final"))


def stable_json(value: object) -> bytes:
    """JSON bytes that don't depend on key order: two blanks, sorted keys, one final line feed."""
    import json

    return (json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode()


def digest(value: object) -> str:
    return hashlib.sha256(stable_json(value)).hexdigest()


def request_hashes(rows: DataFrame, key: str) -> DataFrame:
    """``key, sha256`` of each row's compact JSON with sorted keys, characters unescaped."""
    import json

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            bodies = [json.dumps(json.loads(j), ensure_ascii=False, sort_keys=True, separators=(",", ":")) for j in f["j"]]
            yield pd.DataFrame({"k": f["k"], "sha256": [hashlib.sha256(b.encode()).hexdigest() for b in bodies]})

    body = F.to_json(F.struct(*[c for c in rows.columns if c != key]))
    return mapped(rows.select(F.col(key).cast("string").alias("k"), body.alias("j")), run, "k string, sha256 string").withColumnRenamed("k", key)
