"""Documents on disk: frontmatter and body in Markdown files, sums files, sitemaps and route lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.functions.text import body_hash, normalize_body

#: Keys of the frontmatter in their written order.
ORDER = ("sourceId", "title", "slug", "url", "category", "publication_date", "modification_date", "content_hash", "tags", "description", "language", "canonical_url")


def _scalar(c: Column) -> Column:
    """A JSON string is a valid YAML double-quoted scalar."""
    inner = F.replace(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), inner, F.lit('"')))


def serialize(metadata: dict[str, Column], body: Column) -> Column:
    """Document text: frontmatter in order (with the body's hash) and the normalised body."""
    values = {**metadata, "content_hash": body_hash(body)}
    unknown = set(values) - set(ORDER)
    if unknown:
        raise ValueError(f"unknown metadata: {sorted(unknown)}")
    lines = [F.concat(F.lit(f"{k}: "), _scalar(values[k].cast("string"))) for k in ORDER if k in values]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n\n"), normalize_body(body))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _undone(plain: Column) -> Column:
    for old, new in (("\\\\", "\x00"), ('\\"', '"'), ("\\n", "\n"), ("\\t", "\t"), ("\x00", "\\")):
        plain = F.replace(plain, F.lit(old), F.lit(new))
    return plain


def split(document: Column) -> tuple[Column, Column]:
    """Metadata (a map of strings) and body of a document; null metadata without frontmatter.

    Give a column of a table: an expression would be made again for each of its uses.
    """
    head = F.regexp_extract(document, r"(?s)^---\n(.*?)\n---\n", 1)
    body = F.regexp_extract(document, r"(?s)^---\n.*?\n---\n\n?(.*)$", 1)

    def value(line: Column) -> Column:
        def read(raw: Column) -> Column:
            return F.when(raw == "null", F.lit(None)).when(raw.startswith('"'), _undone(F.regexp_extract(raw, r'(?s)^"(.*)"$', 1))).otherwise(raw)

        return _once(F.regexp_extract(line, r"(?s)^[^:]+: ?(.*)$", 1), read)

    def entries(head: Column) -> Column:
        return F.transform(F.filter(F.split(head, "\n"), lambda x: x.contains(":")), lambda x: F.struct(F.regexp_extract(x, r"^([^:]+):", 1).alias("key"), value(x).alias("value")))

    return _once(head, lambda h: F.when(h != "", F.map_from_entries(entries(h)))), F.when(head != "", normalize_body(body))


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """``path, metadata, body`` of every ``content/<source>/**/index.md`` below ``root``; the last path of a URL stays."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "index.md").text(f"{root}/content", wholetext=True)
    meta, body = split(F.col("value"))
    docs = files.select(F.regexp_extract(F.col("_metadata.file_path"), r"(content/.*)$", 1).alias("path"), meta.alias("metadata"), body.alias("body"))
    last = docs.groupBy(F.col("metadata")["url"].alias("url")).agg(F.max("path").alias("path"))
    return docs.join(last.select("path"), "path", "left_semi")


def parse_sums(text: DataFrame) -> DataFrame:
    """``name, sha256, error`` of lines of ``<sha256>  <name>`` (column ``value``): bad lines and repeated names are errors."""
    one = text.select(F.regexp_extract("value", r"^([0-9a-f]{64})  (.+)$", 1).alias("sha256"), F.regexp_extract("value", r"^([0-9a-f]{64})  (.+)$", 2).alias("name"), "value").where("value != ''")
    n = one.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return one.join(n, "name").select("name", "sha256", F.when(F.col("sha256") == "", "format").when(F.col("n") > 1, "duplicate").alias("error"))


def sitemap_urls(xml: DataFrame, column: str = "xml") -> DataFrame:
    """``url, lastmod`` of the entries of sitemaps."""
    loc, entries = r"(?s)<loc>\s*(.*?)\s*</loc>", F.regexp_extract_all(column, F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))
    e = xml.select(F.explode(entries).alias("e"))
    unescaped = F.replace(F.regexp_extract("e", loc, 1), F.lit("&amp;"), F.lit("&"))
    return e.select(unescaped.alias("url"), F.nullif(F.regexp_extract("e", r"(?s)<lastmod>\s*(.*?)\s*</lastmod>", 1), F.lit("")).alias("lastmod")).groupBy("url").agg(F.max("lastmod").alias("lastmod"))


def navigation_routes(pages: DataFrame, html: str, prefix: str, most: int = 20_000) -> DataFrame:
    """Distinct routes of the JSON in ``<script id="__NEXT_DATA__">``; unsafe routes are dropped, too many are an error."""
    data = F.regexp_extract(html, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    routes = F.from_json(F.get_json_object(data, "$.props.pageProps.routes"), "array<string>")
    r = pages.select(F.explode(routes).alias("route")).distinct()
    safe = ~F.col("route").rlike(r"[?#%\\]") & ~F.col("route").contains("//") & ~F.col("route").rlike(r"(^|/)\.\.(/|$)") & F.col("route").startswith(prefix)
    out = r.where(safe)
    return out.where(F.assert_true(out.select(F.count(F.lit(1)) <= most).scalar(), F.lit("too many routes")).isNull())
