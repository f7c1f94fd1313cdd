"""Queries over page URLs: canonical forms, scope, classification, paths and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.functions import urls as U
from textkiln.operators.matching import excluded_by_prefix, longest_marker, longest_prefix, rules_table
from textkiln.sources.tables import table

#: Reviewed prefixes that are left out, as canonical host and path.
EXCLUDED = ("example.net/es", "example.org/de", "tionsh.example.net/en/1")
#: Hosts whose pages may be published.
PUBLIC_HOSTS = ("ththre.example.com", "m.ththth.example.net", "thther.example.org", "tionsh.example.net")
#: path_prefix, product, content_type, task_type
CLASSES = (("/", "core", "page", "read"), ("/en", "core", "article", "read"), ("/de", "core", "article", "read"), ("/fr", "edge", "article", "learn"), ("/en/1", "edge", "guide", "configure"), ("/es", "edge", "guide", "operate"))
#: path_marker, content_type, task_type
MARKERS = ((".html/", "file", "download"), ("/99", "reference", "look_up"), ("/en/9", "appendix", "look_up"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url")


def canonical_urls(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).select("page_id", U.canonicalize(F.col("url")).alias("canonical_url"))


_CANON = """regexp_extract(url, '^[a-z]+') || '://' || lower(regexp_extract(url, '://([^/?#]*)', 1))
 || CASE WHEN rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/') = '' THEN '/' ELSE rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/') END
 || CASE WHEN regexp_extract(url, '\\?([^#]*)', 1) = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&')), '&') END"""
_PATH = "CASE WHEN rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/') = '' THEN '/' ELSE rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/') END"
_HOST = "lower(regexp_extract(url, '://([^/?#]*)', 1))"


def url_policy_filter(spark: SparkSession, sf: str) -> DataFrame:
    p = U.parts(F.col("url"))
    pages = _pages(spark, sf).withColumn("key", F.concat(p["host"], U.canonical_path(p["path"])))
    return excluded_by_prefix(pages, "key", EXCLUDED).select("page_id", F.col("key").alias("canonical"), "excluded")


_POLICY_SQL = f"""SELECT page_id, {_HOST} || {_PATH} AS canonical,
 {' OR '.join(f"({_HOST} || {_PATH}) = '{x}' OR starts_with({_HOST} || {_PATH}, '{x}/')" for x in EXCLUDED)} AS excluded FROM pages"""


def classify_longest_prefix(spark: SparkSession, sf: str) -> DataFrame:
    pages = _pages(spark, sf).withColumn("path", U.canonical_path(U.parts(F.col("url"))["path"]))
    rules = rules_table(spark, CLASSES, "path_prefix string, product string, content_type string, task_type string")
    marks = rules_table(spark, MARKERS, "path_marker string, content_type string, task_type string")
    out = longest_marker(longest_prefix(pages, "path", rules, "path_prefix", "rule"), "path", marks, "path_marker", "mark")
    return out.select(
        "page_id", "path", F.col("rule.path_prefix").alias("path_prefix"), F.col("rule.product").alias("product"),
        F.coalesce("mark.content_type", "rule.content_type").alias("content_type"), F.coalesce("mark.task_type", "rule.task_type").alias("task_type"))


def _values(rows: tuple) -> str:
    return ", ".join("(" + ", ".join("'" + str(x) + "'" for x in r) + ")" for r in rows)


_CLASS_SQL = f"""WITH p AS (SELECT page_id, {_PATH} AS path FROM pages),
c(path_prefix, product, content_type, task_type) AS (VALUES {_values(CLASSES)}),
m(path_marker, content_type, task_type) AS (VALUES {_values(MARKERS)}),
r AS (SELECT page_id, path, arg_max(c, length(path_prefix)) AS c FROM p JOIN c ON path = path_prefix OR starts_with(path, rtrim(path_prefix, '/') || '/') GROUP BY ALL),
k AS (SELECT page_id, arg_max(m, length(path_marker)) AS m FROM p JOIN m ON contains(path || '/', path_marker) GROUP BY page_id)
SELECT p.page_id, p.path, r.c.path_prefix AS path_prefix, r.c.product AS product, coalesce(k.m.content_type, r.c.content_type) AS content_type,
 coalesce(k.m.task_type, r.c.task_type) AS task_type FROM p LEFT JOIN r USING (page_id) LEFT JOIN k USING (page_id)"""


def stable_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).select("page_id", U.stable_path(F.col("url")).alias("path"))


_STABLE_SQL = f"""SELECT page_id, CASE WHEN len(s) = 0 THEN 'index' ELSE array_to_string(s, '/') END AS path FROM (
 SELECT page_id, list_transform(list_filter(string_split({_PATH}, '/'), lambda x: x <> ''),
  lambda x: coalesce(nullif(regexp_replace(regexp_replace(x, '[^A-Za-z0-9._-]+', '-', 'g'), '^[.-]+|[.-]+$', '', 'g'), ''), 'index')) AS s FROM pages)"""


def lowest_hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The 100 canonical URLs of lowest SHA-256: a sample that doesn't depend on order or partitions."""
    urls = _pages(spark, sf).select(U.canonicalize(F.col("url")).alias("url")).distinct()
    return urls.withColumn("digest", F.sha2("url", 256)).orderBy("digest", "url").limit(100)


def source_inference(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).select("page_id", U.infer_source(F.col("url")).alias("s")).select("page_id", "s.source", "s.error")


_IN = {r.source: f"(starts_with(url, 'https://') AND ({_HOST} = '{r.host}' OR ends_with({_HOST}, '.{r.host}')) AND ({_PATH} = '{r.path}' OR starts_with({_PATH}, '{r.path}/')))" for r in U.ROOTS}
_INFER_SQL = f"""SELECT page_id, CASE WHEN n = 1 THEN s END AS source, CASE WHEN n > 1 THEN 'several sources' END AS error FROM (
 SELECT page_id, {' + '.join(f'{c}::INT' for c in _IN.values())} AS n, CASE {' '.join(f"WHEN {c} THEN '{s}'" for s, c in _IN.items())} END AS s FROM pages)"""


def public_urls(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).where(U.public_url(F.col("url"), list(PUBLIC_HOSTS))).select("page_id", "url")


def asset_names(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).select("page_id", U.asset_extension(F.col("url"), F.lit("text/html; charset=utf-8")).alias("extension"))


QUERIES = {f.__name__: f for f in (canonical_urls, url_policy_filter, classify_longest_prefix, stable_paths, lowest_hash_sample, source_inference, public_urls, asset_names)}
ORACLE_SQL = {
    "canonical_urls": f"SELECT page_id, {_CANON} AS canonical_url FROM pages",
    "url_policy_filter": _POLICY_SQL,
    "classify_longest_prefix": _CLASS_SQL,
    "stable_paths": _STABLE_SQL,
    "lowest_hash_sample": f"SELECT url, sha256(url) AS digest FROM (SELECT DISTINCT {_CANON} AS url FROM pages) ORDER BY digest, url LIMIT 100",
    "source_inference": _INFER_SQL,
    "public_urls": f"SELECT page_id, url FROM pages WHERE starts_with(url, 'https://') AND {_HOST} IN {PUBLIC_HOSTS} AND NOT contains(url, '?') AND NOT contains(url, '#')",
    "asset_names": f"SELECT page_id, coalesce(nullif(lower(regexp_extract({_PATH}, '(\\.[A-Za-z0-9]{{1,10}})$', 1)), ''), '.bin') AS extension FROM pages",
}
