"""Queries about what a policy retires; policies are made of the tables' own values."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions.text import folded_sql
from textkiln.operators import retirement as T
from textkiln.sources.tables import table

_WORDS = ("released under the", "all rights reserved", "confidential")


def _docs(spark, sf):
    return table(spark, sf, "documents")


def policy_texts(spark, sf):
    return T.policy_texts(_docs(spark, sf), "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("sha256"))


def excluded_topics(spark, sf):
    """Pages of blogs are listed; one path is retired, and numbers up to 40 are identities."""
    p = table(spark, sf, "pages")
    ids = spark.range(41).select(F.col("id").cast("string").alias("identity"))
    return T.excluded_topics(p, "page_id", "url", p.where("url like '%://blog.%'").select("url"), ("/fr/[0-9]*5",), ids)


def obsolete_texts(spark, sf):
    """Rendered links of whole pages against the first words of documents as retired routes."""
    p = table(spark, sf, "pages")
    first = _docs(spark, sf).where("lang = 'en'").select(F.regexp_extract("text", r"^[A-Za-z]+", 0).alias("w")).where("w != ''").distinct()
    hosts = p.select(F.regexp_extract(F.lower("url"), "://([^/?#]*)", 1).alias("h")).distinct()
    # a host has few retired routes here: those that begin as it does
    near = hosts.join(first.withColumn("w", F.lower("w")), F.substring("h", 1, 2) == F.substring("w", 1, 2)).select(F.concat("h", F.lit("/"), "w").alias("prefix"))
    return T.obsolete_texts(p, "page_id", "html", "url", ("cheap-pills",), near)


def limitation_notices(spark, sf):
    """Lines of documents as quoted notes, in which what is "of the" something is said not to support it."""
    lines = _docs(spark, sf).select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "t"))
    note = F.concat(F.lit("> **Note:** "), F.replace("t", F.lit(" of the "), F.lit(" does not support the ")))
    return lines.where(T.limitation_notice(note, "the|an", ("ingth", "released"))).select("doc_id", "line")


def legacy_pages(spark, sf):
    """Documents with a title from their first line's length, tags from their source and a life cycle from their language."""
    d, n = _docs(spark, sf), F.length(F.split_part("text", F.lit("\n"), F.lit(1)))
    title = F.when(n % 11 == 0, F.lit("Guide (Legacy)")).when(n % 13 == 0, F.lit("A legacy site here")).otherwise(F.lit("Guide"))
    why = T.legacy_reasons(title, F.col("text"), F.col("source"), F.array(F.when(F.col("source").endswith("7"), F.lit("Retired")), F.col("source")), F.when(F.col("lang") == "es", F.lit("deprecated")), ("site", "workflow"), _WORDS)
    return d.select("doc_id", F.array_join(why, "+").alias("why")).where("why != ''")


def retired_providers(spark, sf):
    hit = T.retired_provider(F.col("text"), "released under the", r"(^|[^a-z])heing([^a-z]|$)", r"(^|[^a-z])the([^a-z]|$)", r"(^|[^a-z])thining([^a-z]|$)")
    return _docs(spark, sf).where(hit).select("doc_id")


def retired_references(spark, sf):
    p = table(spark, sf, "pages")
    return T.retired_references(p, "page_id", "url", p.where("page_id % 5 = 0").select("url"), p.where("page_id % 7 = 0").select("url"), p.where("url like '%.org/%'").select(F.concat(F.regexp_extract(F.lower("url"), "://([^/?#]*)", 1), F.lit("/fr")).alias("prefix")))


def irrelevant_sources(spark, sf):
    e = table(spark, sf, "events")
    hit = T.irrelevant(F.when(F.col("event_type").isin("click", "view"), "exclude").otherwise("keep"), F.when(F.col("value") < 30, "complete").otherwise("partial"), F.when(F.col("user_id").isNotNull(), "independent").otherwise("uncertain"))
    return e.groupBy("event_type").agg(F.count_if(hit).alias("eligible"), F.count(F.lit(1)).alias("n"))


def reviewed_exclusions(spark, sf):
    """French and German documents were reviewed; the text of some reviews is another document's."""
    d = _docs(spark, sf).select(F.concat(F.lit("https://d/"), "doc_id").alias("url"), F.col("text").alias("body"), F.sha2("source", 256).alias("source_sha256"), F.array(F.sha2("lang", 256)).alias("media"), "doc_id", "lang", "n_chars")
    r = d.where("lang in ('fr', 'de')").select(F.concat(F.upper("url"), F.lit("/?x")).alias("url"), F.sha2(F.when(F.col("n_chars") % 9 == 0, F.lit("x")).otherwise(F.col("body")), 256).alias("input_sha256"), "source_sha256", F.when(F.col("lang") == "de", F.concat("media", "media")).when(F.col("n_chars") % 2 == 0, F.col("media")).otherwise(F.array(F.lit("y"))).alias("media"))
    return T.reviewed_exclusions(d, r)


def media_decisions(spark, sf):
    l = table(spark, sf, "lineitem")
    media = l.select(F.col("l_orderkey").cast("string").alias("document"), F.col("l_partkey").cast("string").alias("sha256"))
    reviews = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("sha256"), F.when(F.col("p_size") % 2 == 0, "remove").otherwise("keep").alias("disposition"), F.when(F.col("p_size") > 25, F.array((F.col("p_partkey") % 97).cast("string"), F.col("p_partkey").cast("string"))).alias("documents"))
    again = reviews.select("sha256", F.lit("mask").alias("disposition"), F.array((F.col("sha256").cast("long") % 89).cast("string")).alias("documents"))
    return T.media_decisions(media, reviews.unionByName(again))


def unique_json(spark, sf):
    """Properties of events; a purchase names a key twice, an error isn't closed."""
    e = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "purchase", F.concat(F.lit('{"a": {"k": 1, "k": 2}, "p": '), "props", F.lit("}"))).when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(F.col("props"))
    return T.unique_json(e.select("event_id", text.alias("text")), "event_id", "text").select("event_id", F.coalesce("error", F.lit("ok")).alias("outcome"), F.sha2("json", 256).alias("sha256"))


def known_contents(spark, sf):
    d = _docs(spark, sf).select("lang", "source", "n_chars", F.sha2("text", 256).alias("sha256"), "doc_id")
    return T.known_contents(d, d.where("doc_id % 2 = 1"), ("lang", "source", "n_chars", "sha256")).select("doc_id", "known")


def imported_provenance(spark, sf):
    url = lambda c: F.concat(F.lit("u"), F.col(c)).alias("url")
    return T.imported_provenance(table(spark, sf, "customer").select(url("c_custkey")), table(spark, sf, "orders").select(F.concat(F.lit("u"), F.col("o_custkey") * 2).alias("url")), table(spark, sf, "customer").where("c_acctbal < 0").select(url("c_custkey"), F.col("c_mktsegment").alias("origin")))


QUERIES = {f.__name__: f for f in (
    policy_texts, excluded_topics, obsolete_texts, limitation_notices, legacy_pages, retired_providers, retired_references, irrelevant_sources, reviewed_exclusions, media_decisions,
    unique_json, known_contents, imported_provenance)}

_PLACE = lambda c: f"rtrim(regexp_extract(lower({c}), '^[a-z]+://([^?#]*)', 1), '/')"
_ANY = "regexp_matches({}, '(?i)released under the|all rights reserved|confidential')"
ORACLE_SQL = {
    "policy_texts": f"SELECT doc_id, sha256({folded_sql('text')}) AS sha256 FROM documents",
    "excluded_topics": f"""SELECT * FROM (SELECT page_id, CASE WHEN {_PLACE('url')} IN (SELECT {_PLACE('url')} FROM pages WHERE url LIKE '%://blog.%') THEN 'url' WHEN regexp_matches(url, '(?i)/fr/[0-9]*5') THEN 'text'
 WHEN len(list_filter(string_split({_PLACE('url')}, '/'), lambda x: try_cast(x AS INT) BETWEEN 0 AND 40 AND try_cast(x AS INT)::VARCHAR = x)) > 0 THEN 'identity' END AS reason FROM pages) WHERE reason IS NOT NULL""",
    "limitation_notices": """SELECT doc_id, line::INT AS line FROM (SELECT doc_id, lower('> **Note:** ' || replace(x, ' of the ', ' does not support the ')) AS t, line FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM documents))
 WHERE contains(t, ' does not support the ') AND NOT regexp_matches(t, 'https?://|`|\\]\\(|<|\\[.*\\]') AND NOT contains(t, 'ingth') AND NOT contains(t, 'released')""",
    "legacy_pages": f"""SELECT * FROM (SELECT doc_id, array_to_string(list_filter([CASE WHEN length(split_part(text, chr(10), 1)) % 11 = 0 OR length(split_part(text, chr(10), 1)) % 13 = 0 THEN 'label' END, CASE WHEN lang = 'es' THEN 'lifecycle' END,
 CASE WHEN {_ANY.format('text')} THEN 'scope' END, CASE WHEN ends_with(source, '7') THEN 'tag' END], lambda x: x IS NOT NULL), '+') AS why FROM documents) WHERE why <> ''""",
    "retired_providers": """SELECT doc_id FROM documents WHERE regexp_matches(lower(text), 'released under the') OR regexp_matches(lower(text), '(^|[^a-z])heing([^a-z]|$)')
 OR len(list_filter(string_split(lower(text), chr(10)), lambda x: regexp_matches(x, '(^|[^a-z])the([^a-z]|$)') AND regexp_matches(x, '(^|[^a-z])thining([^a-z]|$)'))) > 0""",
    "retired_references": f"""WITH q AS (SELECT page_id, {_PLACE('url')} AS p FROM pages WHERE NOT regexp_matches(url, '[?%]')), x AS (SELECT DISTINCT regexp_extract(lower(url), '://([^/?#]*)', 1) || '/fr' AS prefix FROM pages WHERE url LIKE '%.org/%')
SELECT * FROM (SELECT page_id, CASE WHEN p IN (SELECT {_PLACE('url')} FROM pages WHERE page_id % 5 = 0) THEN 'exact' WHEN p IN (SELECT {_PLACE('url')} FROM pages WHERE page_id % 7 = 0) THEN 'alias'
 WHEN EXISTS (SELECT 1 FROM x WHERE p = prefix OR starts_with(p, prefix || '/')) THEN 'prefix' END AS "by" FROM q) WHERE "by" IS NOT NULL""",
    "irrelevant_sources": "SELECT event_type, count(*) FILTER (event_type IN ('click', 'view') AND value < 30 AND user_id IS NOT NULL) AS eligible, count(*) AS n FROM events GROUP BY event_type",
    "reviewed_exclusions": """SELECT 'https://d/' || doc_id AS url, NOT bad AS excluded, CASE WHEN bad THEN 'changed' END AS error FROM (SELECT doc_id, n_chars % 9 = 0 AND text <> 'x' OR lang = 'fr' AND n_chars % 2 <> 0 AS bad FROM documents WHERE lang IN ('fr', 'de'))""",
    "media_decisions": """WITH m AS (SELECT DISTINCT l_orderkey AS d, l_partkey AS p FROM lineitem), r AS (SELECT p_partkey AS p, CASE WHEN p_size % 2 = 0 THEN 'remove' ELSE 'keep' END AS disp, CASE WHEN p_size > 25 THEN [p_partkey % 97, p_partkey] END AS docs FROM part UNION ALL SELECT p_partkey, 'mask', [p_partkey % 89] FROM part),
 j AS (SELECT d, p, disp FROM m JOIN r USING (p) WHERE CASE WHEN docs IS NOT NULL THEN list_contains(docs, d) ELSE disp = 'remove' END)
 SELECT d::VARCHAR AS document, p::VARCHAR AS sha256, CASE WHEN count(DISTINCT disp) = 1 THEN min(disp) END AS disposition, CASE WHEN count(DISTINCT disp) > 1 THEN 'conflict' END AS error FROM j GROUP BY d, p""",
    "unique_json": """SELECT event_id, CASE WHEN props IS NULL THEN 'ok' WHEN event_type = 'purchase' THEN 'duplicate key' WHEN event_type = 'error' THEN 'no JSON' ELSE 'ok' END AS outcome,
 CASE WHEN event_type NOT IN ('purchase', 'error') THEN sha256(replace(props, ' ', '')) END AS sha256 FROM events""",
    "known_contents": "SELECT doc_id, EXISTS (SELECT 1 FROM documents o WHERE o.doc_id % 2 = 1 AND o.text = d.text AND o.lang IS NOT DISTINCT FROM d.lang AND o.source IS NOT DISTINCT FROM d.source AND o.n_chars IS NOT DISTINCT FROM d.n_chars) AS known FROM documents d",
    "imported_provenance": "SELECT 'u' || c_custkey AS url, CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE 'import' END AS origin FROM customer WHERE c_custkey NOT IN (SELECT o_custkey * 2 FROM orders)",
}
