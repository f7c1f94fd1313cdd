"""Queries that project metadata, and check that policies and transformations are done with."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.operators import projections as P
from textkiln.operators import retirement as T
from textkiln.operators import rewrites as W
from textkiln.sources.tables import table

_KINDS = {"the ": "overview", "the of": "procedure", "der ": "overview", "les ": "list"}


def route_metadata(spark, sf):
    m = P.route_metadata(F.col("url"))
    return table(spark, sf, "pages").select("page_id", *[(F.array_join(c, " / ") if k == "breadcrumb" else c).alias(k) for k, c in m.items()])


def support_metadata(spark, sf):
    """First lines of documents as titles, under numbers where the length is even."""
    line = F.split_part("text", F.lit("\n"), F.lit(1))
    title = F.when(F.length(line) % 2 == 0, F.concat(F.lit("K"), F.col("doc_id"), F.lit(" : "), line)).otherwise(line)
    m = P.support_metadata(title, _KINDS)
    return table(spark, sf, "documents").select("doc_id", m["article"].alias("article"), F.sha2(m["title"], 256).alias("title_sha256"), m["kind"].alias("kind"))


def post_descriptions(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", P.post_description(F.col("text")).alias("description"))


def payload_digests(spark, sf):
    """Paths made of document digests, some below another digest's folder, some with a suffix."""
    h, n = F.sha2("text", 256), F.col("n_chars")
    path = F.concat(F.lit("payloads/"), F.when(n % 7 == 0, F.lit("zz")).when(n % 11 == 0, F.substring(h, 3, 2)).otherwise(F.substring(h, 1, 2)), F.lit("/"), h, F.when(n % 2 == 0, F.lit(".png")).when(n % 3 == 0, F.lit(".x/y")).otherwise(F.lit("")))
    return table(spark, sf, "documents").select("doc_id", P.payload_digest(path).alias("sha256")).where("sha256 is not null")


def policy_violations(spark, sf):
    """Pages left by a policy, and those that a stricter one would still take out."""
    p = table(spark, sf, "pages")
    listed = p.where("url like '%://blog.%'").select("url")
    none = spark.createDataFrame([], "identity string")
    left = p.join(T.excluded_topics(p, "page_id", "url", listed, (), none).select("page_id"), "page_id", "left_anti")
    rules = lambda *words: lambda rows: T.excluded_topics(rows, "page_id", "url", listed, words, none)
    return P.violations(left, rules(), "page_id").select("page_id", F.lit("same").alias("policy")).unionByName(P.violations(left, rules("/es/"), "page_id").select("page_id", F.lit("stricter").alias("policy")))


def unstable_documents(spark, sf):
    """Appending a section is stable the second time; the first time every document changes."""
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    add = lambda rows: rows.withColumn("body", W.after_marker(F.col("body"), "<!-- more -->", F.lit("See.\n")))
    once = P.unstable(d, add, "doc_id", "body").select("doc_id", F.lit(1).alias("run"))
    return once.unionByName(P.unstable(add(d), add, "doc_id", "body").select("doc_id", F.lit(2).alias("run")))


QUERIES = {f.__name__: f for f in (route_metadata, support_metadata, post_descriptions, payload_digests, policy_violations, unstable_documents)}
_STEPS = "list_filter(string_split(regexp_extract(url, '^[A-Za-z]+://[^/?#]*/?([^?#]*)', 1), '/'), lambda x: x <> '')"
_LINE = "split_part(text, chr(10), 1)"
ORACLE_SQL = {
    "route_metadata": f"""SELECT page_id, regexp_replace(s[-1], '\\.[A-Za-z0-9]{{1,5}}$', '') AS slug, s[1] AS category, CASE WHEN len(s) > 2 THEN s[2] END AS subcategory,
 array_to_string(list_transform(s[:len(s) - 1], lambda x: upper(x[1]) || lower(x[2:])), ' / ') AS breadcrumb FROM (SELECT page_id, {_STEPS} AS s FROM pages)""",
    "support_metadata": f"""SELECT doc_id, CASE WHEN length({_LINE}) % 2 = 0 THEN 'K' || doc_id END AS article, sha256({_LINE}) AS title_sha256,
 CASE WHEN starts_with(lower({_LINE}), 'the of') THEN 'procedure' WHEN starts_with(lower({_LINE}), 'the ') OR starts_with(lower({_LINE}), 'der ') THEN 'overview' WHEN starts_with(lower({_LINE}), 'les ') THEN 'list' END AS kind FROM documents""",
    "post_descriptions": "SELECT conv_id, turn, substring(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')), 1, 240) AS description FROM conversations",
    "payload_digests": "SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE n_chars % 7 <> 0 AND (n_chars % 11 <> 0 OR substring(sha256(text), 3, 2) = substring(sha256(text), 1, 2)) AND (n_chars % 2 = 0 OR n_chars % 3 <> 0)",
    "policy_violations": """WITH left_ AS (SELECT page_id, url FROM pages WHERE rtrim(regexp_extract(lower(url), '^[a-z]+://([^?#]*)', 1), '/') NOT IN (SELECT rtrim(regexp_extract(lower(url), '^[a-z]+://([^?#]*)', 1), '/') FROM pages WHERE url LIKE '%://blog.%'))
 SELECT page_id, 'stricter' AS policy FROM left_ WHERE contains(lower(url), '/es/')""",
    "unstable_documents": "SELECT doc_id, 1 AS run FROM documents WHERE text IS NOT NULL",
}
