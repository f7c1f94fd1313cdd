"""Queries over page and document contents: rendering, structure, privacy, edits, documents on disk."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions.text import normalize_body_sql
from textkiln.operators import pages as P
from textkiln.operators import privacy as V
from textkiln.sources import documents as D
from textkiln.sources.tables import table


def _rendered(spark, sf):
    return P.render_pages(table(spark, sf, "pages"))


def render_markdown(spark, sf):
    return _rendered(spark, sf).select("page_id", "url", "markdown", "verdict", "title", F.size("assets").alias("n_assets"), F.size("links").alias("n_links"))


def markdown_blocks(spark, sf):
    return P.markdown_blocks(_rendered(spark, sf), "page_id", "markdown").select("id", "address", "kind", "start", "end", "sha256", "estimated_tokens")


def markdown_links(spark, sf):
    """Whole pages with their own anchors written as links, and rendered pages with a link to themselves, an image, and a link in code that doesn't count."""
    anchored = F.regexp_replace("html", '<a href="([^"]*)">([^<]*)</a>', "[$2]($1)")
    more = F.concat(F.coalesce("markdown", F.lit("")), F.lit("\n[this page]("), F.coalesce("url", F.lit("")), F.lit(") ![i](/img/"), F.col("page_id"), F.lit(".png)\n\n```\n[no](/code)\n```\n"))
    both = table(spark, sf, "pages").select("page_id", anchored.alias("markdown")).unionByName(_rendered(spark, sf).select("page_id", more.alias("markdown")))
    return P.markdown_links(both, "page_id", "markdown").distinct()


def markdown_sections(spark, sf):
    return P.markdown_sections(_rendered(spark, sf), "page_id", "markdown", most=1_000)


def guarded_removals(spark, sf):
    """The last paragraph of every page is removed under its guard."""
    rendered = _rendered(spark, sf)
    b = P.markdown_blocks(rendered, "page_id", "markdown").where("kind = 'paragraph'")
    rules = b.groupBy("id").agg(F.max_by(F.struct(F.col("address").alias("location"), "sha256"), "start").alias("r")).select("id", "r.*")
    return P.guarded_removals(rendered, rules, "page_id", "markdown").select("id", "error", F.length("body").alias("length"), F.sha2("body", 256).alias("sha256"))


def frontmatter_roundtrip(spark, sf):
    """Whole documents with frontmatter, split again: what comes back of each field and of the body."""
    d = table(spark, sf, "documents").where("text is not null")
    text = D.serialize({"sourceId": F.col("source"), "title": F.split_part("text", F.lit("\n"), F.lit(1)), "url": F.concat(F.lit("https://d/"), "doc_id"), "description": F.col("lang")}, F.col("text"))
    meta, body = D.split(F.col("document"))
    return d.select("doc_id", text.alias("document")).select("doc_id", meta.alias("m"), body.alias("b")).select(
        "doc_id", F.col("m")["sourceId"].alias("source"), F.col("m")["title"].alias("title"), F.col("m")["url"].alias("url"), F.col("m")["description"].alias("description"),
        F.col("m")["content_hash"].alias("content_hash"), F.sha2("b", 256).alias("body_sha256"))


def privacy_scan(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(V.kinds(F.col("text")), ",").alias("kinds")).where("kinds != ''")


def page_privacy(spark, sf):
    """Whole pages, with the document of their number as what an image of theirs shows."""
    p, d = table(spark, sf, "pages").select("page_id", "html"), table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), "text")
    said = F.concat(F.col("html"), F.lit('<img src="x.png" alt="'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit("&quot;")), F.lit('">'))
    return p.join(d, "page_id").select("page_id", F.array_join(V.page_kinds(said), ",").alias("kinds")).where("kinds != ''")


def privacy_findings(spark, sf):
    return V.findings(table(spark, sf, "documents"))


def privacy_redaction(spark, sf):
    """What is left after redaction: findings of the redacted text against those of the original."""
    docs = table(spark, sf, "documents")
    final = V.redacted(docs).withColumnRenamed("id", "doc_id")
    return V.match_findings(V.findings(docs), V.findings(final)).where("verdict != 'new'").groupBy("kind", "verdict").agg(F.count(F.lit(1)).alias("n"))


#: Words between blanks: what counts as a word boundary differs between regular expression engines.
_FOCUS, _OTHER = r"(^|[ \n])([Tt]he|[Dd]er|[Ll]e)([ ,.\n]|$)", r"(^|[ \n])([Aa]nd|[Uu]nd|[Ee]t)([ ,.\n]|$)"


def relevance_decision(spark, sf):
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    body = F.expr("substring(text, length(split_part(text, '\n', 1)) + 1)")
    return table(spark, sf, "documents").select("doc_id", V.relevance(title, body, _FOCUS, _OTHER).alias("decision"))


def redirect_resolution(spark, sf):
    """Every link of every page; routes that several pages link to redirect to the first of these pages."""
    p = table(spark, sf, "pages").select("page_id", "url", "html")
    links = p.select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))).alias("link"))
    redirects = links.join(p.select("page_id", "url"), "page_id").groupBy(F.col("link").alias("src")).agg(F.min_by("url", F.struct("page_id", "url")).alias("dst"), F.count_distinct("page_id").alias("n")).where("n > 1").select("src", "dst")
    return P.resolve_redirects(links, redirects)


def unlinked_references(spark, sf):
    """A link to each document's neighbour is written below its whole text; links to even documents are retired."""
    d = table(spark, sf, "documents").where("doc_id is not null").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n\nSee [next](https://example.com/d/"), F.col("doc_id") + 1, F.lit(")\n")).alias("body"))
    retired = d.where("doc_id % 2 = 0").select(F.concat(F.lit("https://example.com/d/"), "doc_id").alias("url"))
    return P.unlinked(d, retired, "doc_id", "body", "url").select("id", "unlinked", F.sha2("body", 256).alias("sha256"))


QUERIES = {f.__name__: f for f in (
    render_markdown, markdown_blocks, markdown_links, markdown_sections, guarded_removals, frontmatter_roundtrip, privacy_scan, page_privacy, privacy_findings, privacy_redaction,
    relevance_decision, redirect_resolution, unlinked_references)}
_NORMAL = normalize_body_sql("text")
_KINDS_SQL = ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in sorted(V.KINDS.items()))
_quoted = lambda p: p.replace("'", "''")
_ENTITIES = "x"
for _entity, _c in V.ENTITIES:
    _ENTITIES = f"replace({_ENTITIES}, '{_entity}', '{_quoted(_c)}')"
# RE2 knows no lookahead: the excepted host is taken out of the text instead
_EXCEPTION = "(?!example-corp\\.)"
_PAGE_KINDS = ", ".join(
    f"""CASE WHEN regexp_matches({"regexp_replace(t, '(?i)https://example-corp[.]', ' ', 'g')" if _EXCEPTION in p else 't'}, '(?i){_quoted(p.replace(_EXCEPTION, ""))}') THEN '{k}' END""" for k, p in sorted(V.PAGE_KINDS.items()))
ORACLE_SQL = {
    "markdown_links": """SELECT page_id AS id, 'link' AS kind, t AS target FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS t FROM pages) WHERE regexp_full_match(t, '[^ \\t\\n()<>]+')
 UNION SELECT page_id, 'link', url FROM pages WHERE url <> '' UNION SELECT page_id, 'media', '/img/' || page_id || '.png' FROM pages""",
    "frontmatter_roundtrip": f"""SELECT doc_id, source, split_part(text, chr(10), 1) AS title, 'https://d/' || doc_id AS url, lang AS description, sha256({_NORMAL}) AS content_hash, sha256({_NORMAL}) AS body_sha256 FROM documents WHERE text IS NOT NULL""",
    "privacy_scan": f"SELECT doc_id, kinds FROM (SELECT doc_id, array_to_string(list_filter([{_KINDS_SQL}], lambda x: x IS NOT NULL), ',') AS kinds FROM documents) WHERE kinds <> ''",
    "page_privacy": f"""WITH h AS (SELECT page_id, html || '<img src="x.png" alt="' || replace(coalesce(text, ''), '"', '&quot;') || '">' AS h FROM pages JOIN documents ON doc_id = page_id),
 t AS (SELECT page_id, {_ENTITIES} AS t FROM (SELECT page_id, regexp_replace(h, '{V.UNSEEN}', ' ', 'g') || ' ' || array_to_string(regexp_extract_all(h, '{_quoted(V.SAYING)}', 1), ' ') AS x FROM h))
 SELECT * FROM (SELECT page_id, array_to_string(list_filter([{_PAGE_KINDS}], lambda x: x IS NOT NULL), ',') AS kinds FROM t) WHERE kinds <> ''""",
    "relevance_decision": f"""SELECT doc_id, CASE WHEN NOT regexp_matches(t || ' ' || b, '{_FOCUS}') THEN 'exclude' WHEN regexp_matches(t, '{_FOCUS}') AND NOT regexp_matches(t, '{_OTHER}') THEN 'include'
 WHEN regexp_matches(t, '{_OTHER}') AND NOT regexp_matches(b, '{_FOCUS}') THEN 'exclude' ELSE 'review' END AS decision
 FROM (SELECT doc_id, split_part(text, chr(10), 1) AS t, substring(text, length(split_part(text, chr(10), 1)) + 1) AS b FROM documents)""",
    "redirect_resolution": """WITH l AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages), r AS (SELECT link AS src, arg_min(url, page_id) AS dst FROM l JOIN pages USING (page_id) GROUP BY link HAVING count(DISTINCT page_id) > 1),
 n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY link) AS n FROM l) SELECT page_id, link, CASE WHEN n <= 100 THEN coalesce(dst, link) ELSE link END AS final FROM n LEFT JOIN r ON link = src""",
    "unlinked_references": """SELECT doc_id AS id, CASE WHEN r THEN 1 ELSE 0 END AS unlinked, sha256(coalesce(text, '') || chr(10) || chr(10) || CASE WHEN r THEN 'See next' ELSE 'See [next](https://example.com/d/' || (doc_id + 1) || ')' END || chr(10)) AS sha256
 FROM (SELECT *, (doc_id + 1) % 2 = 0 AND EXISTS (SELECT 1 FROM documents o WHERE o.doc_id = d.doc_id + 1) AS r FROM documents d WHERE doc_id IS NOT NULL)""",
}
