"""Custody of reviewed evidence: seals, coverage, qualification, resumable capture, history, inventories, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.functions.text import body_hash


def seal(records: DataFrame, files: DataFrame) -> DataFrame:
    """``path, sha256, disposition, final`` of sealed records: each with its file's digest (``path, content``)."""
    final = F.col("disposition").isin("accepted", "excluded")
    return records.join(files.select("path", F.sha2("content", 256).alias("sha256")), "path", "left").select("path", "sha256", "disposition", final.alias("final"))


def verify_seal(sealed: DataFrame, records: DataFrame, files: DataFrame) -> DataFrame:
    """``path, error`` of whatever differs from the seal today."""
    now = seal(records, files).select("path", F.col("sha256").alias("h"), F.col("disposition").alias("d"), F.lit(True).alias("there"))
    j = sealed.withColumn("sealed", F.lit(True)).join(now, "path", "full_outer")
    error = (
        F.when(F.col("sealed").isNull(), "not sealed").when(F.col("there").isNull(), "record missing").when(F.col("h").isNull(), "file missing")
        .when(~F.col("h").eqNullSafe(F.col("sha256")), "file changed").when(~F.col("d").eqNullSafe(F.col("disposition")), "disposition changed"))
    return j.select("path", error.alias("error")).where("error is not null")


def frames(visuals: DataFrame) -> DataFrame:
    """``document, sha256, frame``: every frame of every visual (array of ``sha256, frame``); a missing index is its place."""
    e = visuals.select("document", F.posexplode("visuals").alias("at", "v"))
    return e.select("document", F.col("v.sha256").alias("sha256"), F.coalesce("v.frame", "at").alias("frame"))


def evidence_subset(claims: DataFrame, addresses: DataFrame) -> DataFrame:
    """``document, valid``: is the evidence (array) a non-empty subset of the document's addresses?"""
    known = addresses.withColumn("known", F.lit(True))
    each = claims.select("document", F.explode_outer("evidence").alias("address"))
    j = each.join(known, ["document", "address"], "left")
    return j.groupBy("document").agg(F.bool_and(F.col("address").isNotNull() & F.col("known").isNotNull()).alias("valid"))


def qualify(before: DataFrame, after: DataFrame, approved: DataFrame) -> DataFrame:
    """``path, change, approved``: how a policy changes the corpus (``path, sha256``), and which changes are unknown."""
    j = before.select("path", F.col("sha256").alias("a")).join(after.select("path", F.col("sha256").alias("b")), "path", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    ok = approved.select("path").distinct().withColumn("ok", F.lit(True))
    return j.join(ok, "path", "left").select("path", change.alias("change"), F.col("ok").isNotNull().alias("approved"))


def resumable(items: DataFrame, done: DataFrame, binding: tuple[str, ...]) -> DataFrame:
    """Items whose identity and binding digest no finished record has."""
    key = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in binding]), 256)
    return items.withColumn("binding", key).join(done.select("identity", "binding"), ["identity", "binding"], "left_anti")


def corrected(history: DataFrame, corrections: DataFrame, at: str) -> DataFrame:
    """Appends corrected dispositions: the open row of an identity closes at ``at`` and a new one opens; equal ones change nothing.

    ``history``: identity, disposition, valid_from, valid_to; ``corrections``: identity, disposition.
    """
    c = corrections.groupBy("identity").agg(F.max("disposition").alias("new"))
    j = history.join(c, "identity", "left")
    hit = F.col("valid_to").isNull() & F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("disposition"))
    old = j.select("identity", "disposition", "valid_from", F.when(hit, F.lit(at)).otherwise(F.col("valid_to")).alias("valid_to"))
    opened = j.where(hit).select("identity", F.col("new").alias("disposition"), F.lit(at).alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    first = c.join(history.select("identity").distinct(), "identity", "left_anti").select("identity", F.col("new").alias("disposition"), F.lit(at).alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    return old.unionByName(opened).unionByName(first)


def spaced(requests: DataFrame, client: str, at: str, gap: float) -> DataFrame:
    """``start``: when each request of a client may start, at least ``gap`` apart, in order of arrival.

    start_n = max over k <= n of (arrival_k + (n - k) * gap), a running maximum.
    """
    w = Window.partitionBy(client).orderBy(at, "request")
    n = F.row_number().over(w) - 1
    run = requests.withColumn("__n", n).withColumn("__base", F.max(F.col(at) - F.col("__n") * gap).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.withColumn("start", F.col("__base") + F.col("__n") * gap).drop("__n", "__base")


def pruned_assets(assets: DataFrame, references: DataFrame) -> DataFrame:
    """Assets that no document refers to."""
    return assets.join(references.select(F.col("target").alias("path")).distinct(), "path", "left_anti")


def inventory(listing: DataFrame, tagged: DataFrame, sitemap: DataFrame, reviews: DataFrame) -> DataFrame:
    """``id, decision, reason``: the union of all sources of ids, with what is known of each.

    A reviewed id has its review's decision. Of the rest, what is listed and tagged is included, what is
    only tagged or only in the sitemap is unresolved, anything else is left out.
    """
    flag = lambda df, name: df.select("id").distinct().withColumn(name, F.lit(True))
    j = flag(listing, "l").join(flag(tagged, "t"), "id", "full_outer").join(flag(sitemap, "s"), "id", "full_outer").join(reviews.groupBy("id").agg(F.max("decision").alias("r")), "id", "left")
    l, t, s, r = (F.col(c).isNotNull() for c in ("l", "t", "s", "r"))
    decision = F.when(r, F.col("r")).when(l & t, "include").when(t | (s & ~l), "unresolved").otherwise("exclude")
    reason = F.when(r, "reviewed").when(l & t, "listed and tagged").when(t, "tagged but not listed").when(s & ~l, "only in the sitemap").otherwise("not tagged")
    return j.select("id", decision.alias("decision"), reason.alias("reason"))


def manifest(documents: DataFrame, assets: DataFrame, started_at: str, ended_at: str) -> DataFrame:
    """One row: counts, bytes and digests of a release."""
    d = documents.agg(F.count(F.lit(1)).alias("page_count"), F.sum("size_bytes").alias("page_bytes"), F.count_if(F.col("status") == "success").alias("fresh"), F.count_distinct("source").alias("sources"))
    a = assets.agg(F.count(F.lit(1)).alias("asset_count"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("asset_bytes"))
    return d.crossJoin(a).withColumns({"started_at": F.lit(started_at), "ended_at": F.lit(ended_at)})


#: Findings of a document inventory and their patterns; the two below them are found without one.
FINDINGS = {
    "body_date": r"(?im)^Published .*(?:modified|updated).*|^Last (?:updated|modified).*",
    "renderer_label": r"(?im)^Terminal window\s*$",
    "api_appendix": r"<!-- content-policy:related-api -->",
    "duplicate_caption": r"(?im)^Figure \d+[:.].*$",
}


def document_findings(docs: DataFrame, key: str, body: str, description: str) -> DataFrame:
    """``key, category, n``: patterns found, short documents (under 80 words) and descriptions that seem cut."""
    b, d = F.coalesce(F.col(body), F.lit("")), F.coalesce(F.col(description), F.lit(""))
    words = F.size(F.filter(F.split(b, r"\s+"), lambda x: x != ""))
    each = [F.struct(F.lit(k).alias("category"), F.regexp_count(b, F.lit(p)).alias("n")) for k, p in FINDINGS.items()]
    each.append(F.struct(F.lit("short_document").alias("category"), (words < 80).cast("int").alias("n")))
    each.append(F.struct(F.lit("clipped_description").alias("category"), ((d != "") & ~d.rlike(r"[.!?]\z")).cast("int").alias("n")))
    return docs.select(key, F.explode(F.array(*each)).alias("f")).select(key, "f.category", "f.n").where("n > 0")


#: Fixed value: inline code, or a number with its unit.
PAYLOAD = r"(`[^`\n]+`|\b[0-9]+(?:\.[0-9]+)? ?(?:ms|s|KB|MB|GB|%)(?:\b|$))"


def technical_payloads(text: Column) -> Column:
    """Inline code and numbers with units, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PAYLOAD), F.lit(1))


def first_paragraph(body: Column, least: int = 20) -> Column:
    """The first paragraph that is prose, on one line: none of its lines begins a heading, list, table, quote, image or fence; of ``least`` characters or more, ending a sentence."""
    prose = F.filter(F.split(body, r"\n[ \t]*\n"), lambda p: ~p.rlike(r"(?m)^[ \t]*(?:#|[-*+] |\d+[.)] |\||>|!\[|```)"))
    flat = F.transform(prose, lambda p: F.trim(F.regexp_replace(p, r"[ \t\n\r\f]+", " ")))
    return F.get(F.filter(flat, lambda p: (F.length(p) >= least) & p.rlike(r"[.!?]$")), F.lit(0))


def json_ld_dates(html: Column) -> Column:
    """struct(published, modified) of the first JSON-LD node that has a date, through ``@graph`` and lists."""
    raw = F.regexp_extract(html, r'(?s)<script type="application/ld\+json">(.*?)</script>', 1)
    node = "struct<datePublished:string,dateModified:string>"
    flat = F.concat(
        F.coalesce(F.from_json(F.get_json_object(raw, "$.@graph"), f"array<{node}>"), F.array().cast(f"array<{node}>")),
        F.coalesce(F.from_json(F.when(F.ltrim(raw).startswith("["), raw), f"array<{node}>"), F.array().cast(f"array<{node}>")),
        F.array(F.from_json(F.when(F.ltrim(raw).startswith("{"), raw), node)))
    dated = F.get(F.filter(flat, lambda n: n["datePublished"].isNotNull() | n["dateModified"].isNotNull()), F.lit(0))
    iso = lambda c: F.when(F.substring(c, 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")).cast("string")
    return F.struct(iso(dated["datePublished"]).alias("published"), iso(dated["dateModified"]).alias("modified"))


def candidate_sources(previous: DataFrame, listed: DataFrame, discovered: DataFrame) -> DataFrame:
    """URLs of all sources of discovery, with where each comes from (sorted) and the least time it was seen."""
    each = [df.select("url", F.lit(origin).alias("origin"), F.col("seen_at").cast("string").alias("seen_at")) for df, origin in ((previous, "previous_publication"), (listed, "inventory"), (discovered, "discovery"))]
    u = each[0].unionByName(each[1]).unionByName(each[2]).where("url is not null")
    return u.groupBy("url").agg(F.array_sort(F.collect_set("origin")).alias("origins"), F.min("seen_at").alias("first_seen"))


def changed_bindings(previous: DataFrame, current: DataFrame, ignored: tuple[str, ...], key: str = "identity") -> DataFrame:
    """``identity, budget``: a spent budget carries over where only ignored fields of the binding changed."""
    fields = [c for c in current.columns if c not in (key, "budget", *ignored)]
    same = F.lit(True)
    for c in fields:
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}"))
    j = current.alias("c").join(previous.alias("p"), F.col(f"c.{key}") == F.col(f"p.{key}"), "left")
    return j.select(F.col(f"c.{key}").alias(key), F.when(F.col(f"p.{key}").isNotNull() & same, F.col("p.budget")).otherwise(F.col("c.budget")).alias("budget"))


def body_digests(docs: DataFrame, key: str, body: str) -> DataFrame:
    return docs.select(F.col(key).alias("path"), body_hash(F.col(body)).alias("sha256"))
