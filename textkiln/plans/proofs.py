"""Queries that prove recorded evidence, rewrite texts under guards, and report."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textkiln.functions import text as X
from textkiln.operators import proofs as P
from textkiln.operators import reports as R
from textkiln.operators import rewrites as W
from textkiln.sources.tables import table


def _docs(spark, sf):
    return table(spark, sf, "documents")


def dependency_rounds(spark, sf):
    """Parts as pages: each depends on the part with half its key; dear ones were reviewed before, large ones repaired."""
    p = table(spark, sf, "part")
    node = lambda when: p.where(when).select(F.col("p_partkey").alias("node"))
    return P.dependency_rounds(p.where("p_partkey > 1").select(F.col("p_partkey").alias("src"), F.expr("p_partkey div 2").alias("dst")), node("p_brand = 'Brand#23'"), node("p_size > 45"), node("p_retailprice > 1500"))


def target_evidence(spark, sf):
    """Parts of line items as targets: small parts are allowed, suppliers qualify parts with their number, orders are routes."""
    t = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("target"))
    allowed = table(spark, sf, "part").where("p_size <= 40").select(F.col("p_partkey").alias("target"))
    q = table(spark, sf, "customer").select((F.col("c_custkey") % 900).alias("target"), F.when(F.col("c_acctbal") < 0, 404).otherwise(200).alias("status"))
    return P.target_evidence(t, allowed, q, table(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("target")))


def stage_replay(spark, sf):
    """Stages pinned on documents; today's are those of the documents whose text is no copy of an earlier one."""
    d = _docs(spark, sf).select(F.col("doc_id").alias("document"), F.col("lang").alias("policy"), F.col("source").alias("catalog"), F.sha2("text", 256).alias("input"), "n_chars")
    pins = d.select("document", "policy", F.when(F.col("n_chars") % 17 == 0, F.lit("old")).otherwise(F.col("catalog")).alias("catalog"), "input", F.when(F.col("n_chars") % 13 == 0, F.lit("x")).otherwise(F.reverse("input")).alias("output"))
    first = F.row_number().over(Window.partitionBy("input").orderBy("document")) == 1
    now = d.withColumn("first", first).where("first").select("document", "policy", "catalog", "input", F.reverse("input").alias("output"))
    return P.stage_replay(pins, now, ("policy", "catalog", "input"))


def provenance_chain(spark, sf):
    """Orders of a customer as transitions from one status to the next."""
    o = table(spark, sf, "orders")
    return P.provenance_chain(o.select(F.col("o_custkey").alias("document"), F.col("o_orderkey").alias("step"), (F.floor("o_totalprice") % 3).alias("before"), (F.floor("o_totalprice") % 2).alias("after")))


def provenance_transition(spark, sf):
    return P.provenance_transition(table(spark, sf, "documents").select(F.concat_ws("/", "lang", "source").alias("context")), table(spark, sf, "documents").where("n_chars > 3000").select(F.concat_ws("/", "lang", "source").alias("context")), table(spark, sf, "nation").select(F.sha2("n_name", 256).alias("sha256")), "0" * 64)


def reference_delta(spark, sf):
    """Line items as placements of images, after a repair that did more than it may."""
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_quantity").cast("int").alias("q"))
    name = F.concat(F.lit("a/"), "p", F.lit(".png"))
    before = l.where("q > 2").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("place"), F.when(F.col("q") % 2 == 0, F.concat(name, F.lit(".png"))).otherwise(name).alias("target"))
    after = l.where("q < 49").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("place"), F.when(F.col("q") % 10 == 5, F.lit("a/0.png")).otherwise(name).alias("target"))
    return P.reference_delta(before, after, table(spark, sf, "part").where("p_size > 10").select(F.concat(F.lit("a/"), "p_partkey", F.lit(".png")).alias("name")))


def chosen_contents(spark, sf):
    d = _docs(spark, sf)
    of = lambda kind, text: d.select(F.col("doc_id").alias("path"), F.lit(kind).alias("kind"), F.sha2(text, 256).alias("sha256"))
    sources = of("published", F.col("text")).unionByName(of("admitted", F.upper("lang")).where("path % 5 != 0"))
    choices = d.where("n_chars % 11 != 0").select(F.col("doc_id").alias("path"), F.when(F.col("lang") == "en", "published").otherwise("admitted").alias("choice"))
    out = d.where("n_chars % 7 != 0").select(F.col("doc_id").alias("path"), F.sha2(F.when(F.col("lang").isin("en", "de"), F.col("text")).otherwise(F.upper("lang")), 256).alias("sha256"))
    return P.chosen_contents(choices, sources, out)


def fact_coverage(spark, sf):
    """Lines of documents as blocks: short ones are headings; every line of the longest kinds has its fact, some twice, some none."""
    lines = _docs(spark, sf).select(F.col("doc_id").alias("document"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("address", "t")).withColumn("n", F.length("t"))
    blocks = lines.select("document", "address", F.when(F.col("n") < 80, "heading").otherwise("paragraph").alias("kind"))
    facts = lines.where("n % 9 != 0").select("document", "address").unionByName(lines.where("n % 10 = 0").select("document", "address"))
    return P.fact_coverage(blocks, facts)


def independent_gate(spark, sf):
    """Turns of conversations as validations of bodies; the quotes are words of the turn, and of another role's language."""
    c = table(spark, sf, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("document"), F.col("text").alias("body"), (F.length("text") % 5 != 0).alias("facts"), (F.col("role") != "system").alias("links"), F.array(F.substring("text", 3, 12), F.when(F.col("turn") % 4 == 0, F.lit("zebra crossing")).otherwise(F.substring("text", 1, 2))).alias("quotes"))
    return P.independent_gate(c, ("facts", "links"))


def response_errors(spark, sf):
    """Events as recorded responses."""
    e, k = table(spark, sf, "events"), F.col("event_type")
    body = F.to_json(F.struct(F.sha2(F.col("event_id").cast("string"), 256).alias("request_sha256"), F.when(k == "view", "b").otherwise("a").alias("model"), F.when(F.col("value") > 50, "failed").otherwise("completed").alias("status"), F.when(k == "click", F.array(F.lit("search"))).alias("tool_calls"), F.when(k != "signup", F.lit("{}")).alias("output")))
    r = e.select(F.col("event_id").cast("string").alias("request"), F.sha2(F.when(k == "error", F.lit("x")).otherwise(F.col("event_id").cast("string")), 256).alias("expected_sha256"), body.alias("json"), "value")
    return P.response_errors(r.withColumn("sha256", F.sha2(F.when(F.col("value") < 1, F.lit("y")).otherwise(F.col("json")), 256)), ("a", "c"))


def admission_errors(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.col("c_custkey").alias("admitted_c_custkey"), F.when(F.col("c_acctbal") < 0, -1).otherwise(F.col("c_nationkey")).alias("admitted_c_nationkey"), F.when(F.col("c_acctbal") > 9000, "X").otherwise(F.col("c_mktsegment")).alias("admitted_c_mktsegment"), (F.col("c_acctbal") > -500).alias("complete"))
    return P.admission_errors(c, "c_custkey", "c_nationkey", "c_mktsegment", ("complete",))


def publication_receipt(spark, sf):
    """A receipt over nations as assets, checked against those of four regions and with another tag."""
    n = table(spark, sf, "nation")
    one = P.receipt(spark.range(1).select(F.lit("v1").alias("tag"), F.lit("abc").alias("source_commit"), F.lit("2026-01-01T00:00:00Z").alias("published_at")), n.select(F.col("n_name").alias("name"), F.sha2("n_name", 256).alias("sha256")))
    return P.receipt_errors(one, {"tag": "v2", "source_commit": "abc"}, None, n.where("n_regionkey != 2").select(F.col("n_name").alias("name")))


def canonical_pairs(spark, sf):
    """Documents that name the first document of their text as canonical, or of their source."""
    d = _docs(spark, sf)
    w = F.min("doc_id").over(Window.partitionBy("text"))
    return P.canonical_pairs(d.select(F.col("doc_id").alias("url"), F.when(F.col("n_chars") % 4 == 0, F.min("doc_id").over(Window.partitionBy("source"))).otherwise(w).alias("canonical_url"), F.col("text").alias("body")))


def compatible_requests(spark, sf):
    o = table(spark, sf, "orders")
    expected = o.select(F.col("o_orderkey").alias("request"), F.lit("m2").alias("model"), F.col("o_custkey").alias("payload"))
    recorded = o.where("o_totalprice > 50000").select(F.col("o_orderkey").alias("request"), F.when(F.col("o_orderstatus") == "F", "m2").when(F.col("o_orderstatus") == "O", "m1").otherwise("m0").alias("model"), F.when(F.col("o_totalprice") > 250000, -1).otherwise(F.col("o_custkey")).alias("payload"))
    return P.compatible_requests(expected, recorded, {"m2": ("m1",)}).groupBy("use").agg(F.count(F.lit(1)).alias("n"), F.min("request").alias("first"))


def prior_records(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("identity"), F.col("c_nationkey").cast("long").alias("policy"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("identity"), F.col("o_orderkey").alias("record"), (F.col("o_orderstatus") == "P").alias("blocked"), (F.floor("o_totalprice") % 3).alias("feedback"), (F.col("o_orderstatus") == "F").alias("final"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("at"), (F.col("o_orderkey") % 25).alias("policy"))
    return P.prior_records(c, o, ("policy",))


def bundle_errors(spark, sf):
    d = _docs(spark, sf).select(F.concat(F.lit("p/"), "doc_id").alias("name"), F.sha2("text", 256).alias("sha256"), "lang", "n_chars")
    return P.bundle_errors(d.where("lang != 'fr'").select("name", F.when(F.col("n_chars") % 19 == 0, F.lit("x")).otherwise(F.col("sha256")).alias("sha256")), d.where("lang != 'es'").select("name", "sha256"), "?", F.max("sha256"))


def review_phases(spark, sf):
    """Events of a user as the course of a review."""
    e = table(spark, sf, "events").where("user_id is not null")
    outcome = F.when(F.col("event_type").isin("click", "view"), "pass").when(F.col("event_type").isin("signup", "error"), "correct").when(F.col("value") < 5, "fail").otherwise("pass")
    return P.review_phases(e.select(F.col("user_id").alias("record"), F.struct("ts", "event_id").alias("seq"), outcome.alias("outcome")))


def publication_steps(spark, sf):
    c = table(spark, sf, "customer")
    have = lambda n: F.when(F.col("c_acctbal") > n, F.lit("d"))
    late = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("d")).otherwise(have(8000))
    return P.publication_steps(c.select(F.col("c_custkey").alias("tag"), have(-900).alias("admitted"), have(0).alias("curated"), have(2000).alias("packed"), have(4000).alias("verified"), have(6000).alias("uploaded"), late.alias("receipt")))


def text_edits(spark, sf):
    """The first line of each document is replaced by its length; the guard of every text of some lengths is stale."""
    d = _docs(spark, sf).where("text is not null").withColumn("line", F.split_part("text", F.lit("\n"), F.lit(1)))
    edits = d.where("length(line) > 0").select("doc_id", F.lit(0).alias("start"), F.length("line").alias("end"), F.sha2(F.when(F.col("n_chars") % 23 == 0, F.lit("x")).otherwise(F.col("line")), 256).alias("sha256"), F.length("line").cast("string").alias("replacement"))
    return W.edited(d, edits, "doc_id", "text").select("doc_id", F.sha2("body", 256).alias("sha256"), "error")


def edit_origins(spark, sf):
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("int").alias("q"), F.max("l_partkey").alias("p"))
    edits = l.select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") * 100).alias("start"), (F.col("l_linenumber") * 100 + F.col("q")).alias("end"), (F.col("p") % 80).alias("new_length"))
    return W.origins(table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc"), F.lit(1000).alias("length")), edits, "doc")


def appended_sections(spark, sf):
    """A section behind its marker is put below every document, renewed below that, or taken away again."""
    mark = "<!-- related -->"
    once = W.after_marker(F.col("text"), mark, F.concat(F.lit("See "), F.col("source"), F.lit(".\n")))
    twice = W.after_marker(F.col("body"), mark, F.when(F.col("lang") != "fr", F.concat(F.lit("See "), F.col("lang"), F.lit(".\n"))))
    return _docs(spark, sf).select("doc_id", "lang", once.alias("body")).select("doc_id", F.sha2(twice, 256).alias("sha256"))


def _linked(spark, sf):
    """Documents with a link for every line, to the number of its characters; the punctuation behind it isn't the link's."""
    line = lambda x: F.concat(x, F.lit(" See https://example.com/n/"), F.length(x), F.when(F.length(x) % 2 == 0, F.lit(".")).otherwise(F.lit("?!")))
    return _docs(spark, sf).select("doc_id", F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line), "\n\n").alias("body"))


def rewritten_urls(spark, sf):
    mapping = table(spark, sf, "part").where("p_size > 25").select(F.concat(F.lit("https://example.com/n/"), "p_partkey").alias("url"), F.concat(F.lit("https://example.org/"), F.col("p_partkey") * 2).alias("destination"))
    return W.rewritten_urls(_linked(spark, sf), "doc_id", "body", mapping).select("doc_id", "rewritten", F.sha2("body", 256).alias("sha256"))


def without_links(spark, sf):
    """Paragraphs whose link is retired are taken out."""
    gone = table(spark, sf, "part").where("p_size > 25").select(F.concat(F.lit("https://example.com/n/"), "p_partkey").alias("url"))
    return W.without_links(_linked(spark, sf), "doc_id", "body", gone).select("doc_id", "removed")


def rewritten_media(spark, sf):
    line = lambda x: F.concat(F.lit("![x](m/"), F.length(x), F.lit(".png) "), x)
    d = _docs(spark, sf).select("doc_id", F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line), "\n").alias("body"))
    p = table(spark, sf, "part").where("p_size > 20")
    to = p.select(F.concat(F.lit("m/"), "p_partkey", F.lit(".png")).alias("target"), F.concat(F.lit("n/"), "p_size", F.lit(".gif")).alias("replacement"))
    return W.rewritten_media(d, "doc_id", "body", to, p.where("p_size != 33").select(F.concat(F.lit("n/"), "p_size", F.lit(".gif")).alias("name"))).select("doc_id", "error", F.sha2("body", 256).alias("sha256"))


def text_fields(spark, sf):
    e = table(spark, sf, "events")
    meta = F.to_json(F.struct(F.col("event_type").alias("title"), F.struct(F.array(F.col("props"), F.lit("b")).alias("tags"), F.col("value")).alias("more")))
    return W.text_fields(e.select("event_id", meta.alias("m")), "event_id", "m")


def addressed_spans(spark, sf):
    """Per document: its lines and words, and the last word's place. Lists of spans are folded where they are, so no row of a word is shuffled or sorted."""
    words = F.size(F.filter("spans", lambda x: x["address"].contains("/word:")))
    each = W.span_lists(_docs(spark, sf), "doc_id", "text").select(
        "doc_id", F.size("spans").alias("all"), words.alias("words"), F.array_max("spans.end").alias("last"), F.array_min("spans.sha256").alias("sha256"))
    return each.groupBy("doc_id").agg(F.sum(F.col("all") - F.col("words")).alias("lines"), F.sum("words").alias("words"), F.max("last").alias("last"), F.min("sha256").alias("least_sha256"))


def indexed_facts(spark, sf):
    """Lines as blocks, every third line and its length's as facts, and back."""
    lines = _docs(spark, sf).select(F.col("doc_id").alias("document"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("block", "text"))
    facts = lines.where("block % 3 = 0").select("document", F.col("block").alias("fact"), "text").unionByName(lines.where("block % 3 = 1").select("document", F.col("block").alias("fact"), F.length("text").cast("string").alias("text")))
    out = W.indexed_facts(facts, lines)
    back = W.restored_facts(out, lines)
    return out.select("document", "fact", "block").join(back, ["document", "fact"]).select("document", "fact", "block", F.sha2("text", 256).alias("sha256"))


def projected_payloads(spark, sf):
    """Turns of a conversation as parts of a request; long requests go by digest."""
    c = table(spark, sf, "conversations")
    parts, pool = W.projected_payloads(c.select(F.col("conv_id").alias("request"), F.col("turn").alias("part"), "text"), 1_000)
    return parts.join(pool.withColumnRenamed("text", "pooled"), "sha256", "left").select("request", "part", F.col("sha256").isNotNull().alias("projected"), F.length(F.coalesce("text", "pooled")).alias("chars"))


def migration_counts(spark, sf):
    d = _docs(spark, sf).select(F.col("doc_id").alias("url"), F.col("text").alias("body"), F.array("source").alias("links"), "lang", "n_chars")
    after = d.where("lang != 'es'").select("url", F.when(F.col("n_chars") % 5 == 0, F.col("lang")).otherwise(F.col("body")).alias("body"), F.when(F.col("n_chars") % 3 == 0, F.array("lang")).otherwise(F.col("links")).alias("links"))
    return R.migration_counts(d.where("n_chars % 10 != 9"), after, d.where("n_chars > 2000").select("url"))


def disposition_counts(spark, sf):
    return R.disposition_counts(table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "F", "keep").when(F.col("o_orderstatus") == "O", "remove").otherwise(F.col("o_orderstatus")).alias("disposition")))


def lineage_digests(spark, sf):
    d = _docs(spark, sf)
    return R.lineage_digest(d.select(F.concat(F.lit("content/"), "doc_id").alias("path"), F.col("text").alias("body")), table(spark, sf, "part").select(F.concat(F.lit("assets/"), "p_partkey").alias("path"), F.sha2("p_name", 256).alias("sha256")))


def safe_counts(spark, sf):
    return R.safe_counts(_docs(spark, sf), "source", ("src1", "src2", "src3"))


def route_report(spark, sf):
    at = lambda c: F.concat(F.lit("/"), F.col(c)).alias("url")
    return R.route_report(table(spark, sf, "customer").select(at("c_custkey")), table(spark, sf, "part").select(at("p_partkey")), table(spark, sf, "orders").select(at("o_custkey"), (200 + F.floor("o_totalprice") % 2 * 204).alias("status")))


def capture_report(spark, sf):
    by, queue = R.capture_report(_docs(spark, sf).select("source", F.col("doc_id").alias("url"), F.when(F.col("lang") == "en", "accepted").when(F.col("n_chars") > 900, "excluded").alias("disposition")), ("accepted", "excluded"))
    return by.join(queue.groupBy("source").agg(F.count(F.lit(1)).alias("queued")), "source", "left")


def article_hashes(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", R.article_hash("c_mktsegment", "c_nationkey").alias("sha256"))


def destination_errors(spark, sf):
    return R.destination_errors(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("source"), F.when(F.col("l_quantity") > 45, F.col("l_suppkey")).otherwise(F.lit(0)).alias("destination")))


QUERIES = {f.__name__: f for f in (
    dependency_rounds, target_evidence, stage_replay, provenance_chain, provenance_transition, reference_delta, chosen_contents, fact_coverage, independent_gate, response_errors, admission_errors,
    publication_receipt, canonical_pairs, compatible_requests, prior_records, bundle_errors, review_phases, publication_steps, text_edits, edit_origins, appended_sections, rewritten_urls,
    without_links, rewritten_media, text_fields, addressed_spans, indexed_facts, projected_payloads, migration_counts, disposition_counts, lineage_digests, safe_counts, route_report, capture_report,
    article_hashes, destination_errors)}

_LINES = "SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS piece, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line, n_chars FROM documents"
_EDITS = "SELECT l_orderkey AS doc, l_linenumber * 100 AS s, l_linenumber * 100 + max(l_quantity)::INT AS e, max(l_partkey) % 80 AS n FROM lineitem GROUP BY l_orderkey, l_linenumber"
_OUTCOME = "CASE WHEN event_type IN ('click', 'view') THEN 'pass' WHEN event_type IN ('signup', 'error') THEN 'correct' WHEN value < 5 THEN 'fail' ELSE 'pass' END"
ORACLE_SQL = {
    "dependency_rounds": """WITH RECURSIVE e AS (SELECT p_partkey // 2 AS a, p_partkey AS b FROM part WHERE p_partkey > 1 AND p_size <= 45 AND p_partkey // 2 NOT IN (SELECT p_partkey FROM part WHERE (p_size > 45 OR p_retailprice > 1500) AND p_brand <> 'Brand#23')),
 r(node, depth) AS (SELECT p_partkey, 0 FROM part WHERE p_brand = 'Brand#23' UNION SELECT b, depth + 1 FROM r JOIN e ON a = node WHERE depth < 3), m AS (SELECT node, min(depth)::INT AS depth FROM r GROUP BY node)
 SELECT node, depth, CASE WHEN depth > 0 AND node IN (SELECT p_partkey FROM part WHERE p_retailprice > 1500) THEN 'unresolved' WHEN depth = 3 AND EXISTS (SELECT 1 FROM e WHERE a = node AND b NOT IN (SELECT node FROM m)) THEN 'open' ELSE 'omitted' END AS state FROM m""",
    "target_evidence": """WITH t AS (SELECT DISTINCT l_partkey AS target FROM lineitem), q AS (SELECT c_custkey % 900 AS target, count(*) AS n, max(CASE WHEN c_acctbal < 0 THEN 404 ELSE 200 END) AS hi FROM customer GROUP BY 1)
SELECT * FROM (SELECT target, CASE WHEN target NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) THEN 'not allowed' WHEN n IS NULL THEN 'not qualified' WHEN n > 1 THEN 'qualified twice' WHEN hi <> 200 THEN 'status'
 WHEN target NOT IN (SELECT o_custkey * 2 FROM orders) THEN 'no route' END AS error FROM t LEFT JOIN q USING (target)) WHERE error IS NOT NULL""",
    "stage_replay": """SELECT * FROM (SELECT doc_id AS document, CASE WHEN NOT f THEN 'no stage' WHEN n_chars % 17 = 0 THEN 'catalog' WHEN n_chars % 13 = 0 THEN 'output' END AS error
 FROM (SELECT doc_id, n_chars, row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS f FROM documents)) WHERE error IS NOT NULL""",
    "provenance_chain": """SELECT o_custkey AS document, count(*) AS steps, arg_min(b, k) AS first, arg_max(a, k) AS last, min(CASE WHEN n > 1 AND was IS DISTINCT FROM b THEN k END) AS broken FROM (
 SELECT *, lag(a) OVER w AS was, row_number() OVER w AS n FROM (SELECT o_custkey, o_orderkey AS k, floor(o_totalprice)::BIGINT % 3 AS b, floor(o_totalprice)::BIGINT % 2 AS a FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY k)) GROUP BY o_custkey""",
    "provenance_transition": """SELECT DISTINCT lang || '/' || source AS subject, 'not permitted' AS error FROM documents WHERE lang || '/' || source NOT IN (SELECT lang || '/' || source FROM documents WHERE n_chars > 3000)
 UNION ALL SELECT repeat('0', 64), 'no registry'""",
    "reference_delta": """SELECT * FROM (SELECT l_orderkey AS document, l_linenumber AS place, CASE WHEN q <= 2 THEN 'new placement' WHEN q >= 49 THEN 'lost placement' WHEN q % 10 = 5 THEN CASE WHEN p <> 0 THEN 'other change' END
 WHEN q % 2 = 0 AND p NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) THEN 'no such file' END AS error FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p, min(l_quantity)::INT AS q FROM lineitem GROUP BY ALL)) WHERE error IS NOT NULL""",
    "chosen_contents": """SELECT * FROM (SELECT doc_id AS path, CASE WHEN n_chars % 11 = 0 THEN CASE WHEN n_chars % 7 <> 0 THEN 'not chosen' END WHEN lang <> 'en' AND doc_id % 5 = 0 THEN 'no such source' WHEN n_chars % 7 = 0 THEN 'not published'
 WHEN lang = 'de' THEN 'other contents' END AS error FROM documents) WHERE error IS NOT NULL""",
    "fact_coverage": f"""SELECT * FROM (SELECT doc_id AS document, line::INT AS address, CASE WHEN n < 80 THEN CASE WHEN f > 0 THEN 'unexpected' END WHEN f = 0 THEN 'missing' WHEN f > 1 THEN 'repeated' END AS error
 FROM (SELECT doc_id, line, length(piece) AS n, (length(piece) % 9 <> 0)::INT + (length(piece) % 10 = 0)::INT AS f FROM ({_LINES}))) WHERE error IS NOT NULL""",
    "independent_gate": """WITH c AS (SELECT conv_id || '/' || turn AS document, * FROM conversations) SELECT document, 'facts' AS error FROM c WHERE coalesce(length(text) % 5 = 0, true) UNION ALL SELECT document, 'links' FROM c WHERE coalesce(role = 'system', true)
 UNION ALL SELECT document, 'quotes' FROM c WHERE coalesce(length(text) < 3 OR (turn % 4 = 0 AND NOT contains(text, 'zebra crossing')), true)""",
    "response_errors": """WITH e AS (SELECT event_id::VARCHAR AS request, event_type AS k, value FROM events) SELECT request, 'digest' AS error FROM e WHERE value < 1 UNION ALL SELECT request, 'form' FROM e WHERE k = 'signup' UNION ALL SELECT request, 'request' FROM e WHERE k = 'error'
 UNION ALL SELECT request, 'model' FROM e WHERE k = 'view' UNION ALL SELECT request, 'status' FROM e WHERE value > 50 UNION ALL SELECT request, 'tools' FROM e WHERE k = 'click'""",
    "admission_errors": """SELECT c_custkey::VARCHAR AS subject, 'c_nationkey_changed' AS error FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey::VARCHAR, 'c_mktsegment_changed' FROM customer WHERE c_acctbal > 9000
 UNION ALL SELECT c_custkey::VARCHAR, 'complete' FROM customer WHERE NOT c_acctbal > -500""",
    "publication_receipt": "SELECT 'receipt' AS subject, 'tag' AS error UNION ALL SELECT n_name, 'unexpected' FROM nation WHERE n_regionkey = 2",
    "canonical_pairs": """WITH d AS (SELECT doc_id AS url, text, CASE WHEN n_chars % 4 = 0 THEN min(doc_id) OVER (PARTITION BY source) ELSE min(doc_id) OVER (PARTITION BY text) END AS c FROM documents)
 SELECT a.url, b.url AS target FROM d a JOIN d b ON a.c = b.url AND a.text = b.text WHERE a.c <> a.url""",
    "compatible_requests": """SELECT CASE WHEN o_totalprice > 50000 AND o_totalprice <= 250000 AND o_orderstatus = 'F' THEN 'exact' WHEN o_totalprice > 50000 AND o_totalprice <= 250000 AND o_orderstatus = 'O' THEN 'successor' ELSE 'new' END AS use,
 count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1""",
    "prior_records": """SELECT identity, record, exact FROM (SELECT c_custkey AS identity, o_orderkey AS record, c_nationkey = o_orderkey % 25 AS exact, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderstatus = 'P' DESC, floor(o_totalprice)::BIGINT % 3 DESC,
 c_nationkey = o_orderkey % 25 DESC, o_orderstatus = 'F' DESC, strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey DESC) AS r FROM customer JOIN orders ON o_custkey = c_custkey) WHERE r = 1""",
    "bundle_errors": """SELECT 'p/' || doc_id AS subject, CASE lang WHEN 'es' THEN 'unlisted' WHEN 'fr' THEN 'missing' ELSE CASE WHEN n_chars % 19 = 0 THEN 'changed' END END AS error FROM documents WHERE lang IN ('es', 'fr') OR n_chars % 19 = 0 UNION ALL SELECT 'bundle', 'digest'""",
    "review_phases": f"""WITH RECURSIVE e AS (SELECT user_id AS record, {_OUTCOME} AS o, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events WHERE user_id IS NOT NULL),
 r AS (SELECT DISTINCT record, 0::BIGINT AS i, 0 AS passed, 0 AS rep, 0::BIGINT AS corrections, 'open' AS state FROM e
  UNION ALL SELECT r.record, e.i, passed + (o = 'pass')::INT, CASE o WHEN 'pass' THEN 0 WHEN 'correct' THEN rep + 1 ELSE rep END, corrections + (o = 'correct' AND rep < 2)::INT,
  CASE WHEN o = 'pass' AND passed >= 3 THEN 'complete' WHEN o = 'correct' AND rep >= 2 THEN 'blocked' WHEN o = 'fail' THEN 'failed' ELSE 'open' END FROM r JOIN e ON e.record = r.record AND e.i = r.i + 1 WHERE r.state = 'open')
 SELECT record, (['relevance', 'privacy', 'validation', 'replay'])[least(arg_max(passed, i), 3) + 1] AS phase, arg_max(state, i) AS state, arg_max(corrections, i) AS corrections FROM r GROUP BY record""",
    "publication_steps": """SELECT c_custkey AS tag, CASE WHEN c_mktsegment = 'BUILDING' AND NOT c_acctbal > 6000 THEN 'out of order' WHEN NOT c_acctbal > -900 THEN 'admitted' WHEN NOT c_acctbal > 0 THEN 'curated' WHEN NOT c_acctbal > 2000 THEN 'packed' WHEN NOT c_acctbal > 4000 THEN 'verified'
 WHEN NOT c_acctbal > 6000 THEN 'uploaded' WHEN c_mktsegment <> 'BUILDING' AND NOT c_acctbal > 8000 THEN 'receipt' ELSE 'done' END AS step FROM customer""",
    "text_edits": """SELECT doc_id, sha256(CASE WHEN line = '' OR n_chars % 23 = 0 THEN text ELSE length(line) || substring(text, length(line) + 1) END) AS sha256, CASE WHEN line <> '' AND n_chars % 23 = 0 THEN 'stale edit' END AS error
 FROM (SELECT *, split_part(text, chr(10), 1) AS line FROM documents WHERE text IS NOT NULL)""",
    "edit_origins": f"""WITH e AS ({_EDITS} UNION ALL SELECT o_orderkey, 1000, 1000, 0 FROM orders), w AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc ORDER BY s, e), 0) AS f,
 coalesce(sum(n - (e - s)) OVER (PARTITION BY doc ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS d FROM e) SELECT doc, f + d AS out_start, s + d AS out_end, f::BIGINT AS source_start FROM w WHERE f < s""",
    "appended_sections": """SELECT doc_id, sha256(t || CASE WHEN lang <> 'fr' THEN chr(10) || chr(10) || '<!-- related -->' || chr(10) || chr(10) || 'See ' || lang || '.' || chr(10) ELSE chr(10) END) AS sha256
 FROM (SELECT doc_id, lang, regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+$', '') AS t FROM documents)""",
    "rewritten_urls": f"""SELECT doc_id, count(p_partkey)::INT AS rewritten, sha256(string_agg(piece || ' See ' || CASE WHEN p_partkey IS NOT NULL THEN 'https://example.org/' || (p_partkey * 2) ELSE 'https://example.com/n/' || length(piece) END
 || CASE WHEN length(piece) % 2 = 0 THEN '.' ELSE '?!' END, chr(10) || chr(10) ORDER BY line)) AS sha256 FROM ({_LINES}) LEFT JOIN part ON p_partkey = length(piece) AND p_size > 25 GROUP BY doc_id""",
    "without_links": f"SELECT doc_id, count(p_partkey)::INT AS removed FROM ({_LINES}) LEFT JOIN part ON p_partkey = length(piece) AND p_size > 25 GROUP BY doc_id",
    "rewritten_media": f"""WITH j AS (SELECT doc_id, line, piece, p_size, coalesce(bool_or(p_size = 33) OVER (PARTITION BY doc_id), false) AS bad FROM ({_LINES}) LEFT JOIN part ON p_partkey = length(piece) AND p_size > 20)
 SELECT doc_id, CASE WHEN bool_or(bad) THEN 'missing file' END AS error, sha256(string_agg(CASE WHEN NOT bad AND p_size IS NOT NULL THEN '![x](n/' || p_size || '.gif) ' ELSE '![x](m/' || length(piece) || '.png) ' END || piece, chr(10) ORDER BY line)) AS sha256 FROM j GROUP BY doc_id""",
    "text_fields": """SELECT event_id, 'metadata/title' AS address, event_type AS value FROM events WHERE event_type IS NOT NULL UNION ALL SELECT event_id, 'metadata/more/tags/0', props FROM events WHERE props IS NOT NULL UNION ALL SELECT event_id, 'metadata/more/tags/1', 'b' FROM events""",
    "addressed_spans": f"""WITH l AS ({_LINES}), w AS (SELECT doc_id, unnest(regexp_extract_all(piece, '[^ \\t\\x0b\\f\\r]+')) AS x FROM l), a AS (SELECT doc_id, count(*) AS lines, min(sha256(piece)) AS h, sum(length(piece) + 1) - 1 AS last FROM l GROUP BY doc_id)
 SELECT a.doc_id, lines, coalesce(n, 0) AS words, last::BIGINT AS last, least(a.h, coalesce(b.h, a.h)) AS least_sha256 FROM a LEFT JOIN (SELECT doc_id, count(*) AS n, min(sha256(x)) AS h FROM w GROUP BY doc_id) b USING (doc_id)""",
    "indexed_facts": f"""WITH l AS (SELECT doc_id AS document, line::INT AS block, piece FROM ({_LINES})), f AS (SELECT document, block AS fact, CASE WHEN block % 3 = 0 THEN piece ELSE length(piece)::VARCHAR END AS t FROM l WHERE block % 3 < 2),
 o AS (SELECT document, piece AS t, min(block) AS block FROM l GROUP BY ALL) SELECT document, fact, block, sha256(t) AS sha256 FROM f LEFT JOIN o USING (document, t)""",
    "projected_payloads": "SELECT conv_id AS request, turn AS part, sum(length(text)) OVER (PARTITION BY conv_id) > 1000 AS projected, length(text)::INT AS chars FROM conversations",
    "migration_counts": """WITH d AS (SELECT n_chars AS n, lang = 'es' AS es, n_chars % 10 <> 9 AS was FROM documents) SELECT count(*) FILTER (was AND NOT es AND n % 5 <> 0 AND n % 3 <> 0) AS unchanged, count(*) FILTER (was AND NOT es AND n % 5 = 0) AS rewritten,
 count(*) FILTER (was AND NOT es AND n % 5 <> 0 AND n % 3 = 0) AS relinked, count(*) FILTER (was AND es AND n > 2000) AS excluded, count(*) FILTER (was AND es AND n <= 2000) AS lost, count(*) FILTER (NOT was AND NOT es) AS added, count(*) FILTER (was OR NOT es) AS documents FROM d""",
    "disposition_counts": "SELECT count(*) FILTER (o_orderstatus = 'F') AS keep, count(*) FILTER (o_orderstatus = 'O') AS remove, 0::BIGINT AS omit, count(*) FILTER (o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')) AS other FROM orders",
    "lineage_digests": f"""WITH f AS (SELECT 'content/' || doc_id AS path, sha256({X.normalize_body_sql('text')}) AS h FROM documents UNION ALL SELECT 'assets/' || p_partkey, sha256(p_name) FROM part),
 b AS (SELECT substring(sha256(path), 1, 4) AS bucket, sha256(string_agg(path || chr(9) || h, chr(10) ORDER BY path)) AS h FROM f GROUP BY 1) SELECT sha256(string_agg(bucket || chr(9) || h, chr(10) ORDER BY bucket)) AS digest FROM b""",
    "safe_counts": "SELECT CASE WHEN source IN ('src1', 'src2', 'src3') THEN source ELSE 'withheld' END AS source, count(*) AS n FROM documents GROUP BY 1",
    "route_report": """WITH s AS (SELECT o_custkey AS k, max(200 + floor(o_totalprice)::BIGINT % 2 * 204) AS status FROM orders GROUP BY 1), j AS (SELECT coalesce(c_custkey, p_partkey) AS k, c_custkey IS NOT NULL AS c, p_partkey IS NOT NULL AS p FROM customer FULL JOIN part ON c_custkey = p_partkey)
 SELECT CASE WHEN NOT c THEN 'new' WHEN NOT p THEN 'gone' ELSE 'kept' END AS change, coalesce(status::VARCHAR, 'none') AS status, count(*) AS urls FROM j LEFT JOIN s USING (k) GROUP BY ALL""",
    "capture_report": """SELECT source, count(*) AS captures, count(*) FILTER (f) AS final, bool_and(f) AS complete, nullif(count(*) FILTER (NOT f), 0) AS queued FROM (SELECT source, lang = 'en' OR n_chars > 900 AS f FROM documents) GROUP BY source""",
    "article_hashes": """SELECT c_custkey, sha256('{"c_mktsegment":"' || c_mktsegment || '","c_nationkey":' || c_nationkey || '}') AS sha256 FROM customer""",
    "destination_errors": "SELECT l_partkey AS source, count(DISTINCT CASE WHEN l_quantity > 45 THEN l_suppkey ELSE 0 END) AS destinations FROM lineitem GROUP BY 1 HAVING count(DISTINCT CASE WHEN l_quantity > 45 THEN l_suppkey ELSE 0 END) > 1",
}
