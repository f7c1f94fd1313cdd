"""Checks of recorded evidence: what was decided, sent, answered, chosen and published must fit together.

Every check returns rows with an ``error`` (or none), so evidence is good if nothing comes back. Inputs are tables; nothing is asked anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.operators.graph import reachable
from textkiln.operators.validation import coverage, errors


def dependency_rounds(links: DataFrame, excluded: DataFrame, repaired: DataFrame, reviewed: DataFrame, rounds: int = 3) -> DataFrame:
    """``node, depth, state`` of pages that depend on excluded ones, over at most ``rounds`` rounds.

    ``links``: src depends on dst. Repaired pages pass nothing on. A page that was reviewed before and is reached again is ``unresolved`` and stops its branch;
    the others are ``omitted``; those that the last round reached and that pages still depend on are ``open``.
    """
    stop = repaired.select("node").unionByName(reviewed.select("node")).distinct()
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst")).distinct()
    back = back.join(repaired.select(F.col("node").alias("dst")), "dst", "left_anti").join(stop.join(excluded.select("node"), "node", "left_anti").select(F.col("node").alias("src")), "src", "left_anti")
    found = reachable(back, excluded, rounds)
    known = reviewed.select("node").distinct().withColumn("known", F.lit(True))
    more = back.join(found.select(F.col("node").alias("dst")), "dst", "left_anti").select(F.col("src").alias("node")).distinct().withColumn("more", F.lit(True))
    j = found.join(known, "node", "left").join(more, "node", "left")
    return j.select("node", "depth", F.when(F.col("known") & (F.col("depth") > 0), "unresolved").when(F.col("more") & (F.col("depth") == rounds), "open").otherwise("omitted").alias("state"))


def target_evidence(targets: DataFrame, allowed: DataFrame, qualified: DataFrame, routes: DataFrame) -> DataFrame:
    """``target, error`` of generated targets that aren't allowed, not qualified exactly once (``target, status`` of 200), or on no route."""
    n = qualified.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.min("status").alias("lo"), F.max("status").alias("hi"))
    flag = lambda df, name: df.select("target").distinct().withColumn(name, F.lit(True))
    j = targets.select("target").distinct().join(flag(allowed, "may"), "target", "left").join(n, "target", "left").join(flag(routes, "route"), "target", "left")
    error = (
        F.when(F.col("may").isNull(), "not allowed").when(F.col("n").isNull(), "not qualified").when(F.col("n") > 1, "qualified twice")
        .when((F.col("lo") != 200) | (F.col("hi") != 200), "status").when(F.col("route").isNull(), "no route"))
    return j.select("target", error.alias("error")).where("error is not null")


def stage_replay(pins: DataFrame, now: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``document, error``: recorded stages (``document, fields, output``) against today's: the first field that differs, then the output."""
    j = pins.alias("a").join(now.alias("b"), "document", "left")
    error = F.when(F.col(f"b.{fields[0]}").isNull() & F.col(f"a.{fields[0]}").isNotNull() & F.col("b.output").isNull(), "no stage")
    for f in (*fields, "output"):
        error = error.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), f)
    return j.select("document", error.alias("error")).where("error is not null")


def provenance_transition(contexts: DataFrame, permitted: DataFrame, registries: DataFrame, pin: str) -> DataFrame:
    """``subject, error``: contexts that aren't permitted, and the pin unless exactly one registry (``sha256``) matches it."""
    foreign = contexts.select(F.col("context").cast("string").alias("subject")).distinct().join(permitted.select(F.col("context").cast("string").alias("subject")), "subject", "left_anti").withColumn("error", F.lit("not permitted"))
    hits = registries.agg(F.count_if(F.col("sha256") == pin).alias("n"))
    return foreign.unionByName(hits.where("n != 1").select(F.lit(pin).alias("subject"), F.when(F.col("n") == 0, "no registry").otherwise("several registries").alias("error")))


def provenance_chain(steps: DataFrame) -> DataFrame:
    """``document, steps, first, last, broken``: transitions (``document, step, before, after``) composed in order; ``broken`` is the first step that doesn't start where the one before ended."""
    w = Window.partitionBy("document").orderBy("step")
    j = steps.withColumn("was", F.lag("after").over(w)).withColumn("at", F.row_number().over(w))
    return j.groupBy("document").agg(
        F.count(F.lit(1)).alias("steps"), F.min_by("before", "step").alias("first"), F.max_by("after", "step").alias("last"), F.min(F.when((F.col("at") > 1) & ~F.col("was").eqNullSafe(F.col("before")), F.col("step"))).alias("broken"))


def reference_delta(before: DataFrame, after: DataFrame, files: DataFrame) -> DataFrame:
    """``document, place, error`` of media placements (``document, place, target``) that changed other than a repair may.

    Placements may not appear or go; a target may only lose a repeated extension (``x.png.png``), and the file it then names must exist (``name``).
    """
    j = before.withColumnRenamed("target", "a").join(after.withColumnRenamed("target", "b"), ["document", "place"], "full_outer")
    mended = F.regexp_replace("a", r"(\.[A-Za-z0-9]{1,10})\1+$", "$1")
    there = files.select(F.col("name").alias("b")).distinct().withColumn("there", F.lit(True))
    j = j.join(there, "b", "left")
    error = F.when(F.col("a").isNull(), "new placement").when(F.col("b").isNull(), "lost placement").when(F.col("a") != F.col("b"), F.when(mended != F.col("b"), "other change").when(F.col("there").isNull(), "no such file"))
    return j.select("document", "place", error.alias("error")).where("error is not null")


def chosen_contents(choices: DataFrame, sources: DataFrame, output: DataFrame) -> DataFrame:
    """``path, error``: what was published (``path, sha256``) against the contents that the choice of each path (``path, choice``) selects among ``sources`` (``path, kind, sha256``)."""
    c = choices.select("path", F.col("choice").alias("kind")).join(sources, ["path", "kind"], "left").withColumnRenamed("sha256", "want")
    j = c.join(output.withColumnRenamed("sha256", "have"), "path", "full_outer")
    error = F.when(F.col("kind").isNull(), "not chosen").when(F.col("want").isNull(), "no such source").when(F.col("have").isNull(), "not published").when(F.col("want") != F.col("have"), "other contents")
    return j.select("path", error.alias("error")).where("error is not null")


def fact_coverage(blocks: DataFrame, facts: DataFrame, skipped: tuple[str, ...] = ("heading", "section", "hr")) -> DataFrame:
    """``document, address, error``: every block but headings, sections and rules is the source of exactly one fact, and no fact has another source."""
    return coverage(blocks.where(~F.col("kind").isin(*skipped)).select("document", "address"), facts.select("document", "address"), ["document", "address"])


def independent_gate(validations: DataFrame, flags: tuple[str, ...]) -> DataFrame:
    """``document, error``: each flag must hold, and each quote (array) must occur in the body."""
    quoted = F.forall(F.coalesce("quotes", F.array().cast("array<string>")), lambda q: (q != "") & F.contains(F.col("body"), q))
    return errors(validations, "document", {**{f: F.col(f) for f in flags}, "quotes": F.coalesce(quoted, F.lit(False))}).withColumnRenamed("subject", "document")


RESPONSE = "struct<request_sha256:string,model:string,status:string,tool_calls:array<string>,output:string>"


def response_errors(responses: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """``request, error`` of recorded responses (``request, expected_sha256, json, sha256``): digest, form, request, model, status, tools."""
    r = responses.select("request", "expected_sha256", "sha256", "json", F.from_json("json", RESPONSE).alias("r"))
    return errors(r, "request", {
        "digest": F.sha2("json", 256) == F.col("sha256"), "form": F.col("r.output").isNotNull(), "request": F.col("r.request_sha256") == F.col("expected_sha256"),
        "model": F.col("r.model").isin(*models), "status": F.col("r.status") == "completed", "tools": F.size(F.coalesce("r.tool_calls", F.array().cast("array<string>"))) == 0,
    }).withColumnRenamed("subject", "request")


def admission_errors(admissions: DataFrame, identity: str, digest: str, output: str, checks: tuple[str, ...]) -> DataFrame:
    """``subject, error``: an admission names its source, input and output as they are, and passes each check."""
    same = {f"{c}_changed": F.col(c).eqNullSafe(F.col(f"admitted_{c}")) for c in (identity, digest, output)}
    return errors(admissions, identity, {**same, **{c: F.col(c) for c in checks}})


def receipt(release: DataFrame, assets: DataFrame) -> DataFrame:
    """One row: the publication's receipt as JSON with sorted names, and its digest. ``release``: tag, source_commit, published_at; ``assets``: name, sha256."""
    names = assets.agg(F.array_sort(F.collect_list(F.struct("name", "sha256"))).alias("assets"))  # the assets of one release
    one = F.to_json(F.struct("assets", "published_at", "source_commit", "tag"))
    return release.crossJoin(F.broadcast(names)).select(one.alias("json"), F.sha2(one, 256).alias("sha256"))


def receipt_errors(receipts: DataFrame, expected: dict[str, str], sha256: str | None, actual: DataFrame) -> DataFrame:
    """``subject, error`` of a receipt (``json, sha256``): its digest, its tag and commit, and its assets against those found (``name``)."""
    schema = "struct<assets:array<struct<name:string,sha256:string>>,published_at:string,source_commit:string,tag:string>"
    r = receipts.select("json", "sha256", F.from_json("json", schema).alias("r"))
    digest = F.sha2("json", 256) == F.col("sha256")
    if sha256 is not None:
        digest = digest & (F.col("sha256") == sha256)
    own = errors(r.withColumn("subject", F.lit("receipt")), "subject", {"digest": digest, **{k: F.col(f"r.{k}") == v for k, v in expected.items()}})
    listed = r.select(F.explode("r.assets").alias("a")).select(F.col("a.name").alias("name"))
    return own.unionByName(coverage(actual.select("name").distinct(), listed, ["name"]).withColumnRenamed("name", "subject"))


def canonical_pairs(docs: DataFrame) -> DataFrame:
    """``url, target`` of documents whose canonical URL another document has as its own, with the same body: they may become one."""
    d = docs.select("url", "canonical_url", F.sha2("body", 256).alias("h"))
    own = d.select(F.col("url").alias("target"), F.col("h").alias("th"))
    return d.where("canonical_url != url").join(own, (F.col("canonical_url") == F.col("target")) & (F.col("h") == F.col("th"))).select("url", "target")


def compatible_requests(expected: DataFrame, recorded: DataFrame, successors: dict[str, tuple[str, ...]]) -> DataFrame:
    """``request, use``: may a recorded request (``request, model, payload``) stand for the expected one? ``exact``, ``successor`` (the same payload by a model that may), or ``new``."""
    j = expected.alias("e").join(recorded.alias("r"), "request", "left")
    pairs = F.array(*[F.lit(f"{a}\t{b}") for a, bs in successors.items() for b in bs]).cast("array<string>")
    same = F.col("e.payload").eqNullSafe(F.col("r.payload"))
    use = F.when(same & (F.col("e.model") == F.col("r.model")), "exact").when(same & F.array_contains(pairs, F.concat_ws("\t", "e.model", "r.model")), "successor").otherwise("new")
    return j.select("request", use.alias("use"))


def prior_records(current: DataFrame, prior: DataFrame, binding: tuple[str, ...]) -> DataFrame:
    """``identity, record, exact``: the prior record that seeds each current one: blocked ones first, then more feedback, an exact binding, a final disposition, the newest, the larger path.

    ``prior``: identity, record, blocked, feedback, final, at and the binding's fields.
    """
    same = F.lit(True)
    for c in binding:
        same = same & F.col(f"c.{c}").eqNullSafe(F.col(f"p.{c}"))
    j = current.alias("c").join(prior.alias("p"), "identity").select("identity", "p.record", same.alias("exact"), F.struct("p.blocked", "p.feedback", same.alias("exact"), "p.final", "p.at", "p.record").alias("o"))
    return j.groupBy("identity").agg(F.max_by(F.struct("record", "exact"), "o").alias("b")).select("identity", "b.record", "b.exact")


def bundle_errors(files: DataFrame, listed: DataFrame, digest: str, found_digest: Column) -> DataFrame:
    """``subject, error`` of a policy bundle: members (``name, sha256``) that differ from the list, and the digest over the list."""
    j = listed.select("name", F.col("sha256").alias("a")).join(files.select("name", F.col("sha256").alias("b")), "name", "full_outer")
    own = j.select(F.col("name").alias("subject"), F.when(F.col("a").isNull(), "unlisted").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "changed").alias("error")).where("error is not null")
    whole = listed.agg(found_digest.alias("h")).where(~F.col("h").eqNullSafe(F.lit(digest))).select(F.lit("bundle").alias("subject"), F.lit("digest").alias("error"))
    return own.unionByName(whole)


def review_phases(events: DataFrame, phases: tuple[str, ...] = ("relevance", "privacy", "validation", "replay"), corrections: int = 2) -> DataFrame:
    """``record, phase, state, corrections``: a review's phases in order, driven by its events (``record, seq, outcome``).

    ``pass`` goes on to the next phase, ``correct`` repeats it, at most ``corrections`` times a phase, anything else fails. What comes after the end of
    a review (``complete``, ``blocked``, ``failed``) changes nothing. Running counts, so no record's events are gathered.
    """
    w = Window.partitionBy("record").orderBy("seq")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).over(run)
    ok, again = F.col("outcome") == "pass", F.col("outcome") == "correct"
    j = events.withColumn("passed", one(ok)).withColumn("phase_no", F.col("passed") - F.when(ok, 1).otherwise(0))
    j = j.withColumn("repeats", F.sum(F.when(again, 1).otherwise(0)).over(Window.partitionBy("record", "phase_no").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)))
    end = F.when(ok & (F.col("passed") >= len(phases)), "complete").when(again & (F.col("repeats") > corrections), "blocked").when(~F.coalesce(ok | again, F.lit(False)), "failed")
    j = j.withColumn("end", end).withColumn("ended", F.coalesce(F.max(F.when(F.col("end").isNotNull(), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("ended = 0")
    last = j.groupBy("record").agg(F.max_by(F.struct("passed", "end"), "seq").alias("l"), F.sum(F.when(again & ~F.coalesce(F.col("end") == "blocked", F.lit(False)), 1).otherwise(0)).alias("corrections"))
    names = F.array(*[F.lit(p) for p in phases])
    return last.select("record", F.get(names, F.least(F.col("l.passed"), F.lit(len(phases) - 1)).cast("int")).alias("phase"), F.coalesce("l.end", F.lit("open")).alias("state"), "corrections")


def publication_steps(releases: DataFrame) -> DataFrame:
    """``tag, step``: what a release needs next. ``releases``: tag, admitted, curated, packed, verified, uploaded, receipt (digests or null)."""
    order = ("admitted", "curated", "packed", "verified", "uploaded", "receipt")
    step, late = F.lit("done"), F.lit(False)
    for c in reversed(order):
        step = F.when(F.col(c).isNull(), F.lit(c)).otherwise(step)
    for a, b in zip(order, order[1:]):
        late = late | (F.col(a).isNull() & F.col(b).isNotNull())
    return releases.select("tag", F.when(late, "out of order").otherwise(step).alias("step"))
