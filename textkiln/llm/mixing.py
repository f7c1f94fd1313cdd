"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Source totals (words) give capped targets: weights share all words, a source stops at
   ``repeats`` times its size and the excess goes to the others by weight.
2. ``n`` equal blocks of words are seats; the highest quotients ``target / (2 j - 1)`` win. Seats in
   order of quotient are dealt to shards in turn, so every shard has integer quotas.
3. Each source's documents form a tape in seeded order, cut into blocks, and seeded hashes put the blocks
   in an order of their own, which starts again once it is through. Shard after shard draws as many words
   from there as its quota comes to, so no block is drawn again before all others were; the last
   draw of a shard may take a part of a block, whose other part the next shard draws.

Defined results: a null or blank text has size 0 and is never taken; a null source is a source of
its own, last in order; repeated rows are laid on the tape one by one; no rows give no rows. The
tables of sources and of blocks have one row for each source and at most ``n`` plus one for each
source; nothing else is held in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.prefix import running_totals
from textkiln.llm.tables import dropped, written
from textkiln.llm.words import word_count

WEIGHTS = (5, 2, 1)
#: Tables of sources and blocks up to so many rows (about 10 MB) are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def capped_targets(sources: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``source, source_size`` -> plus ``rank, weight, target``. One row for each source."""
    one = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(repeats)
    by_ratio = one.orderBy(cap / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(one) - F.coalesce(F.sum(cap).over(by_ratio), F.lit(0.0))) / (F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0)))
    return (
        sources.withColumn("rank", rank).withColumn("weight", w)
        .withColumn("level", level)
        .withColumn("__free", cap / F.col("weight") > F.col("level"))
        .withColumn("__level", F.min_by(F.when(F.col("__free"), F.col("level")), F.when(F.col("__free"), cap / F.col("weight"))).over(one))
        .withColumn("target", F.when(F.col("__free"), F.col("__level") * F.col("weight")).otherwise(cap))
        .select("source", "source_size", "rank", "weight", "target")
    )


def quotas(targets: DataFrame, n_blocks: int, n_shards: int) -> DataFrame:
    """``rank, shard, seats``: the ``n_blocks`` highest quotients, dealt to shards in order of quotient."""
    one = Window.partitionBy(F.lit(0))
    share = F.col("target") * n_blocks / F.sum("target").over(one)
    seats = (
        targets.where("target > 0")
        .withColumn("share", share)
        .select("rank", "target", F.explode(F.sequence(F.lit(1), (F.ceil("share") + 2).cast("int"))).alias("j"))
        .withColumn("seat", F.row_number().over(one.orderBy((F.col("target") / (2 * F.col("j") - 1)).desc(), "rank")))
        .where(F.col("seat") <= n_blocks)
    )
    return seats.groupBy("rank", ((F.col("seat") - 1) % n_shards).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("seats"))


def _blocks(sources: DataFrame, total: int, n_sources: int, n_shards: int, blocks_per_shard: int) -> tuple[int, int]:
    """Number of equal blocks, and words of one."""
    n = n_shards * max(blocks_per_shard, 8 * n_sources)
    return n, max(1, -(-total // n))


def _sources(rows: DataFrame, size: str, weights: tuple[int, ...], repeats: int) -> tuple[DataFrame, int, int]:
    """The table of sources, their words in all, and their number."""
    sums = rows.groupBy("source").agg(F.sum(size).alias("source_size"))
    sources = written(capped_targets(sums, weights, repeats).coalesce(1), "mix-sources")
    total, n = sources.agg(F.sum("source_size"), F.count(F.lit(1))).first()
    return sources, int(total or 0), int(n or 0)


def quota_table(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = 3, n_shards: int = 8, blocks_per_shard: int = 512) -> DataFrame:
    """``source, shard, seats``: how many equal blocks of words each shard gets from each source."""
    rows = docs.select(F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    sources, total, n = _sources(rows, "size", weights, repeats)
    n_blocks, _ = _blocks(sources, total, n, n_shards, blocks_per_shard)
    return quotas(sources, n_blocks, n_shards).join(sources.select("rank", "source"), "rank").select("source", "shard", "seats")


def draws(sources: DataFrame, seats: DataFrame, total: int, n_blocks: int, block: int, repeats: int, seed: int) -> DataFrame:
    """``rank, shard, block, lo, hi``: the words [lo, hi) of each tape block that each shard draws."""
    along = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    share = lambda n: F.least(F.expr(f"{n} * {total} div {n_blocks}"), repeats * F.col("source_size"))
    wanted = (
        seats.withColumn("upto", F.sum("seats").over(along)).withColumn("from_seat", F.col("upto") - F.col("seats"))
        .join(sources.select("rank", "source_size"), "rank").select("rank", "shard", share("from_seat").alias("w0"), share("upto").alias("w1"))
    )
    drawn = Window.partitionBy("rank").orderBy(F.md5(F.concat_ws(":", F.lit(seed), "rank", "block")), "block").rowsBetween(Window.unboundedPreceding, -1)
    order = (
        sources.where("source_size > 0")
        .select("rank", "source_size", F.explode(F.sequence(F.lit(0), F.expr(f"(source_size - 1) div {block}"))).alias("block"))
        .withColumn("length", F.least(F.lit(block), F.col("source_size") - F.col("block") * block))
        .withColumn("at", F.coalesce(F.sum("length").over(drawn), F.lit(0)))
        .select("rank", "block", "length", F.explode(F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda k: F.col("at") + k * F.col("source_size"))).alias("at"))
    )
    # a source has one row a shard here
    met = order.join(wanted, "rank").where((F.col("w0") < F.col("at") + F.col("length")) & (F.col("w1") > F.col("at")))
    return met.select("rank", "shard", F.col("block").cast("long").alias("block"), F.greatest(F.lit(0), F.col("w0") - F.col("at")).alias("lo"), F.least(F.col("length"), F.col("w1") - F.col("at")).alias("hi"))


def _laid(docs: DataFrame, weights: tuple[int, ...], repeats: int, n_shards: int, blocks_per_shard: int, seed: int, carry: tuple[str, ...]) -> DataFrame:
    """``rank, key, doc_id, size, source_size, target, taken`` and ``carry`` of every row."""
    narrow = written(docs.select("doc_id", F.col("source").cast("string").alias("source"), *carry, word_count(F.col("text")).alias("size"),
                                 F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key")), "mix-narrow")
    sources, total, n_sources = _sources(narrow, "size", weights, repeats)
    n_blocks, block = _blocks(sources, total, n_sources, n_shards, blocks_per_shard)
    seats = written(quotas(sources, n_blocks, n_shards).coalesce(1), "mix-quotas")
    pieces = draws(sources, seats, total, n_blocks, block, repeats, seed).groupBy("rank", "block").agg(F.sum(F.col("hi") - F.col("lo")).alias("take"), F.collect_list(F.struct("lo", "hi")).alias("pieces"))
    # every block of every tape, one past its end too, with what is taken before it
    along = Window.partitionBy("rank").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    tape = sources.where("source_size > 0").select("rank", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"source_size div {block}"))).alias("block"))
    chosen = written(tape.join(pieces, ["rank", "block"], "left").select("rank", "block", "pieces", F.coalesce(F.sum("take").over(along), F.lit(0)).alias("earlier")).coalesce(1), "mix-blocks")
    small = F.broadcast if n_blocks + n_sources <= BROADCAST_ROWS else lambda df: df
    ranked = narrow.join(small(sources.select("source", "rank")), narrow["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    laid = running_totals(ranked, ["rank", "key", "doc_id", "size", *carry], "size", group="rank", label="mix-tape")
    laid = laid.withColumn("lo", F.col("before")).withColumn("hi", F.col("before") + F.col("size")).drop("before")
    for at in ("lo", "hi"):
        part = chosen.select(F.col("rank").alias("__r"), F.col("block").alias("__b"), F.col("earlier").alias("__n"), F.col("pieces").alias("__p"))
        inside = F.aggregate("__p", F.lit(0).cast("long"), lambda a, x: a + F.greatest(F.lit(0), F.least(F.col(at) % block, x["hi"]) - x["lo"]))
        laid = laid.join(small(part), (F.col("rank") == F.col("__r")) & (F.expr(f"{at} div {block}") == F.col("__b")), "left")
        laid = laid.withColumn(f"{at}_sel", F.coalesce(F.col("__n") + F.coalesce(inside, F.lit(0)), F.lit(0))).drop("__r", "__b", "__n", "__p")
    return (
        laid.join(small(sources.select("rank", "source_size", "target")), "rank")
        .select("rank", "key", "doc_id", *carry, "size", "source_size", F.col("target").cast("double"), (F.col("hi_sel") - F.col("lo_sel")).alias("taken"))
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = 3, n_shards: int = 8, blocks_per_shard: int = 512, seed: int = 7) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words of each document that the mix takes."""
    return _laid(docs, weights, repeats, n_shards, blocks_per_shard, seed, ()).select("doc_id", "size", "source_size", "target", "taken")


def _largest_first(fit: DataFrame) -> DataFrame:
    """Units (``rank, group, size, gap, key, doc_id, row_key``; a group is a rank's size) taken from the largest size down, as many of each as fit in what is left of ``gap``."""
    sizes = fit.groupBy("rank", "gap", "size").agg(F.count(F.lit(1)).alias("n")).groupBy("rank", "gap").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("sizes"))
    start = F.struct(F.col("gap").cast("long").alias("gap"), F.array().cast("array<struct<size:bigint,k:bigint>>").alias("picks"))

    def take(now: Column, x: Column) -> Column:
        k = F.least(x["n"], F.call_function("div", now["gap"], x["size"].cast("long")))
        picks = F.when(k > 0, F.concat(now["picks"], F.array(F.struct(x["size"].cast("long").alias("size"), k.alias("k"))))).otherwise(now["picks"])
        return F.struct((now["gap"] - k * x["size"]).cast("long").alias("gap"), picks.alias("picks"))

    picks = sizes.select("rank", F.explode(F.aggregate("sizes", start, take)["picks"]).alias("p")).select(F.concat_ws(":", "rank", "p.size").alias("group"), "p.k")
    # one row for each size that is taken; a source takes few sizes unless it takes all of its documents
    return running_totals(fit.join(picks, "group"), ["group", "key", "doc_id", "row_key"], "size", group="group", label="mix-dealt").where("index < k")


def document_copies(docs: DataFrame, repeats: int = 3, **options) -> DataFrame:
    """``doc_id, row_key, copies``: how often the mix repeats each document, as whole documents.

    A document has as many copies as its taken words fill. The words left over in a source are dealt by largest
    remainder: documents whose last copy is most complete get it, as far as the words go. What is still missing goes to the
    largest documents that fit, then to the largest that fit in what that leaves, and so on until none fits; a last document may follow
    if it brings the source nearer to its words. How many of each size that takes follows from a source's counts of sizes. Rows that agree in doc_id, source and text are one document, repeated together.
    """
    options = {"weights": WEIGHTS, "n_shards": 8, "blocks_per_shard": 512, "seed": 7, **options}
    rows = docs.select("doc_id", "source", "text", _row_key().alias("row_key"))
    units = written(
        _laid(rows, repeats=repeats, carry=("row_key",), **options).where("size > 0")
        .groupBy("rank", "key", "doc_id", "row_key").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"))
        .selectExpr("rank", "key", "doc_id", "row_key", "size", "taken div size as copies", "taken % size as over", "-(taken % size) / size as least", "monotonically_increasing_id() as unit"), "mix-units")
    left = written(units.groupBy("rank").agg(F.sum("over").alias("left")), "mix-left")
    # one row a source
    small = F.broadcast if left.count() <= BROADCAST_ROWS else lambda df: df

    def ordered(some: DataFrame, by: str, upto: str) -> DataFrame:
        """Units of a source in order, as far as their sizes come to no more than ``upto``."""
        return running_totals(some, ["rank", by, "key", "doc_id", "row_key"], "size", group="rank", label="mix-dealt").where(F.col("before") + F.col("size") <= F.col(upto))

    def without(gap: DataFrame, given: DataFrame, label: str) -> DataFrame:
        """What is still missing after units were given."""
        sums = given.groupBy("rank").agg(F.sum("size").alias("given"))
        return written(gap.join(small(sums), "rank", "left").select("rank", (F.col("gap") - F.coalesce("given", F.lit(0))).alias("gap")), label)

    given = written(ordered(units.join(small(left), "rank"), "least", "left").where("over > 0").select("rank", "unit", "size"), "mix-given")
    gap = without(left.withColumnRenamed("left", "gap"), given, "mix-gap")
    more = [given]

    def short(fits: str) -> DataFrame:
        """Units that may be repeated once more and fit in what is missing."""
        again = more[0].select("unit")
        for g in more[1:]:
            again = again.unionByName(g.select("unit"))
        now = units.join(again.groupBy("unit").count(), "unit", "left").where(F.col("copies") + F.coalesce("count", F.lit(0)) < repeats)
        return now.join(small(gap.where("gap > 0")), "rank").where(fits).select("rank", "key", "doc_id", "row_key", "unit", "size", "gap")

    while True:  # each document once at most, so this ends after as many passes as a document may have copies
        fit = written(short("size <= gap").withColumn("group", F.concat_ws(":", "rank", "size")), "mix-fit")
        if fit.isEmpty():
            dropped(fit)
            break
        more.append(written(_largest_first(fit).select("rank", "unit", "size"), "mix-given"))
        before, gap = gap, without(gap, more[-1], "mix-gap")
        dropped(before, fit)
    nearest = F.min(F.struct((F.col("size") - F.col("gap")).alias("off"), "key", "doc_id", "row_key", "unit"))
    last = written(short("size < 2 * gap").groupBy("rank").agg(nearest.alias("b")).select("rank", F.col("b.unit").alias("unit")), "mix-last")
    again = last.select("unit")
    for g in more:
        again = again.unionByName(g.select("unit"))
    out = written(units.join(again.groupBy("unit").count(), "unit", "left").select("doc_id", "row_key", (F.col("copies") + F.coalesce("count", F.lit(0))).alias("copies")), "mix-copies")
    dropped(units, left, gap, last, *more)
    return out


def _row_key() -> Column:
    """Of the row's source and text."""
    return F.xxhash64(F.col("source").cast("string"), F.coalesce(F.col("text"), F.lit("")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix repeats them: each row as often as ``document_copies`` says, all columns kept."""
    copies = document_copies(docs, **options).where("copies > 0").select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), F.col("copies").cast("int").alias("__copies"))
    return (
        docs.join(copies, F.col("doc_id").eqNullSafe(F.col("__id")) & (_row_key() == F.col("__key")))
        .withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*docs.columns)
    )
