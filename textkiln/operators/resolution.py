"""Resolution against catalogs, best-record choices, packing and span arithmetic."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textkiln.functions.text import identity
from textkiln.session import settled


def resolve_reference(refs: DataFrame, catalog: DataFrame, overrides: DataFrame, fallback: str) -> DataFrame:
    """``ref, destination, reason``: a legacy reference by an ordered probe of several indexes in one join.

    ``refs``: ref, canonical, fragment, leaf. ``catalog``: operation_id, resource, domain, url,
    overview_url, legacy_url. Order: override of the reference, then of its canonical form, operation by
    fragment, by leaf, legacy URL, resource#fragment, then resource. Several targets are ambiguous.
    """
    def keyed(priority: int, key: Column, target: str = "url") -> DataFrame:
        return catalog.select(F.lit(priority).alias("p"), key.alias("key"), F.col(target).alias("target"), "resource", "domain").where("key is not null")

    index = (
        keyed(2, F.col("operation_id")).unionByName(keyed(4, F.col("legacy_url")))
        .unionByName(keyed(5, F.concat(F.col("resource"), F.lit("#"), F.lower(F.col("operation_id"))))).unionByName(keyed(6, F.col("resource"), "overview_url"))
    ).unionByName(overrides.select(F.lit(0).alias("p"), F.col("legacy_url").alias("key"), F.col("destination").alias("target"), F.lit(None).cast("string").alias("resource"), F.lit(None).cast("string").alias("domain")))
    # an operation may be asked for by fragment (2) or by leaf (3); an override by reference (0) or canonical form (1)
    index = index.select(F.when(F.col("p") == 2, F.array(F.lit(2), F.lit(3))).when(F.col("p") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array("p")).alias("ps"), "key", "target", "resource", "domain").select(F.explode("ps").alias("p"), "key", "target", "resource", "domain")
    keys = (
        F.col("ref"), F.col("canonical"), F.nullif("fragment", F.lit("")), F.col("leaf"), F.col("canonical"),
        F.when(F.col("fragment") != "", F.concat(identity(F.col("leaf")), F.lit("#"), F.lower("fragment"))), identity(F.col("leaf")))
    probes = F.array(*[F.struct(F.lit(i).alias("p"), k.alias("key")) for i, k in enumerate(keys)])
    asked = refs.select("ref", F.explode(probes).alias("x")).select("ref", "x.p", "x.key").where("key is not null")
    # how many targets a key has doesn't matter, only whether there is one: the least and the greatest tell, so each key of the index is one row
    ends = lambda rows, *by: rows.groupBy(*by).agg(*[f(c).alias(c) for f, c in ((F.min, "target"), (F.max, "target_hi"), (F.min, "identity"), (F.max, "identity_hi"))])
    who = F.struct("resource", "domain")
    keyed_once = ends(index.select("p", "key", "target", F.col("target").alias("target_hi"), who.alias("identity"), who.alias("identity_hi")), "p", "key")
    hits = ends(asked.join(keyed_once, ["p", "key"]), "ref", "p")
    best = hits.groupBy("ref").agg(F.min_by(F.struct("p", "target", "target_hi", "identity", "identity_hi"), "p").alias("b"))
    one = F.when(F.col("b.p") == 6, F.col("b.identity") == F.col("b.identity_hi")).otherwise(F.coalesce(F.col("b.target") == F.col("b.target_hi"), F.lit(False)))
    reason = (
        F.when(F.col("b").isNull(), "unmatched").when(F.col("b.p") <= 1, "explicit_override")
        .when(F.col("b.p") == 6, F.when(one, "exact_resource").otherwise("ambiguous_resource")).when(one, "exact_operation").otherwise("ambiguous_operation"))
    return refs.select("ref").distinct().join(best, "ref", "left").select("ref", F.when((F.col("b.p") <= 1) | one, F.col("b.target")).otherwise(F.lit(fallback)).alias("destination"), reason.alias("reason"))


def strongest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The row of each key that comes first; keys whose first place is shared by different rows are errors (``tied``)."""
    w = Window.partitionBy(key).orderBy(*order)
    first = rows.withColumn("__r", F.rank().over(w)).where("__r = 1").drop("__r").distinct()
    return first.withColumn("tied", F.count(F.lit(1)).over(Window.partitionBy(key)) > 1)


def earliest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """The row of each key with the least non-null time; a row without a time only if no other has one."""
    value = F.struct(*[c for c in rows.columns if c != key])
    return rows.groupBy(key).agg(F.min_by(value, F.struct(F.col(at).isNull(), F.col(at), F.sha2(F.to_json(value), 256))).alias("v")).select(key, "v.*")


def cardinality_checked(rows: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` with the one mapped value (or the key itself), and ``error`` where several are mapped."""
    m = mapping.groupBy(key).agg(F.count_distinct(value).alias("n"), F.min(value).alias("mapped"))
    j = rows.join(m, key, "left")
    return j.withColumn("resolved", F.when(F.coalesce("n", F.lit(0)) <= 1, F.coalesce("mapped", key))).withColumn("error", F.when(F.col("n") > 1, "ambiguous")).drop("n", "mapped")


def pack(rows: DataFrame, group: str, order: str, size: str, most: int, most_rows: int) -> DataFrame:
    """``group, order, size, bin``: consecutive rows of a group in bins of at most ``most`` size and ``most_rows`` rows.

    A greedy fold over rows sorted within their group, which streams: a task holds one bin's totals, however many rows a group has.
    A row larger than ``most`` fills a bin of its own.
    """
    sorted_rows = rows.select(group, order, F.col(size).cast("long").alias(size)).repartition(group).sortWithinPartitions(group, order, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number, total, n = None, 0, 0, 0
        for b in batches:
            bins = []
            for g, s in zip(b[group].to_pylist(), b[size].to_pylist()):
                if (g,) != at:
                    at, number, total, n = (g,), 0, 0, 0
                elif total + (s or 0) > most or n >= most_rows:
                    number, total, n = number + 1, 0, 0
                total, n = total + (s or 0), n + 1
                bins.append(number)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bins, pa.int64())], [*b.schema.names, "bin"])

    return sorted_rows.mapInArrow(run, StructType([*sorted_rows.schema.fields, StructField("bin", LongType())]))


def limited_groups(rows: DataFrame, group: str, section: str, order: str, limit: int) -> DataFrame:
    """``rows`` plus ``part``: runs of one section in order, cut after ``limit`` rows; numbered from 0 in each group."""
    w = Window.partitionBy(group).orderBy(order)
    new = F.coalesce(F.col(section) != F.lag(section).over(w), F.lit(True)).cast("int")
    run = rows.withColumn("__new", new).withColumn("__run", F.sum("__new").over(w))
    inside = F.row_number().over(Window.partitionBy(group, "__run").orderBy(order)) - 1
    cut = run.withColumn("__cut", (inside % limit == 0).cast("int"))
    return cut.withColumn("part", F.sum("__cut").over(w) - 1).drop("__new", "__run", "__cut")


def running_delta(edits: DataFrame, group: str) -> DataFrame:
    """Edits in order with ``delta``: how far earlier edits of the group have moved the text (``start, end, new_length``)."""
    w = Window.partitionBy(group).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return edits.withColumn("delta", F.coalesce(F.sum(F.col("new_length") - (F.col("end") - F.col("start"))).over(w), F.lit(0)))


#: Sizes of cells for spans: the smallest, how much larger the next is, and how many there are.
CELL, LARGER, SIZES = 64, 8, 10


def smallest_enclosing(spans: DataFrame, blocks: DataFrame, group: str) -> DataFrame:
    """Each span with its smallest enclosing block of the same group (``start, end``; ties to the smaller start).

    A block is hashed to cells of the least size that isn't smaller than itself, so to two at most, however long it is; a span to the cell of its start in
    every size. The join is an equi-join on (group, size, cell), and only blocks near the span, on the block's own scale, meet it.
    """
    size = F.lit(SIZES - 1)
    for k in range(SIZES - 2, -1, -1):
        size = F.when(F.col("b_end") - F.col("b_start") <= CELL * LARGER ** k, F.lit(k)).otherwise(size)
    width = F.element_at(F.array(*[F.lit(CELL * LARGER ** k) for k in range(SIZES)]), F.col("size") + 1)
    b = blocks.select(group, F.col("start").alias("b_start"), F.col("end").alias("b_end")).withColumn("size", size)
    b = b.withColumn("cell", F.explode(F.sequence(F.floor(F.col("b_start") / width), F.floor(F.col("b_end") / width))))
    s = spans.withColumn("size", F.explode(F.sequence(F.lit(0), F.lit(SIZES - 1)))).withColumn("cell", F.floor(F.col("start") / width))
    met = s.join(b, [group, "size", "cell"]).where((F.col("b_start") <= F.col("start")) & (F.col("end") <= F.col("b_end")))
    best = met.groupBy(group, "start", "end").agg(F.min_by(F.struct("b_start", "b_end"), F.struct(F.col("b_end") - F.col("b_start"), "b_start")).alias("b"))
    return best.select(group, "start", "end", "b.b_start", "b.b_end")


def project_range(ranges: DataFrame, changes: DataFrame, group: str) -> DataFrame:
    """Ranges after edits, in one sorted pass over bounds and changes: moved by what ends at or before their bounds.

    ``changes``: start, end, new_length, not overlapping. Null where a change lies across a bound, or inserts inside the range: a
    reference that was changed in part isn't inferred.
    """
    whole = ranges.select(group, "start", "end").distinct()
    none = F.lit(None).cast("long")
    at = lambda df, place, kind, **more: df.select(group, F.col(place).cast("long").alias("at"), F.lit(kind).alias("kind"), *[more.get(c, none).alias(c) for c in ("start", "end", "moved", "upto", "inserted")])
    inserts = changes.where(F.col("start") == F.col("end"))
    # at one place: what ends there counts for both bounds, an insertion for a start only, what starts there for neither
    events = (
        at(changes, "end", 0, moved=(F.col("new_length") - (F.col("end") - F.col("start"))).cast("long"))
        .unionByName(at(whole, "end", 1, start=F.col("start").cast("long"), end=F.col("end").cast("long")))
        .unionByName(at(inserts, "start", 2, inserted=F.lit(1).cast("long")))
        .unionByName(at(whole, "start", 3, start=F.col("start").cast("long"), end=F.col("end").cast("long")))
        .unionByName(at(changes, "start", 4, upto=F.col("end").cast("long"))))
    w = Window.partitionBy(group).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, -1)
    passed = events.select(
        group, "at", "kind", "start", "end", F.coalesce(F.sum("moved").over(w), F.lit(0)).alias("delta"), F.coalesce(F.max("upto").over(w) > F.col("at"), F.lit(False)).alias("across"), F.coalesce(F.sum("inserted").over(w), F.lit(0)).alias("before"))
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    both = passed.where(F.col("kind").isin(1, 3)).groupBy(group, "start", "end").agg(
        of(3, "delta").alias("d_start"), of(1, "delta").alias("d_end"), F.bool_or("across").alias("across"), (of(1, "before") > of(3, "before")).alias("inserted"))
    fine = ~F.col("across") & ~F.col("inserted")
    moved = both.select(group, "start", "end", F.when(fine, F.col("start") + F.col("d_start")).alias("new_start"), F.when(fine, F.col("end") + F.col("d_end")).alias("new_end"))
    return ranges.join(moved, [group, "start", "end"]).select(*ranges.columns, "new_start", "new_end")


def set_difference_report(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """``key, side``: members of one set only (``missing`` from actual, ``unexpected`` in it)."""
    e, a = expected.select(key).distinct(), actual.select(key).distinct()
    return e.exceptAll(a).withColumn("side", F.lit("missing")).unionByName(a.exceptAll(e).withColumn("side", F.lit("unexpected")))


def corpus_digest(files: DataFrame) -> DataFrame:
    """One row: SHA-256 over the files' (path, digest) in path order.

    Files are digested in 65,536 hash buckets first, so no row holds the list of all files.
    """
    each = files.select("path", "sha256", F.substring(F.sha2("path", 256), 1, 4).alias("bucket"))
    by = each.groupBy("bucket").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda x: F.concat(x["path"], F.lit("\t"), x["sha256"])), "\n"), 256).alias("h"))
    return by.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda x: F.concat(x["bucket"], F.lit("\t"), x["h"])), "\n"), 256).alias("digest"))


def pack_units(rows: DataFrame, group: str, unit: str, size: str, most: int, most_rows: int) -> DataFrame:
    """``group, unit, size, bin``: rows of a unit stay together (pairs of before and after), units are packed in order."""
    units = rows.groupBy(group, unit).agg(F.sum(size).cast("long").alias(size))
    return pack(units, group, unit, size, most, most_rows)


def positions(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` plus ``place``, their number (from 1) in a global order: ranges are numbered apart and moved by the rows of the ranges before them."""
    ranged = settled(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    # one row a range
    before = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(F.broadcast(before.drop("__n")), "__part").withColumn("place", F.col("__before") + inside).drop("__part", "__before")


def fetch_order(items: DataFrame) -> DataFrame:
    """``id, place``: required first, then tagged, newest (largest) id first."""
    return positions(items.select("id", "required", "tagged"), F.col("required").desc(), F.col("tagged").desc(), F.col("id").desc()).select("id", "place")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that two runs don't share, with multiplicity: ``side`` first or second. None if a rerun repeats the first run."""
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("second")))
