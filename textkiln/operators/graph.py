"""Closures over link tables: reachability, alias chains, discovery by levels, incoming anchors.

Each round is one equi-join of the frontier with the edges and an anti-join with what is known; rounds
are written to the shared checkpoint folder, so plans stay short and lost executors repeat one round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.session import settled, unsettled


def reachable(edges: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node, depth`` from ``seeds`` (column ``node``) along ``src, dst``: least number of steps, as far as the edges lead or for ``rounds``.

    Every round writes its new nodes only; what is known is the union of the rounds. That union is shuffled, never broadcast: it would go
    through the driver again in every round. Edges are made once.
    """
    edges = settled(edges.select("src", "dst").where("src is not null and dst is not null").distinct())
    found = [settled(seeds.select("node").where("node is not null").distinct().withColumn("depth", F.lit(0)))]
    while rounds is None or len(found) <= rounds:
        # an anti-join would be pushed below the join with the edges, which would then be shuffled in every round
        known = reduce(DataFrame.unionByName, found).select("node", F.lit(True).alias("known"))
        nxt = settled(
            found[-1].join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
            .join(known.hint("merge"), "node", "left").where("known is null").select("node", F.lit(len(found)).alias("depth")))
        if nxt.isEmpty():
            unsettled(nxt)
            break
        found.append(nxt)
    unsettled(edges)
    return reduce(DataFrame.unionByName, found)


def closure_omitted(links: DataFrame, excluded: DataFrame, repaired: DataFrame) -> DataFrame:
    """Pages left out: the excluded, and pages that depend on one left out unless they were repaired.

    ``links``: src depends on dst; ``excluded`` and ``repaired``: node.
    """
    back = links.join(repaired.select(F.col("node").alias("src")), "src", "left_anti").select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return reachable(back, excluded)


def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """``path, target, hops, cycle, error``: the end of each alias chain, by doubling, so rounds are the log of the longest chain.
    A round reads and writes only paths whose chain goes on.

    A path that is or leads into a cycle has a null target, and so has one with several targets or that leads to such a path.
    """
    of = settled(aliases.groupBy("path").agg(F.min("target").alias("target"), F.max("target").alias("last")).select("path", "target", F.coalesce(F.col("target") != F.col("last"), F.lit(False)).alias("torn")))
    torn = of.where("torn").select("path")
    one = of.where("not torn").select("path", "target", F.lit(1).cast("long").alias("hops"))
    onward = one.select(F.col("path").alias("target"), F.lit(True).alias("onward"))
    jumps = settled(one.join(onward, "target", "left").select("path", "target", "hops", F.col("onward").isNotNull().alias("onward")))
    # a path whose jump ends is written once and only looked up from then on; the others jump on, and if none of them ends, they never will
    ended, open_, n = [jumps.where("not onward")], jumps.where("onward"), jumps.where("onward").count()
    while n:
        step = reduce(DataFrame.unionByName, [*ended, open_]).select(F.col("path").alias("target"), F.col("target").alias("t2"), F.col("hops").alias("h2"), F.col("onward").alias("o2"))
        nxt = settled(open_.select("path", "target", "hops").join(step, "target").select("path", F.col("t2").alias("target"), (F.col("hops") + F.col("h2")).alias("hops"), F.col("o2").alias("onward")))
        left = nxt.where("onward").count()
        if left == n:
            unsettled(nxt)
            break
        ended, open_, n = [*ended, nxt.where("not onward")], nxt.where("onward"), left
    ends = torn.select(F.col("path").alias("target"), F.lit(True).alias("torn"))
    none = lambda kind: F.lit(None).cast(kind)
    error = F.when(F.col("torn"), "leads to several targets")
    out = reduce(DataFrame.unionByName, ended).join(ends, "target", "left").select("path", F.when(error.isNull(), F.col("target")).alias("target"), F.when(error.isNull(), F.col("hops")).alias("hops"), F.lit(False).alias("cycle"), error.alias("error"))
    out = out.unionByName(open_.select("path", none(aliases.schema["target"].dataType).alias("target"), none("long").alias("hops"), F.lit(True).alias("cycle"), F.lit("cycle").alias("error")))
    several = torn.select("path", F.lit(None).cast(aliases.schema["target"].dataType).alias("target"), F.lit(None).cast("long").alias("hops"), F.lit(False).alias("cycle"), F.lit("several targets").alias("error"))
    return out.unionByName(several)


def validate_aliases(aliases: DataFrame, documents: DataFrame) -> DataFrame:
    """``path, error`` of aliases that collide with a document, lack their target, or name themselves."""
    d = documents.select(F.col("path").alias("doc"))
    j = aliases.join(d.withColumn("taken", F.lit(True)), F.col("path") == F.col("doc"), "left").drop("doc")
    j = j.join(d.withColumn("there", F.lit(True)), F.col("target") == F.col("doc"), "left").drop("doc")
    n = aliases.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    error = F.when(F.col("path") == F.col("target"), "self").when(F.col("taken"), "collision").when(F.col("n") > 1, "duplicate").when(F.col("there").isNull(), "missing target")
    return j.join(n, "path").select("path", error.alias("error")).where("error is not null")


def broken_anchors(links: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """``document, anchor`` that an incoming link needs, that was there before and is gone after.

    ``links``: target, fragment; ``before`` and ``after``: document, anchor.
    """
    needed = links.where("fragment != ''").select(F.col("target").alias("document"), F.col("fragment").alias("anchor")).distinct()
    return needed.join(before, ["document", "anchor"], "left_semi").join(after, ["document", "anchor"], "left_anti")
