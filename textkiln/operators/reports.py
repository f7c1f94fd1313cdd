"""Reports: fixed sets of counts, digests of a corpus, and one-file outputs written by the session."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.functions.text import body_hash
from textkiln.operators.resolution import corpus_digest


def counts_of(rows: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    """One row: how often each of ``names`` occurs, zero included, and ``other``."""
    c = F.col(column)
    return rows.agg(*[F.count_if(c == n).alias(n) for n in names], F.count_if(c.isNull() | ~c.isin(*names)).alias("other"))


def disposition_counts(rows: DataFrame) -> DataFrame:
    return counts_of(rows, "disposition", ("keep", "remove", "omit"))


def migration_counts(before: DataFrame, after: DataFrame, excluded: DataFrame) -> DataFrame:
    """One row of what a migration does to documents (``url, body, links`` (array)): kept as they are, rewritten, relinked, removed by policy or otherwise, added, and all."""
    a = before.select("url", F.sha2("body", 256).alias("a"), F.col("links").alias("al"))
    b = after.select("url", F.sha2("body", 256).alias("b"), F.col("links").alias("bl"))
    e = excluded.select("url").distinct().withColumn("gone", F.lit(True))
    j = a.join(b, "url", "full_outer").join(e, "url", "left")
    was, now = F.col("a").isNotNull(), F.col("b").isNotNull()
    same_links = F.array_sort("al").eqNullSafe(F.array_sort("bl"))
    return j.agg(
        F.count_if(was & now & (F.col("a") == F.col("b")) & same_links).alias("unchanged"), F.count_if(was & now & (F.col("a") != F.col("b"))).alias("rewritten"), F.count_if(was & now & (F.col("a") == F.col("b")) & ~same_links).alias("relinked"),
        F.count_if(was & ~now & F.col("gone").isNotNull()).alias("excluded"), F.count_if(was & ~now & F.col("gone").isNull()).alias("lost"), F.count_if(~was & now).alias("added"), F.count(F.lit(1)).alias("documents"))


def lineage_digest(documents: DataFrame, assets: DataFrame) -> DataFrame:
    """One row: a digest over bodies and assets, without metadata. ``documents``: path, body; ``assets``: path, sha256."""
    return corpus_digest(documents.select("path", body_hash(F.col("body")).alias("sha256")).unionByName(assets.select("path", "sha256")))


def safe_counts(rows: DataFrame, by: str, allowed: tuple[str, ...]) -> DataFrame:
    """``by, n`` with values that aren't allowed under ``withheld``, so that a report names no others."""
    value = F.when(F.col(by).isin(*allowed), F.col(by)).otherwise("withheld")
    return rows.groupBy(value.alias(by)).agg(F.count(F.lit(1)).alias("n"))


def route_report(previous: DataFrame, listed: DataFrame, responses: DataFrame) -> DataFrame:
    """``change, status, urls``: listed routes against those before (new, kept, gone) by what their response was."""
    j = previous.select("url").distinct().withColumn("p", F.lit(True)).join(listed.select("url").distinct().withColumn("l", F.lit(True)), "url", "full_outer").join(responses.groupBy("url").agg(F.max("status").alias("status")), "url", "left")
    change = F.when(F.col("p").isNull(), "new").when(F.col("l").isNull(), "gone").otherwise("kept")
    return j.groupBy(change.alias("change"), F.coalesce(F.col("status").cast("string"), F.lit("none")).alias("status")).agg(F.count(F.lit(1)).alias("urls"))


def capture_report(captures: DataFrame, final: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Counts by source and disposition with ``complete``, and the queue of captures still to review, by source and URL."""
    done = F.col("disposition").isin(*final)
    by = captures.groupBy("source").agg(F.count(F.lit(1)).alias("captures"), F.count_if(done).alias("final"), F.bool_and(F.coalesce(done, F.lit(False))).alias("complete"))
    return by, captures.where(~F.coalesce(done, F.lit(False))).select("source", "url", "disposition")


def article_hash(*columns: str) -> Column:
    """Digest of the named columns as a JSON object with sorted keys, nulls included."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def destination_errors(placements: DataFrame) -> DataFrame:
    """``source, destinations`` of media that several placements send to different destinations."""
    return placements.groupBy("source").agg(F.count_distinct("destination").alias("destinations")).where("destinations > 1")


def rgba_bytes(width: Column, height: Column, frames: Column) -> Column:
    """Bytes of a decoded image: four a pixel and frame."""
    return width.cast("long") * height.cast("long") * F.greatest(F.lit(1), frames.cast("long")) * 4


def written_text(spark: SparkSession, path: str, text: str) -> None:
    """One file with exactly this text, by the session's file system: written beside its place and renamed, so no reader sees a part of it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    draft = jvm.org.apache.hadoop.fs.Path(path + ".draft")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"can't move a file to {path}")


def write_report(spark: SparkSession, folder: str, name: str, value: dict, markdown: str) -> None:
    """``name.json`` (two blanks, sorted keys, final line feed) and ``name.md`` in a folder."""
    written_text(spark, f"{folder}/{name}.json", json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n")
    written_text(spark, f"{folder}/{name}.md", markdown)


def analysis_markdown(sources: list[dict], groups: dict[str, int]) -> str:
    """The analysis of a corpus as Markdown: totals by source, and numbers of repeated groups."""
    rows = "".join(f"| {r['source']} | {r['documents']} | {r['estimated_tokens']} |\n" for r in sorted(sources, key=lambda r: str(r["source"])))
    return "# Corpus analysis\n\n| Source | Documents | Estimated tokens |\n| --- | ---: | ---: |\n" + rows + "\n" + "".join(f"- {k.replace('_', ' ').capitalize()}: {v}\n" for k, v in sorted(groups.items()))
