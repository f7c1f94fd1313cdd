"""Hash trees over the files of a snapshot, so that two snapshots are compared from their roots and equal ranges are never read.

A file falls in the range named by the first ``digits`` hexadecimal digits of the SHA-256 of its path; a range's digest is that of its sorted
paths and file digests, an inner node's that of its up to sixteen children. Ranges are as even as a hash, and ``digits`` keeps them at a few
hundred files, so a range is gathered in one task whatever the snapshot's size. Nodes are a table by level, files a table by
the first one or two digits: a comparison reads a level's children of differing nodes, then the files of differing ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.session import settled, unsettled

#: Files of a range on average, at most.
FULL = 256


def digits_for(files: int) -> int:
    """Digits that leave ``FULL`` files to a range; two at least."""
    digits = 2
    while files > FULL * 16 ** digits:
        digits += 1
    return digits


@dataclass(frozen=True)
class HashTree:
    """A written tree: ``nodes`` (level, prefix, digest) and ``files`` (path, sha256, leaf) below ``root``."""

    spark: SparkSession
    root: str
    digits: int

    @property
    def folders(self) -> int:
        """Digits of a folder of files: 16 folders for a small tree, 256 for others."""
        return 1 if self.digits == 2 else 2

    def nodes(self, level: int) -> DataFrame:
        return self.spark.read.schema("prefix string, digest string").parquet(f"{self.root}/nodes/level={level}")

    def files(self, parts: list[str]) -> DataFrame:
        """Files of ranges in the folders ``parts``."""
        schema = "path string, sha256 string, leaf string"
        have = {s.getPath().getName() for s in self._listed("files")}
        paths = [f"{self.root}/files/part={p}" for p in parts if f"part={p}" in have]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _listed(self, name: str) -> list:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return list(p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p))

    def digest(self) -> str | None:
        """The root's digest; None for no files."""
        top = self.nodes(0).first()
        return top["digest"] if top else None


def grown(files: DataFrame, root: str, digits: int | None = None) -> HashTree:
    """Writes the tree of ``path, sha256`` (paths unique) below ``root``, which must be new."""
    spark = files.sparkSession
    digits = digits or digits_for(files.count())
    tree = HashTree(spark, root.rstrip("/"), digits)
    leaf = F.substring(F.sha2("path", 256), 1, digits)
    dealt = files.select("path", "sha256", leaf.alias("leaf")).withColumn("part", F.substring("leaf", 1, tree.folders))
    dealt.repartition("part").sortWithinPartitions("part", "leaf", "path").write.partitionBy("part").parquet(f"{tree.root}/files")
    written = spark.read.schema("path string, sha256 string, leaf string, part string").parquet(f"{tree.root}/files")
    line = F.concat("path", F.lit("\0"), F.coalesce("sha256", F.lit("")), F.lit("\n"))
    nodes = written.groupBy(F.col("leaf").alias("prefix")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ""), 256).alias("digest"))
    nodes.write.parquet(f"{tree.root}/nodes/level={digits}")
    for level in range(digits - 1, -1, -1):
        child = F.concat("prefix", F.lit(":"), "digest", F.lit("\n"))
        up = tree.nodes(level + 1).groupBy(F.substring("prefix", 1, level).alias("up")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(child)), ""), 256).alias("digest"))
        up.select(F.col("up").alias("prefix"), "digest").write.parquet(f"{tree.root}/nodes/level={level}")
    return tree


def differing_ranges(a: HashTree, b: HashTree) -> DataFrame:
    """``prefix`` of ranges that differ, found from the roots down."""
    if a.digits != b.digits:
        raise ValueError("trees of different depth")
    differ = None
    for level in range(a.digits + 1):
        x, y = a.nodes(level), b.nodes(level)
        if differ is not None:
            up = F.substring("prefix", 1, level - 1)
            x, y = (t.withColumn("up", up).join(differ.select(F.col("prefix").alias("up")), "up", "left_semi").drop("up") for t in (x, y))
        both = x.join(y.withColumnRenamed("digest", "other"), "prefix", "full").where(~F.col("digest").eqNullSafe(F.col("other"))).select("prefix")
        before, differ = differ, settled(both)
        if before is not None:
            unsettled(before)
        if differ.isEmpty():
            break
    return differ


def differences(a: HashTree, b: HashTree) -> DataFrame:
    """``path, change`` from ``a`` to ``b``: added, removed, changed."""
    ranges = differing_ranges(a, b)
    parts = sorted(r[0] for r in ranges.select(F.substring("prefix", 1, a.folders)).distinct().collect())  # 256 at most
    x, y = (t.files(parts).join(ranges.select(F.col("prefix").alias("leaf")), "leaf", "left_semi").drop("leaf") for t in (a, b))
    both = x.withColumn("here", F.lit(True)).join(y.select("path", F.col("sha256").alias("other"), F.lit(True).alias("there")), "path", "full")
    change = F.when(F.col("here").isNull(), "added").when(F.col("there").isNull(), "removed").when(~F.col("sha256").eqNullSafe(F.col("other")), "changed")
    return both.select("path", change.alias("change")).where("change is not null")


def chosen_files(sources: DataFrame, choices: DataFrame) -> DataFrame:
    """``path, sha256`` that a combined snapshot must hold: of each path the file of its chosen source. ``sources``: source, path, sha256; ``choices``: path, source."""
    return choices.select("path", "source").distinct().join(sources, ["path", "source"]).select("path", "sha256")


def verify_snapshot(expected: HashTree, actual: HashTree, receipt: str | None = None) -> DataFrame:
    """``path, error`` of a snapshot against what it must hold, and a row without path if it isn't the one that ``receipt`` (a root's digest) names."""
    error = F.when(F.col("change") == "added", "unexpected").when(F.col("change") == "removed", "missing").otherwise("changed")
    out = differences(expected, actual).select("path", error.alias("error"))
    if receipt is not None and actual.digest() != receipt:
        out = out.unionByName(actual.spark.createDataFrame([(None, "receipt names another snapshot")], "path string, error string"))
    return out
