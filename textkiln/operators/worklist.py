"""Worklists that a later session takes up: rounds of expansion, each a written table that counts once it is complete.

A round holds what its frontier led to: places to expand (``kind`` index) and things found (item). A place that is already known is a loop: it is
recorded and not expanded again, so an index that lists itself, or pages that turn in a circle, end. A round that was being
written when its session died has no mark of completion and is made again from the same frontier, so the rounds that follow are the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "url string, parent string, kind string, loop boolean"


class Worklist:
    """Rounds below ``root``, which sessions share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, name: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def rounds(self) -> int:
        """Complete rounds; the seeds are the first."""
        n = 0
        while self._exists(f"round={n}/_SUCCESS"):
            n += 1
        return n

    def round(self, n: int) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(f"{self.root}/round={n}")

    def known(self, upto: int) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.root}/round={k}" for k in range(upto)])

    def _write(self, rows: DataFrame, n: int) -> None:
        rows.select("url", "parent", "kind", "loop").write.mode("overwrite").parquet(f"{self.root}/round={n}")

    def step(self, seeds: DataFrame, expand: Callable[[DataFrame], DataFrame]) -> bool:
        """One round more; False if there was nothing to expand. ``seeds``: url; ``expand`` gives ``parent, url, kind`` of places (url)."""
        n = self.rounds()
        if not n:
            self._write(seeds.select("url", F.lit(None).cast("string").alias("parent"), F.lit("index").alias("kind"), F.lit(False).alias("loop")).where("url is not null").distinct(), 0)
            return True
        frontier = self.round(n - 1).where("kind = 'index' and not loop").select("url").distinct()
        if frontier.isEmpty():
            return False
        led = expand(frontier).select("url", "parent", "kind").where("url is not null").distinct()
        seen = self.known(n).where("not loop").select("url", "kind").distinct().withColumn("seen", F.lit(True))
        # of several parents in a round the first is the way to a place, the others lead back to it
        nth = F.row_number().over(Window.partitionBy("url", "kind").orderBy("parent"))
        new = led.join(seen, ["url", "kind"], "left").withColumn("nth", nth)
        self._write(new.withColumn("loop", (F.coalesce("seen", F.lit(False)) | (F.col("nth") > 1))), n)
        return True

    def drain(self, seeds: DataFrame, expand: Callable[[DataFrame], DataFrame], most: int | None = None) -> DataFrame:
        """Rounds until nothing is left (or ``most`` of them), then all rows so far."""
        done = 0
        while (most is None or done < most) and self.step(seeds, expand):
            done += 1
        return self.known(self.rounds())


def sitemap_entries(maps: DataFrame, url: str = "url", xml: str = "xml") -> DataFrame:
    """``parent, url, kind``: what each sitemap lists: further maps of an index, or pages."""
    def locations(tag: str) -> Column:
        entries = F.regexp_extract_all(xml, F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))
        return F.transform(entries, lambda e: F.replace(F.regexp_extract(e, r"(?s)<loc>\s*(.*?)\s*</loc>", 1), F.lit("&amp;"), F.lit("&")))

    listed = F.concat(F.transform(locations("sitemap"), lambda u: F.struct(u.alias("url"), F.lit("index").alias("kind"))), F.transform(locations("url"), lambda u: F.struct(u.alias("url"), F.lit("item").alias("kind"))))
    return maps.select(F.col(url).alias("parent"), F.explode(listed).alias("e")).select("parent", "e.url", "e.kind").where("url != ''")


def before_loops(pages: DataFrame, listing: str, page: str, digest: str) -> DataFrame:
    """``pages`` of each listing up to the first whose content (``digest``) an earlier page had, that one and later ones left out."""
    first = F.min(page).over(Window.partitionBy(listing, digest))
    marked = pages.withColumn("__again", F.when(F.col(page) > first, F.col(page)))
    stop = marked.groupBy(listing).agg(F.min("__again").alias("__stop"))
    return marked.join(stop, listing).where(F.col("__stop").isNull() | (F.col(page) < F.col("__stop"))).drop("__again", "__stop")
