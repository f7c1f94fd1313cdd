"""Running totals over a globally ordered table, without a task that sees all rows.

Rows are range-partitioned by a unique order, so equal or hot keys spread over partitions; the
per-partition totals (one row for each partition and group) give offsets, and a window inside each
partition gives the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.tables import written


def running_totals(rows: DataFrame, order: list[str], size: str, group: str | None = None, label: str = "prefix") -> DataFrame:
    """``rows`` plus ``before`` (sum of ``size`` in rows ordered earlier), ``index`` (their number) and ``part``.

    ``group``: totals restart in each group; it must lead ``order`` and hold no nulls. ``rows`` should
    be narrow and already written, since choosing the ranges reads it once more.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), label)
    keys = ["part", *([group] if group else [])]
    over = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*keys).agg(F.sum(size).alias("__s"), F.count(F.lit(1)).alias("__n"))
        .select(*keys, F.coalesce(F.sum("__s").over(over), F.lit(0)).alias("__s0"), F.coalesce(F.sum("__n").over(over), F.lit(0)).alias("__n0"))
    )
    inside = Window.partitionBy(*keys).orderBy(*[c for c in order if c != group])
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(offsets, keys)
        .withColumn("before", F.col("__s0") + F.coalesce(F.sum(size).over(upto), F.lit(0)))
        .withColumn("index", F.col("__n0") + F.row_number().over(inside) - 1)
        .drop("__s0", "__n0")
    )
