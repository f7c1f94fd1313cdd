"""Small record batches, so that the JVM and a worker hold few texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of a batch between the JVM and a Python worker; set, and put back, while a table is written.
SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_DEFAULT = (None, "67108864b", "64m", "67108864")


def bounded(df: DataFrame) -> DataFrame:
    """``df`` of a session whose batches are as small, unless it has chosen a size.

    A lazy result over texts is made when its reader asks, so its session keeps the setting: a plan can't carry it.
    """
    conf = df.sparkSession.conf
    for k, v in SETTINGS.items():
        if conf.get(k, None) in _DEFAULT:
            conf.set(k, v)
    return df


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in slices (views, not copies) of at most ``rows``."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
