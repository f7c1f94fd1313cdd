"""Written intermediate tables in the cluster's shared folder.

``written`` stores a frame as Parquet below ``spark.checkpoint.dir`` and reads it back, which cuts
the lineage: a lost executor costs a re-read, never a recomputation of the stages before it. Tables go
when ``dropped`` is called, and at the latest when the application ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from textkiln.llm.arrow import SETTINGS as ARROW

#: While a table is written: its job's shuffle files go afterwards, since nothing reads them again.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.shuffleDependency.fileCleanup.enabled": "true",
}


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where the setting is unset a local session gets a temporary folder; on a cluster that is an error."""
    key = "spark.checkpoint.dir"
    path = spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {key} to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="textkiln-")
        spark.conf.set(key, path)
    return path.rstrip("/")


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    held = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder, in small Arrow batches, and return a frame that reads the files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textkiln/{label}-{uuid.uuid4().hex}"
    with _set(spark, {**_SETTINGS, **ARROW}):
        df.write.parquet(path)
    files, p = _folder(spark, path)
    files.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._textkiln_path = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Remove the files behind frames made by ``written`` once nothing reads them any more."""
    for df in frames:
        if path := getattr(df, "_textkiln_path", None):
            files, p = _folder(df.sparkSession, path)
            files.delete(p, True)
            files.cancelDeleteOnExit(p)
