"""Session helpers: settings that the plans assume, tables in the shared folder, and the package for Python workers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset a local session gets a temporary one; on a cluster that is an error."""
    key = "spark.checkpoint.dir"
    root = spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {key} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="textkiln-")
        spark.conf.set(key, root)
    return root.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back; the files go when the application ends, or by ``unsettled``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rounds/{uuid.uuid4().hex}"
    df.write.parquet(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_path = path
    return out


def forgotten(spark: SparkSession, path: str) -> None:
    """Marks a folder that goes when the application ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def unsettled(*frames: DataFrame) -> None:
    """Removes what ``settled`` wrote, once nothing reads it any more."""
    for df in frames:
        if path := getattr(df, "_settled_path", None):
            p = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            files = p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
            files.delete(p, True)
            files.cancelDeleteOnExit(p)


def session(name: str = "textkiln", **settings: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; other settings by keyword, dots written as two underscores."""
    b = SparkSession.builder.appName(name)
    for k, v in {
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true", **{k.replace("__", "."): v for k, v in settings.items()},
    }.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of the session, once; executors needn't have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="textkiln-")) / "textkiln.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
