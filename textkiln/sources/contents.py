"""A store of contents by digest, written by tasks through a Python data source: each content is one file, whatever its names.

``df.write.format("contents").mode("append").save(root)`` takes ``name, content``. A task writes each of its distinct contents aside, checks
what it wrote, and moves it to ``objects/<two digits>/<sha256>``; the move is atomic and equal contents have equal bytes, so several
tasks, attempts and jobs may move the same one. Its names go to a file aside, and the task's commit message says where, with counts;
only the job's commit puts the names of successful attempts in place, by one rename of their folder. A failed job leaves contents
without a name at most, which ``unnamed`` finds. The driver gets one message a task, and no content.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: A task passes on so many bytes of contents at once.
BATCH_BYTES = 8 << 20


def local(root: str) -> Path:
    """A folder that driver and executors share, mounted at the same path."""
    if ":" in root and not root.startswith("file:"):
        raise ValueError(f"a mounted folder is asked for, not {root}")
    return Path("/" + root.removeprefix("file:").lstrip("/"))


@dataclass
class Moved(WriterCommitMessage):
    """One attempt's part: its file of names, and how many names and new contents it has."""

    names: str
    rows: int
    stored: int


def _put(root: Path, aside: Path, data: bytes) -> tuple[str, bool]:
    """Stores one content; its digest, and whether this call moved it."""
    digest = hashlib.sha256(data).hexdigest()
    place = root / "objects" / digest[:2] / digest
    if place.exists():
        return digest, False
    place.parent.mkdir(parents=True, exist_ok=True)
    staged = aside / f"{digest}.{uuid.uuid4().hex}"
    with open(staged, "wb") as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    if hashlib.sha256(staged.read_bytes()).hexdigest() != digest:
        raise OSError(f"{staged} doesn't hold what was written")
    os.replace(staged, place)
    return digest, True


class _Writer(DataSourceWriter):
    def __init__(self, root: str, overwrite: bool):
        if overwrite:
            raise ValueError("contents are only added to a store")
        self.root, self.job = local(root), uuid.uuid4().hex

    def write(self, rows: Iterator) -> Moved:
        aside = self.root / "staging" / self.job
        aside.mkdir(parents=True, exist_ok=True)
        attempt, n, stored = aside / f"{uuid.uuid4().hex}.names", 0, 0
        with open(attempt, "w") as names:
            for row in rows:
                if row["content"] is None:
                    continue
                digest, new = _put(self.root, aside, bytes(row["content"]))
                names.write(json.dumps({"name": row["name"], "sha256": digest, "size": len(row["content"])}) + "\n")
                n, stored = n + 1, stored + new
            names.flush()
            os.fsync(names.fileno())
        return Moved(str(attempt), n, stored)

    def commit(self, messages: list) -> None:
        aside = self.root / "staging" / self.job
        done = aside / "names"
        done.mkdir(parents=True, exist_ok=True)
        for m in messages:
            if m is not None:
                # attempts that no message speaks of stay behind
                os.replace(m.names, done / (Path(m.names).stem + ".json"))
        (self.root / "names").mkdir(parents=True, exist_ok=True)
        os.replace(done, self.root / "names" / f"job={self.job}")
        shutil.rmtree(aside, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.root / "staging" / self.job, ignore_errors=True)


@dataclass
class Folder(InputPartition):
    """The contents whose digests begin with two digits."""

    digits: str


class _Reader(DataSourceReader):
    """A task lists and reads one folder of the store, so the driver holds no list of files."""

    def __init__(self, root: str, with_content: bool):
        self.root, self.with_content = local(root), with_content

    def partitions(self) -> list[Folder]:
        return [Folder(f"{k:02x}") for k in range(256)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        folder = self.root / "objects" / partition.digits
        schema = pa.schema([("sha256", pa.string()), ("content", pa.binary())])
        digests, held, size = [], [], 0
        for f in os.scandir(folder) if folder.is_dir() else ():
            digests.append(f.name)
            held.append(Path(f.path).read_bytes() if self.with_content else None)
            size += len(held[-1] or b"")
            if size >= BATCH_BYTES or len(digests) >= 1_000:
                yield pa.record_batch([digests, held], schema)
                digests, held, size = [], [], 0
        if digests:
            yield pa.record_batch([digests, held], schema)


class ContentStore(DataSource):
    """Writes ``name, content``; reads ``sha256, content`` of every file (option ``content`` false: digests only)."""

    @classmethod
    def name(cls) -> str:
        return "contents"

    def schema(self) -> str:
        return "sha256 string, content binary"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("content", "true") == "true")

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def store(files: DataFrame, root: str) -> None:
    """Adds ``name, content`` (string or binary; null contents are left out) to the store at ``root``."""
    files.sparkSession.dataSource.register(ContentStore)
    files.select("name", F.col("content").cast("binary").alias("content")).write.format("contents").mode("append").save(root)


def names(spark: SparkSession, root: str) -> DataFrame:
    """``name, sha256, size`` of all committed jobs."""
    return spark.read.schema("name string, sha256 string, size long").json(f"{root}/names/job=*")


def _held(spark: SparkSession, root: str, content: bool) -> DataFrame:
    spark.dataSource.register(ContentStore)
    return spark.read.format("contents").option("content", str(content).lower()).load(root)


def contents(spark: SparkSession, root: str) -> DataFrame:
    """``sha256, content, intact``: every file of the store, with its digest by name, and whether it holds what that says."""
    return _held(spark, root, True).withColumn("intact", F.sha2("content", 256) == F.col("sha256"))


def unnamed(spark: SparkSession, root: str) -> DataFrame:
    """``sha256`` of contents that no committed name has: left by failed jobs."""
    return _held(spark, root, False).select("sha256").join(names(spark, root), "sha256", "left_anti")
