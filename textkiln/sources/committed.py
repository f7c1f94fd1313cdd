"""Tables that change by whole commits: buckets are written aside, read back and checked, then named by one rename.

``data/<run>/bucket=k`` holds Parquet files that nothing changes later. ``manifests/<n>.json`` is commit n: which run holds
each bucket, with its rows and a checksum of them, and facts that the writer states. A commit writes the buckets it touches,
reads them back, compares every row with the digest it was written with and their number with what the job counted, and only then
renames the manifest to its number, which fails if another writer has taken it. Readers follow the newest manifest,
so a run that ends at any step leaves the old state or the new one; what no manifest names goes with ``vacuum``.

The driver holds one row for each bucket. Rows are dealt by a hash of ``key``, so a bucket is as even as its keys.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_DIGEST = "row_sha256"


class CommitFailed(RuntimeError):
    """What was read back isn't what was written."""


class CommitConflict(RuntimeError):
    """Another writer has committed since this one began."""


def row_digest(columns: Iterable[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


class CommittedTable:
    """A table below ``root`` in a file system that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, key: str = "path", buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    def bucket_of(self, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).cast("int")

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        root = self._path("manifests")
        return root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of complete commits."""
        files, folder = self._files(), self._path("manifests")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        return max(self.versions(), default=0)

    def _bytes(self, version: int) -> bytes:
        rows = self.spark.read.format("binaryFile").load(f"{self.root}/manifests/{version}.json").select("content").collect()
        return bytes(rows[0]["content"])

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        return json.loads(self._bytes(version)) if version else {"version": 0, "buckets": {}, "facts": {}, "schema": None}

    def digest(self, version: int | None = None) -> str:
        """SHA-256 of a manifest: it stands for the whole state."""
        return hashlib.sha256(self._bytes(self.version() if version is None else version)).hexdigest()

    def read(self, buckets: Iterable[int] | None = None, version: int | None = None) -> DataFrame | None:
        """Rows of some buckets (all, if None) with ``bucket``; None where nothing was committed yet."""
        m = self.manifest(version)
        if m["schema"] is None:
            return None
        wanted = set(m["buckets"]) if buckets is None else {str(b) for b in buckets}
        paths = [f"{self.root}/data/{v['run']}/bucket={k}" for k, v in sorted(m["buckets"].items()) if k in wanted]
        schema = self.spark.createDataFrame([], m["schema"]).schema
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("bucket", F.lit(None).cast("int")).drop(_DIGEST)
        return self.spark.read.schema(schema).parquet(*paths).drop(_DIGEST).withColumn("bucket", self.bucket_of())

    def _written(self, rows: DataFrame, run: str) -> int:
        """Phase one: files, each row with its digest; how many rows went in."""
        seen = Observation(run)
        made = rows.withColumn(_DIGEST, row_digest(rows.columns)).withColumn("bucket", self.bucket_of()).observe(seen, F.count(F.lit(1)).alias("n"))
        made.repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.root}/data/{run}")
        return seen.get["n"]

    def _checked(self, rows: DataFrame, run: str, n: int) -> dict[str, dict]:
        """Phase two: what the files say, bucket by bucket."""
        schema = rows.withColumn(_DIGEST, F.lit("")).schema
        back = self.spark.read.schema(schema).parquet(f"{self.root}/data/{run}/bucket=*") if n else self.spark.createDataFrame([], schema)
        names = [c for c in rows.columns]
        each = back.groupBy(self.bucket_of().alias("bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(_DIGEST).cast("decimal(38,0)")).cast("string").alias("checksum"), F.count_if(F.col(_DIGEST) != row_digest(names)).alias("wrong")).collect()
        if sum(r["n"] for r in each) != n or any(r["wrong"] for r in each):
            raise CommitFailed(f"{self.root}: {n} rows written, {sum(r['n'] for r in each)} read back, {sum(r['wrong'] for r in each)} of them changed")
        return {str(r["bucket"]): {"run": run, "rows": r["n"], "checksum": r["checksum"]} for r in each}

    def _named(self, manifest: dict) -> None:
        """Phase three: the manifest under its number, unless that is taken."""
        jvm, number = self.spark.sparkContext._jvm, manifest["version"]
        aside, place = self._path(f"manifests/.{uuid.uuid4().hex}"), self._path(f"manifests/{number}.json")
        files = self._files()
        files.mkdirs(self._path("manifests"))
        out = files.create(aside, False)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True, indent=1).encode()))
        finally:
            out.close()
        if files.exists(place):
            files.delete(aside, False)
            raise CommitConflict(f"{self.root}: commit {number} is taken")
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri() if aside.toUri().getScheme() else jvm.java.net.URI("file:///"), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(aside, place, options)
        except Exception as e:
            files.delete(aside, False)
            if "FileAlreadyExists" in str(e):
                raise CommitConflict(f"{self.root}: commit {number} is taken") from None
            raise

    def commit(self, rows: DataFrame, touched: Iterable[int] | None = None, facts: dict | None = None, base: int | None = None) -> int:
        """Replaces the buckets ``touched`` (all, if None) by ``rows``, which must lie in them; the new commit's number.

        ``base``: the commit that ``rows`` were made from (the newest, if None).
        """
        base = self.version() if base is None else base
        old = self.manifest(base)
        rows = rows.drop("bucket", _DIGEST)
        run = uuid.uuid4().hex
        made = self._checked(rows, run, self._written(rows, run))
        kept = {} if touched is None else {k: v for k, v in old["buckets"].items() if int(k) not in set(touched)}
        if clash := kept.keys() & made.keys():
            raise ValueError(f"rows of buckets that weren't to change: {sorted(clash)[:5]}")
        schema = rows.withColumn(_DIGEST, F.lit("")).schema.simpleString()
        self._named({"version": base + 1, "buckets": kept | made, "facts": facts or {}, "schema": schema})
        return base + 1

    def verify(self, digest: str | None = None, version: int | None = None) -> DataFrame:
        """``bucket, error`` of a commit whose files no longer hold what its manifest states; the manifest itself by ``digest``."""
        version = self.version() if version is None else version
        if digest is not None and self.digest(version) != digest:
            raise ValueError(f"{self.root}: manifest {version} has another digest")
        m = self.manifest(version)
        stated = self.spark.createDataFrame([(int(k), v["rows"], v["checksum"]) for k, v in m["buckets"].items()], "bucket int, rows long, checksum string")
        paths = [f"{self.root}/data/{v['run']}/bucket={k}" for k, v in m["buckets"].items()]
        schema = self.spark.createDataFrame([], m["schema"]).schema
        # folders that are gone count as empty ones
        there = [p for p in paths if self._files().exists(self._path(p[len(self.root) + 1:]))]
        back = self.spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*there) if there else self.spark.createDataFrame([], schema)
        names = [c for c in schema.names if c != _DIGEST]
        found = back.groupBy(self.bucket_of().alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(_DIGEST).cast("decimal(38,0)")).cast("string").alias("sum"), F.count_if(F.col(_DIGEST) != row_digest(names)).alias("wrong"))
        error = F.when(F.coalesce("n", F.lit(0)) != F.col("rows"), "rows missing or added").when((F.col("sum") != F.col("checksum")) | (F.col("wrong") > 0), "rows changed")
        return stated.join(found, "bucket", "left").select("bucket", error.alias("error")).where("error is not null")

    def vacuum(self, keep: int = 1) -> int:
        """Removes manifests but the newest ``keep``, and runs that none of those names; how many runs went. Not while a commit is under way."""
        files, numbers = self._files(), self.versions()
        for n in numbers[:-keep]:
            files.delete(self._path(f"manifests/{n}.json"), False)
        named = {v["run"] for n in numbers[-keep:] for v in self.manifest(n)["buckets"].values()}
        data = self._path("data")
        runs = [s.getPath() for s in files.listStatus(data)] if files.exists(data) else []
        gone = [p for p in runs if p.getName() not in named]
        for p in gone:
            files.delete(p, True)
        return len(gone)


def seal(table: CommittedTable, rows: DataFrame, final: Column, **facts: object) -> str:
    """Commits ``rows`` as a sealed input: facts with ``review_complete`` (``final`` holds for every row); the seal's digest."""
    table.commit(rows)
    open_rows = table.read().where(~F.coalesce(final, F.lit(False))).count()
    table.commit(table.read(), facts={**facts, "review_complete": open_rows == 0, "open": open_rows})
    return table.digest()
