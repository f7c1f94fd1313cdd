"""State as a stream: page events folded into one row a page, with state kept for each key.

Events may come in any order over any number of batches, and the newest rows equal the fold of all events in the order of their time. The
state of a page is its counts, its last success, and the events after that success, which a success that is still to come may
fall between; it lies in RocksDB. Results go to a folder by batch number, so a batch that is replayed after a failure
overwrites what it wrote, and the newest row of a page is that of its highest batch.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "page string, status string, attempts int, failures int, terminals int, last_success string"
_ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def read_events(spark: SparkSession, folder: str, schema, name: str = "*.parquet", files: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream, so many a batch; the folder may still be empty."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", files).parquet(folder)


class PageFold(StatefulProcessor):
    """Counts of a page, its last success, and the events after it, of which ``held`` are kept: each call of the state is a message, so none is asked for nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "attempts int, at string, event_id long, held int")
        self.after = handle.getListState("after", "at string, event_id long, gone boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        attempts, *ok, held = self.known.get() or (0, None, None, 0)
        ok = tuple(ok) if ok[1] is not None else None
        before, new = ok, []
        for r in rows:
            attempts += 1
            place = (r["at"], r["event_id"])
            if r["kind"] == "success":
                ok = place if ok is None else max(ok, place)
            elif ok is None or place > ok:
                new.append((*place, r["kind"] == "gone"))
        new = [e for e in new if ok is None or e[:2] > ok]
        old = [tuple(e) for e in self.after.get()] if held else []
        if ok != before:
            old = [e for e in old if e[:2] > ok]
            if old or new:
                self.after.put(old + new)
            elif held:
                self.after.clear()
        elif new:
            self.after.appendList(new)
        events = old + new
        self.known.update((attempts, *(ok or (None, None)), len(events)))
        other = max((e[:2] for e in events if not e[2]), default=None)
        terminals = sum(e[2] and (other is None or e[:2] > other) for e in events)
        gone = bool(events) and max(events, key=lambda e: e[:2])[2]
        status = "success" if not events else "confirmed_removal" if gone and terminals >= 2 else "removal_candidate" if gone else "carried_forward" if ok else "failed"
        yield Row(page=key[0], status=status, attempts=attempts, failures=len(events), terminals=terminals, last_success=ok[0] if ok else None)


def page_states(events: DataFrame) -> DataFrame:
    """Stream of ``page, kind, at, event_id`` -> the page's newest state after each batch."""
    return events.groupBy("page").transformWithState(statefulProcessor=PageFold(), outputStructType=OUTPUT, outputMode="Update", timeMode="None")


def folded(events: DataFrame) -> DataFrame:
    """The same for a batch, by counting what came after the last success and the last event that wasn't terminal; no page's events are gathered."""
    place = F.struct("at", "event_id")
    page = Window.partitionBy("page")
    last = lambda when: F.max(F.when(when, place)).over(page)
    ok, gone = F.col("kind") == "success", F.col("kind") == "gone"
    after = lambda mark: F.col(mark).isNull() | (place > F.col(mark))
    marked = events.withColumn("ok", last(ok)).withColumn("other", last(~gone))
    each = marked.groupBy("page").agg(
        F.count(F.lit(1)).cast("int").alias("attempts"), F.count_if(after("ok")).cast("int").alias("failures"), F.count_if(after("other")).cast("int").alias("terminals"),
        F.max_by("kind", place).alias("kind"), F.max(F.when(ok, F.col("at"))).alias("last_success"))
    status = F.when(ok, "success").when(gone & (F.col("terminals") >= 2), "confirmed_removal").when(gone, "removal_candidate").when(F.col("last_success").isNotNull(), "carried_forward").otherwise("failed")
    return each.select("page", status.alias("status"), "attempts", "failures", "terminals", "last_success")


def windowed_counts(events: DataFrame, ts: str = "ts", watermark: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Events by kind and window; late rows past the watermark are dropped in a stream."""
    return events.withWatermark(ts, watermark).groupBy(F.window(ts, width).alias("w"), "kind").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "kind", "n")


def upsert(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Drains what is there into ``folder``, a folder for each batch; taken up where ``checkpoint`` left off."""
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    spark = stream.sparkSession
    held = {k: spark.conf.get(k, None) for k in _ROCKS}
    for k, v in _ROCKS.items():
        spark.conf.set(k, v)
    try:
        query = stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            query.stop()
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def newest(spark: SparkSession, folder: str, key: str = "page", schema: str = OUTPUT) -> DataFrame:
    """The row of each key's highest batch."""
    rows = spark.read.schema(f"{schema}, batch long").parquet(folder)
    names = [c for c in rows.columns if c != "batch"]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), "batch").alias("r")).select("r.*")


def compact(spark: SparkSession, folder: str, into: str) -> None:
    """Writes the newest rows as batch -1 of another folder, which later batches may follow."""
    newest(spark, folder).write.mode("overwrite").parquet(f"{into}/batch=-1")
