"""The incremental jobs as Structured Streaming: each URL once, upserts in batches, state per source, daily counts."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from guildbook.operators.joins import upsert


def unique_urls(stream: DataFrame, url: str = "url", ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Each url once within the delay; the state holds as many urls as come in that time."""
    return stream.withColumn("url_hash", F.sha2(F.col(url), 256)).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["url_hash"])


def daily_counts(stream: DataFrame, key: str, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Requests per key and day; a day is final when the watermark has passed it."""
    counted = stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w"), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("day"), key, "n")


BUCKETS, KEEP = 64, 3


def _files(spark, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def _versions(spark, folder: str) -> list[int]:
    """The versions of a table that have a whole manifest."""
    store, path = _files(spark, folder)
    return sorted(int(x.getPath().getParent().getName().split("=")[1]) for x in store.globStatus(path(f"{folder}/manifest=*/_SUCCESS")) or [])


def _manifest(spark, folder: str, version: int) -> dict[int, int]:
    """bucket -> the version that wrote it; as many as the table has buckets."""
    return {r["bucket"]: r["written"] for r in spark.read.schema("bucket int, written int").parquet(f"{folder}/manifest={version}").collect()}


def _buckets(spark, folder: str, held: dict[int, int], types: str) -> DataFrame:
    if not held:
        return spark.createDataFrame([], types)
    return spark.read.schema(types).parquet(*[f"{folder}/version={v}/bucket={b}" for b, v in sorted(held.items())])


def read_table(spark, folder: str, version: int | None = None) -> DataFrame:
    """A table that upsert_stream keeps, as it is or as it was at a version that hasn't expired."""
    there = _versions(spark, folder)
    if not there:
        raise ValueError(f"no table at {folder}")
    held = _manifest(spark, folder, there[-1] if version is None else version)
    return spark.read.parquet(*[f"{folder}/version={v}/bucket={b}" for b, v in sorted(held.items())])


def upsert_batch(batch: DataFrame, number: int, folder: str, key: str, order: str, fields: list[str], buckets: int = BUCKETS, keep: int = KEEP) -> None:
    """Lay a batch over a table in hash buckets of the key. Only buckets that the batch touches are read and written anew, under the batch's
    number; the manifest of that number names for each bucket the version that has it, and makes the batch count. A batch that is
    run again starts from the manifest before it and writes the same again. Manifests beyond the last `keep` (two at least) expire, and with
    them files that no manifest names any more. Rows without key are left out."""
    spark, batch = batch.sparkSession, batch.filter(F.col(key).isNotNull())
    before = [v for v in _versions(spark, folder) if v < number]
    held = _manifest(spark, folder, before[-1]) if before else {}
    types = ", ".join(f"`{n}` {batch.schema[n].dataType.simpleString()}" for n in (key, *fields))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    touched = sorted(r["bucket"] for r in batch.select(bucket.alias("bucket")).distinct().collect())  # at most `buckets`
    if not touched:
        return
    old = _buckets(spark, folder, {b: held[b] for b in touched if b in held}, types)
    after = upsert(old, batch, key, order, fields).withColumn("bucket", bucket)
    after.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/version={number}")
    held |= dict.fromkeys(touched, number)
    spark.createDataFrame(sorted(held.items()), "bucket int, written int").coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest={number}")
    _expire(spark, folder, [*before, number], max(2, keep))


def _expire(spark, folder: str, versions: list[int], keep: int) -> None:
    old, kept = versions[:-keep], versions[-keep:]
    if not old:
        return
    store, path = _files(spark, folder)
    named = {(b, v) for k in kept for b, v in _manifest(spark, folder, k).items()}
    gone = {(b, v) for k in old for b, v in _manifest(spark, folder, k).items()} - named
    for b, v in sorted(gone):
        store.delete(path(f"{folder}/version={v}/bucket={b}"), True)
    for k in old:
        store.delete(path(f"{folder}/manifest={k}"), True)


def upsert_stream(stream: DataFrame, folder: str, checkpoint: str, key: str, order: str, fields: list[str], buckets: int = BUCKETS, keep: int = KEEP) -> StreamingQuery:
    """A stream of upserts over the table of a folder, batch by batch (see upsert_batch)."""

    def step(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            upsert_batch(held, number, folder, key, order, fields, buckets, keep)
        finally:
            held.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def baseline_stream(stream: DataFrame, url: str = "url", content: str = "content_hash", ttl_ms: int | None = None) -> DataFrame:
    """(url, content_hash, change_count, changed) of every snapshot against the last one of its url. With ttl_ms a url's
    state goes when it hasn't been seen for so long; that keeps a query running, so it is for queries without an end."""

    def step(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        last, changes = state.get if state.exists else (None, 0)
        rows = []
        for pdf in pdfs:
            for value in pdf[content]:
                changed = last is not None and value != last
                changes += int(changed)
                last = value
                rows.append((key[0], value, changes, changed))
        state.update((last, changes))
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame(rows, columns=["url", "content_hash", "change_count", "changed"])

    return stream.groupBy(url).applyInPandasWithState(step, "url string, content_hash string, change_count int, changed boolean", "last string, changes int", "append", GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout)


class _Snapshots(StatefulProcessor):
    """Snapshots of one url wait until the watermark has passed their time, and are then compared in the order of time."""

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "content string, changes int, seen long")
        self.waiting = handle.getListState("waiting", "at long, content string")

    def handleInputRows(self, key, rows, timerValues):
        new = [(row["at"], row["content"]) for row in rows]
        if new:
            self.waiting.appendList(new)
            self.handle.registerTimer(min(new)[0])
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """All that is due comes out at once: further timers that the watermark has passed then find nothing, and one is set for the rest."""
        now, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        held = sorted(self.waiting.get())
        due = [x for x in held if x[0] <= passed]
        if not due and not self.idle_ms:
            return iter([])
        last, changes, seen = self.last.get() if self.last.exists() else (None, 0, None)
        out = []
        for at, content in due:
            changed = seen is not None and content != last
            changes, last, seen = changes + changed, content, at
            out.append(Row(url=key[0], at=at, content_hash=content, change_count=changes, changed=changed))
        if due:
            self.last.update((last, changes, seen))
            if len(due) == len(held):
                self.waiting.clear()
            else:
                self.waiting.put(held[len(due) :])
                self.handle.registerTimer(held[len(due)][0])
            if self.idle_ms:
                self.handle.registerTimer(seen + self.idle_ms)
        elif seen is not None and now >= seen + self.idle_ms:
            self.last.clear()
        return iter(out)

    def close(self) -> None:
        pass


def snapshot_changes(stream: DataFrame, url: str = "url", content: str = "content_hash", ts: str = "ts", delay: str = "1 day", idle_ms: int | None = None) -> DataFrame:
    """(url, at, content_hash, change_count, changed) of every snapshot against the one before it in time, whatever the order in which they
    come within the delay: a snapshot is given out when the watermark has passed its time. Equal times go by content; null contents are
    empty, later than the delay are dropped. With idle_ms a url's state goes when nothing was seen for so long. Needs the state store
    with column families (ROCKS)."""
    rows = stream.filter(F.col(url).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    rows = rows.select(F.col(url).alias("url"), F.unix_millis(ts).alias("at"), F.coalesce(content, F.lit("")).alias("content"), F.col(ts).alias("ts"))
    return rows.groupBy("url").transformWithState(_Snapshots(idle_ms), "url string, at long, content_hash string, change_count int, changed boolean", "Append", "EventTime").withColumn("at", F.timestamp_millis("at"))


#: Setting and value that transformWithState needs.
ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_now(frame: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Run a streaming frame over all that is there, and stop."""
    frame.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
