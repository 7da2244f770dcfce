"""Streams: incremental ingest, windowed counters, alerts with state, enrichment, open requests.

All run with trigger(availableNow) and a checkpoint, so a stopped run goes on where it ended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wardgraph.operators.telemetry import ALERT_STEPS, BUCKETS, bucket_counts, bucket_rows, exact_sum
from wardgraph.sources.sinks import upsert_by_year

LATE = "10 minutes"


def events_stream(spark: SparkSession, path: str, schema, files: int | None = None) -> DataFrame:
    """Parquet files as they land, ts as a timestamp; at most `files` a micro-batch, or all that are new."""
    reader = spark.readStream.schema(schema)
    df = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_end(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, path: str | None = None, mode: str = "append", rocksdb: bool = False) -> None:
    """Everything that is there now, to a function of each micro-batch or to Parquet files. rocksdb: state on disk, as timers and
    large state need it; a stream keeps the store that it began with."""
    conf = df.sparkSession.conf
    before = conf.get(STATE_STORE, None)
    if rocksdb:
        conf.set(STATE_STORE, ROCKSDB)
    try:
        _run_to_end(df, checkpoint, each, path, mode)
    finally:
        if rocksdb:
            conf.set(STATE_STORE, before) if before else conf.unset(STATE_STORE)


def _run_to_end(df: DataFrame, checkpoint: str, each, path: str | None, mode: str) -> None:
    out = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    out = out.foreachBatch(each) if each else out.format("parquet").option("path", path)
    out.start().awaitTermination()


def last_of_batch(df: DataFrame, key: str, order: str) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def ingest(df: DataFrame, checkpoint: str, table: str, key: str = "cve_id", order: str = "published") -> None:
    """Records of a stream into the year-partitioned table: of a key the last one stays. Writing a batch again changes
    nothing, so the sink is as good as exactly-once."""
    run_to_end(df, checkpoint, each=lambda batch, _: upsert_by_year(last_of_batch(batch, key, order), table, key))


def windowed(events: DataFrame, keys: list[str], size: str = "5 minutes", slide: str | None = None, late: str = LATE) -> DataFrame:
    """Count and sum of value by time window and keys; rows later than `late` are dropped once their window is closed.
    The same function serves a batch."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    out = rows.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(24,4)")).alias("total"))
    return out.select(F.col("w.start").alias("start"), *keys, "n", F.col("total").cast("double").alias("total"))


def windowed_histogram(events: DataFrame, keys: list[str], buckets: tuple[float, ...] = BUCKETS, size: str = "5 minutes", late: str = LATE) -> DataFrame:
    """Count, sum and cumulative counts up to each bucket, by time window and keys: a row a bucket. The same function serves a
    batch."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    wide = rows.groupBy(F.window("ts", size).alias("w"), *keys).agg(F.count("*").alias("n"), exact_sum("value").alias("total"), *bucket_counts(buckets))
    return bucket_rows(wide.withColumn("start", F.col("w.start")), ["start", *keys], buckets)


def split_late(events: DataFrame, checkpoint: str, on_time: str, late_rows: str, late: str = LATE) -> None:
    """Each row of a stream to one of two tables: behind the watermark (the latest time of the micro-batches before, less `late`), or
    not. Rows without a time are in no window and count as late. A micro-batch writes folders and a mark of its own, from
    the mark of the one before, so that a repeated one changes nothing. A windowed stream of on_time, whose files come in
    order, drops nothing: its watermark is never ahead of this one's."""
    spark, marks = events.sparkSession, f"{checkpoint}/marks"
    schema = "latest timestamp"

    def each(batch: DataFrame, n: int) -> None:
        before = None
        if n:
            before = spark.read.schema(schema).parquet(f"{marks}/{n - 1}").first()[0]
        limit = F.lit(before) - F.expr(f"interval {late}")
        behind = F.col("ts").isNull() | F.coalesce(F.col("ts") < limit, F.lit(False)) if before else F.col("ts").isNull()
        batch.where(~behind).write.mode("overwrite").parquet(f"{on_time}/batch={n}")
        batch.where(behind).write.mode("overwrite").parquet(f"{late_rows}/batch={n}")
        batch.agg(F.greatest(F.max("ts"), F.lit(before).cast("timestamp")).alias("latest")).write.mode("overwrite").parquet(f"{marks}/{n}")

    run_to_end(events, f"{checkpoint}/stream", each=each)


def sessions(events: DataFrame, key: str, gap: str = "30 minutes", late: str = LATE) -> DataFrame:
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    out = rows.groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def _alert(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counts a key's errors on from the state; a row for each n-th. What a key has in a micro-batch, two numbers a row, is
    put in order as a whole."""
    count = state.get[0] if state.exists else 0
    step = ALERT_STEPS.get(key[1], 100)
    rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "event_id"])
    nth = range(count + 1, count + len(rows) + 1)
    state.update((count + len(rows),))
    hit = rows.assign(category=key[0], severity=key[1], nth=list(nth))
    yield hit[hit.nth % step == 0][["event_id", "category", "severity", "nth"]]


def alert_stream(errors: DataFrame) -> DataFrame:
    """Each n-th error of a (category, severity) as it arrives: in order of ts within a micro-batch, and of arrival from one to
    the next. How much a micro-batch holds, and a key at most, is set by the source's maxFilesPerTrigger."""
    return errors.select("category", "severity", "ts", "event_id").groupBy("category", "severity").applyInPandasWithState(_alert, "event_id long, category string, severity string, nth long", "count long", "append", GroupStateTimeout.NoTimeout)


class OrderedAlerts(StatefulProcessor):
    """Holds a key's rows in slices of time until the watermark passes a slice's end; a timer then numbers them in order. State of a
    key: how many were numbered, and for each open slice 16 bytes a row."""

    def __init__(self, slice_ms: int):
        self.slice_ms = slice_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")
        self.slices = handle.getMapState("slices", "slice long", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for some in rows:  # batches of bounded size
            pairs = some[["us", "event_id"]].to_numpy(np.int64)
            at = pairs[:, 0] // (1000 * self.slice_ms)
            for s in np.unique(at).tolist():
                held = self.slices.getValue((s,))[0] if self.slices.containsKey((s,)) else b""
                self.slices.updateValue((s,), (bytes(held) + pairs[at == s].tobytes(),))
                self.handle.registerTimer((s + 1) * self.slice_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s = expiredTimerInfo.getExpiryTimeInMs() // self.slice_ms - 1
        pairs = np.frombuffer(bytes(self.slices.getValue((s,))[0]), np.int64).reshape(-1, 2)
        self.slices.removeKey((s,))
        done = self.count.get()[0] if self.count.exists() else 0
        ids = pairs[np.lexsort((pairs[:, 1], pairs[:, 0])), 1]
        self.count.update((done + len(ids),))
        step = ALERT_STEPS.get(key[1], 100)
        hit = np.arange(step - 1 - done % step, len(ids), step)
        yield pd.DataFrame({"event_id": ids[hit], "category": key[0], "severity": key[1], "nth": done + 1 + hit})

    def close(self) -> None:
        pass


def ordered_alerts(errors: DataFrame, slice_: int = 3600, late: str = LATE) -> DataFrame:
    """Each n-th error of a (category, severity) in order of time, as alerts() of a batch numbers them, however the rows arrive within
    `late`; a row comes out once the watermark passes its slice of `slice_` seconds. Rows behind the watermark are not
    numbered (split_late keeps them); rows without a time count as the first of all, so they must come first. Wants run_to_end with
    rocksdb."""
    timed = errors.withColumn("ts", F.coalesce("ts", F.timestamp_micros(F.lit(0))))
    rows = timed.withWatermark("ts", late).select("category", "severity", "ts", F.unix_micros("ts").alias("us"), "event_id")
    return rows.groupBy("category", "severity").transformWithStateInPandas(OrderedAlerts(1000 * slice_), "event_id long, category string, severity string, nth long", "append", "eventTime")


def dedupe(df: DataFrame, keys: list[str], late: str = LATE) -> DataFrame:
    """Exact repeats that come within the watermark are dropped."""
    return df.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def open_requests(starts: DataFrame, ends: DataFrame, within: str = "1 hour", late: str = LATE) -> DataFrame:
    """Starts without an end. Of two batches an anti-join; of two streams a left outer join, which must let a start go some
    time: one that has no end `within` that time of it comes out as open."""
    s = starts.withColumnRenamed("ts", "start_ts")
    e = ends.select(F.col("request_id").alias("end_id"), F.col("ts").alias("end_ts"))
    if not starts.isStreaming:
        return s.join(e, F.col("request_id") == F.col("end_id"), "left_anti")
    s, e = s.withWatermark("start_ts", late), e.withWatermark("end_ts", late)
    on = (F.col("request_id") == F.col("end_id")) & (F.col("end_ts") >= F.col("start_ts")) & (F.col("end_ts") <= F.col("start_ts") + F.expr(f"interval {within}"))
    return s.join(e, on, "left_outer").where("end_id is null").drop("end_id", "end_ts")


def freshness_gate(stamps: DataFrame, now: str, hours: float = 24, forced: bool = False) -> DataFrame:
    """(name, stamp as text) -> whether a refresh is due: forced, never run, unreadable, or older than `hours`."""
    age = F.timestamp_diff("SECOND", F.try_to_timestamp("stamp"), F.lit(now).cast("timestamp")) / 3600
    return stamps.withColumn("due", F.lit(forced) | F.coalesce(age > hours, F.lit(True)))
