"""Utilisation gauge on a stream of node samples.

Samples ``(ts, cluster, used_mb, capacity_mb)`` are summed per tumbling
event-time window and cluster; the percentage is the same truncated integer
ratio as the batch job. State is one pair of sums per open (window,
cluster). With ``append`` (the default for a long-running job) a window is
emitted once the watermark passes its end and its state is dropped; rows
later than the watermark are dropped and counted in the query progress.
``complete`` re-emits all windows every batch and never drops state, so it is
for bounded runs; a long-running gauge uses ``append``.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.functions.timeutil import instant_to_ntz, ntz_to_instant
from strandline.operators.aggregate import pct_columns, with_silent
from strandline.streaming.manifest import Manifest, commit_batch, fresh_folder


def windowed_utilisation(samples: DataFrame, width: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Streaming sums per (window, cluster); ``ts`` is a UTC wall clock (NTZ)."""
    timed = samples.withColumn("event_time", ntz_to_instant(F.col("ts")))
    return (timed.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", width).alias("w"), "cluster")
            .agg(F.sum("used_mb").cast("bigint").alias("used_mb"),
                 F.sum("capacity_mb").cast("bigint").alias("capacity_mb")))


def finish(agg: DataFrame) -> DataFrame:
    """Window bounds back to UTC wall clocks, plus the percentage columns."""
    out = agg.select(instant_to_ntz(F.col("w.start")).alias("window_start"),
                     instant_to_ntz(F.col("w.end")).alias("window_end"),
                     "cluster", "used_mb", "capacity_mb")
    return pct_columns(out, "used_mb", "capacity_mb")


def fill_silent(closed: DataFrame, roster: DataFrame, width: str, after: dt.datetime | None) -> DataFrame:
    """Rows of zeros beside ``closed`` (finished windows): one for each cluster of ``roster`` and window without a row.

    ``after`` is the end of the last window emitted before, so windows in which no cluster sent
    a sample are filled too. Windows are taken from their first start to their last, a
    sequence of ``width`` for each cluster; only rows of closed windows move.
    """
    low, high, end = closed.agg(F.min("window_start"), F.max("window_start"), F.max("window_end")).first()
    if low is None:
        return closed
    first = low if after is None else min(low, after)
    starts = F.sequence(F.lit(first).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"), F.expr(f"INTERVAL {width}"))
    length = F.lit(end - high)
    grid = roster.select("cluster", F.explode(starts).alias("window_start")).withColumn("window_end", F.col("window_start") + length)
    return with_silent(closed, grid, ["window_start", "window_end", "cluster"], "used_mb", "capacity_mb")


def _batch_writer(path: str, roster: DataFrame | None = None, width: str = "1 day"):
    def write(batch: DataFrame, batch_id: int) -> None:
        if roster is None:
            finish(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            return
        spark = batch.sparkSession
        manifest = Manifest(spark, path)
        _, state = manifest.latest()
        # of the batches before this one only, so a replay fills the same windows
        ends = [e["end"] for e in (state or {"entries": []})["entries"] if e["high"] < batch_id and e.get("end")]
        after = dt.datetime.fromisoformat(max(ends)) if ends else None
        closed = finish(batch).persist()  # one row a closed window and cluster; its bounds are looked at first
        try:
            rows = fill_silent(closed, roster, width, after)
            end = closed.agg(F.max("window_end")).first()[0]
            folder = fresh_folder(manifest, batch_id)
            rows.write.parquet(f"{path}/{folder}")
            commit_batch(manifest, batch_id, folder, rows.schema, end=end.isoformat() if end else None)
        finally:
            closed.unpersist()
    return write


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The whole current table of a ``complete``-mode run: its last batch folder.

    Every batch folder holds a full table, so the previous one stays whole
    while the next is written or replayed. The newest is found in the file
    listing; no other folder is read.
    """
    files = spark.read.parquet(path).inputFiles()
    last = max(int(m[1]) for f in files if (m := re.search(r"/batch=(\d+)/", f)))
    return spark.read.parquet(f"{path}/batch={last}")


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession, state_partitions: int, rocksdb: bool = False) -> SparkSession:
    """A child session (same context, own SQL settings) for a stateful stream.

    A new streaming query takes its number of state store partitions from
    ``spark.sql.shuffle.partitions`` and keeps it in its checkpoint for good.
    The gauge's state is one row per open (window, cluster), so a few
    partitions suffice, and every extra one costs a task and a state file
    per micro-batch. With ``rocksdb`` the state lives in RocksDB (off the
    JVM heap), for many keys or long windows. Build the stream on this
    session; the caller's own settings stay untouched.
    """
    child = spark.newSession()
    child.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    if rocksdb:
        child.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return child


def start_utilisation_stream(samples: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                             width: str = "1 day", watermark: str = "1 day",
                             available_now: bool = False, interval_ms: int | None = None,
                             roster: DataFrame | None = None) -> StreamingQuery:
    """Run the gauge into ``path``.

    With a ``roster`` of clusters (``append`` only) each closed window has a row for every one of
    them, zeros for a silent one, windows without any sample included. The batch folders are
    then on the sink's list (read with :func:`manifest.read_committed`), which keeps the end of
    the last window for the next batch.

    One folder ``batch=<id>`` per micro-batch; a replayed batch overwrites its
    own folder. ``complete``: each folder holds the whole table as of that
    batch (read it with :func:`read_complete`). ``append``/``update``: each
    folder holds the windows that batch emitted.
    The state partitioning comes from the session ``samples`` was built on
    (see :func:`state_session`).
    """
    if roster is not None and output_mode != "append":
        raise ValueError("a roster fills windows once, as they close: output_mode must be append")
    agg = windowed_utilisation(samples, width, watermark)
    w = (agg.writeStream.outputMode(output_mode).foreachBatch(_batch_writer(path, roster, width))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval_ms:
        w = w.trigger(processingTime=f"{int(interval_ms)} milliseconds")
    return w.start()
