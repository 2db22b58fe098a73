"""Registered streaming queries: run a stream to completion, return its output.

Input is first published to a stream folder below the checkpoint root (files
of at most ``RECORDS_PER_FILE`` records, written where they are read), then a
streaming query drains it with ``availableNow`` in micro-batches bounded by
bytes, and the returned DataFrame reads what the sink wrote. A drain has no
deadline: the result is whole or the query fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.plans.logs import events_to_log_lines, log_lines
from strandline.plans.metrics import events_to_samples, sample_roster
from strandline.session import scratch_path
from strandline.sources.tables import read_table, spread
from strandline.streaming.manifest import read_committed
from strandline.streaming.logstream import drain, process_stream, read_outcomes, read_processed, write_log_stream
from strandline.streaming.shards import drain_shards, publish_batch, read_shards
from strandline.streaming.sources import (
    BYTES_PER_BATCH,
    RECORD_SCHEMA,
    RECORDS_PER_FILE,
    publish_lines,
    read_records,
    read_table_stream,
    record_stream,
)
from strandline.streaming.utilisation import read_complete, start_utilisation_stream, state_session

STATE_PARTITIONS = 8  # one row per open (window, cluster)
LOG_SHARDS = 8
ROWS_PER_BATCH = 5_000_000  # of a record log, over all tasks
LOG_COLUMNS = ("event_id", "row_key", "ip", "ts", "method", "resource", "status", "bytes", "user_agent", "record")


def _run_log_stream(spark: SparkSession, sf_dir: str) -> str:
    """Publish the log lines, drain them through the streaming processor; the sink folder."""
    base = scratch_path(spark, "logstream")
    src, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    publish_lines(log_lines(spark, sf_dir), "parquet", src)
    records = read_records(spark, "parquet", src, RECORD_SCHEMA, max_bytes_per_trigger=BYTES_PER_BATCH)
    drain(write_log_stream(process_stream(records), out, ckpt, available_now=True))
    return out


def stream_log_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines through the streaming processor; the good rows it wrote."""
    return read_processed(spark, _run_log_stream(spark, sf_dir)).select(
        "event_id", "row_key", "ip", "ts", "method", "resource", "status", "bytes", "user_agent", "record")


def stream_log_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same stream; the quarantined rows with their reason."""
    df = read_outcomes(spark, _run_log_stream(spark, sf_dir))
    return df.where(F.col("outcome") != "valid").select("event_id", "line", "reason")


def stream_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node samples from ``events`` through the streaming gauge (complete mode)."""
    base = scratch_path(spark, "utilstream")
    src, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"))
    ev.write.option("maxRecordsPerFile", RECORDS_PER_FILE).parquet(src)
    stream = events_to_samples(read_table_stream(state_session(spark, STATE_PARTITIONS), src, ev.schema,
                                                 max_bytes_per_trigger=BYTES_PER_BATCH))
    drain(start_utilisation_stream(stream, out, ckpt, output_mode="complete", available_now=True))
    return read_complete(spark, out)


GAUGE_SCHEMA = ("window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, cluster STRING, used_mb BIGINT, capacity_mb BIGINT, "
                "pct_x100 BIGINT, pct DECIMAL(20,2)")


def stream_utilisation_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gauge in append mode: each closed window once, with zeros for clusters that sent nothing.

    Samples are laid out by time, as a live stream brings them, so no row is later than the watermark.
    """
    base = scratch_path(spark, "utilall")
    src, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    ev.repartitionByRange("ts").write.option("maxRecordsPerFile", RECORDS_PER_FILE).parquet(src)
    stream = events_to_samples(read_table_stream(state_session(spark, STATE_PARTITIONS), src, ev.schema,
                                                 max_bytes_per_trigger=BYTES_PER_BATCH))
    drain(start_utilisation_stream(stream, out, ckpt, available_now=True, roster=sample_roster(spark, sf_dir)))
    rows = read_committed(spark, out)
    return spark.createDataFrame([], GAUGE_SCHEMA) if rows is None else rows


def _record_log(spark: SparkSession, name: str) -> tuple[str, str, str]:
    base = scratch_path(spark, name)
    return f"{base}/log", f"{base}/out", f"{base}/checkpoint"


def stream_log_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines published to a sharded record log and processed from its earliest record, in batches of bounded rows."""
    log, out, ckpt = _record_log(spark, "shardstream")
    publish_batch(record_stream(log_lines(spark, sf_dir)), log, LOG_SHARDS)
    records = read_shards(spark, log, ckpt, RECORD_SCHEMA, start="earliest", rows_per_batch=ROWS_PER_BATCH)
    drain_shards(write_log_stream(process_stream(records), out, ckpt), log, ckpt)
    return read_processed(spark, out).select(*LOG_COLUMNS)


def stream_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log processor started between two publications, at the latest record: it sees the later one only.

    The events of the first half of their days are published before it starts, the others while it runs.
    """
    log, out, ckpt = _record_log(spark, "lateststream")
    events = spread(read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"))
    span = events.agg(F.min(F.to_date("ts")).alias("low"), F.max(F.to_date("ts")).alias("high"))
    start = span.select(F.date_add("low", F.floor(F.datediff("high", "low") / 2).cast("int"))).first()[0]  # one row
    late = F.coalesce(F.to_date("ts") >= F.lit(start).cast("date"), F.lit(False))
    publish_batch(record_stream(events_to_log_lines(events.where(~late))), log, LOG_SHARDS)
    records = read_shards(spark, log, ckpt, RECORD_SCHEMA, start="latest", rows_per_batch=ROWS_PER_BATCH)
    query = write_log_stream(process_stream(records), out, ckpt)
    query.processAllAvailable()  # its start position is fixed
    publish_batch(record_stream(events_to_log_lines(events.where(late))), log, LOG_SHARDS)
    drain_shards(query, log, ckpt)
    return read_processed(spark, out).select(*LOG_COLUMNS)
