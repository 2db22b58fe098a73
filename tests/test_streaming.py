"""Streams equal batch, restart adds no rows, append mode drops late rows."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from input_folders import SF001
from pyspark.sql import functions as F

from strandline.plans import logs, metrics
from strandline.streaming.logstream import (
    StreamCut,
    drain,
    preview,
    process_stream,
    read_processed,
    run_for,
    write_log_stream,
)
from strandline.streaming.sources import RECORD_SCHEMA, publish_lines, read_records, read_table_stream
from strandline.streaming.utilisation import read_complete, start_utilisation_stream


def _publish(spark, path):
    publish_lines(logs.log_lines(spark, SF001), "parquet", path, records_per_file=400)  # 1000 lines: 3 files


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    _publish(spark, src)
    recs = read_records(spark, "parquet", src, RECORD_SCHEMA, max_files_per_trigger=1)
    drain(write_log_stream(process_stream(recs), out, ckpt, available_now=True))
    cols = ["event_id", "row_key", "ip", "ts", "method", "resource", "status", "bytes", "user_agent", "record"]
    streamed = read_processed(spark, out).select(*cols)
    batch = logs.log_process(spark, SF001).select(*cols)
    assert streamed.count() == batch.count() == 980
    assert streamed.exceptAll(batch).count() == 0
    batches = [d for d in os.listdir(out) if d.startswith("batch=")]
    assert len(batches) == 3
    # restart on the same checkpoint: nothing new, nothing repeated
    recs2 = read_records(spark, "parquet", src, RECORD_SCHEMA, max_files_per_trigger=1)
    drain(write_log_stream(process_stream(recs2), out, ckpt, available_now=True))
    assert read_processed(spark, out).count() == 980
    q = spark.read.parquet(out).where(F.col("outcome") != "valid")
    assert q.count() == 20 and {r.outcome for r in q.collect()} == {"no_match"}


def test_text_layout_per_batch(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    _publish(spark, src)
    recs = read_records(spark, "parquet", src, RECORD_SCHEMA)
    drain(write_log_stream(process_stream(recs), out, ckpt, fmt="text", available_now=True))
    lines = spark.read.text(os.path.join(out, "batch=*")).collect()
    assert len(lines) == 980
    q = spark.read.parquet(os.path.join(out, "quarantine"))
    assert q.count() == 20 and q.where("event_id % 50 = 49 AND reason = 'no_match'").count() == 20
    key, record = lines[0].value.split("\t")
    assert len(key) == 64 and len(record.split(" ")) >= 7


def test_processing_time_trigger_and_clean_stop(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    _publish(spark, src)
    recs = read_records(spark, "parquet", src, RECORD_SCHEMA)
    q = write_log_stream(process_stream(recs), out, ckpt, interval_ms=200)
    q.processAllAvailable()
    run_for(q, 1)
    assert not q.isActive
    assert read_processed(spark, out).count() == 980


def test_preview_prints_the_first_rows(spark, tmp_dir, capsys):
    src = os.path.join(tmp_dir, "in")
    _publish(spark, src)
    recs = read_records(spark, "parquet", src, RECORD_SCHEMA).select("event_id")
    q = preview(recs, n=10)
    q.processAllAvailable()
    q.stop()
    printed = capsys.readouterr().out
    assert "batch 0" in printed and "only showing top 10 rows" in printed
    shown = [int(x.strip("| ")) for x in printed.splitlines() if x.strip("| ").isdigit()]
    assert len(shown) == 10 and all(0 <= i < 1000 for i in shown)


def test_a_cut_drain_is_an_error(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    _publish(spark, src)
    recs = read_records(spark, "parquet", src, RECORD_SCHEMA, max_files_per_trigger=1)
    q = write_log_stream(process_stream(recs), out, ckpt, available_now=True)
    with pytest.raises(StreamCut):
        drain(q, 0.01)
    assert not q.isActive


def test_cli_cut_drain_exits_non_zero(spark, tmp_dir):
    from strandline.cli import main

    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    _publish(spark, src)
    assert main(["log-process", src, out, ckpt, "--available-now", "--timeout-s", "0.01", "--max-files-per-trigger", "1"]) == 1


def test_batches_are_bounded_by_files_and_by_bytes(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _publish(spark, src)
    size = max(os.path.getsize(os.path.join(src, f)) for f in os.listdir(src) if f.endswith(".parquet"))
    for i, bound in enumerate(({"max_files_per_trigger": 1}, {"max_bytes_per_trigger": str(size + 1)})):
        recs = read_records(spark, "parquet", src, RECORD_SCHEMA, **bound)
        q = write_log_stream(process_stream(recs), os.path.join(tmp_dir, f"out{i}"), os.path.join(tmp_dir, f"c{i}"), available_now=True)
        drain(q)
        rows = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
        assert sum(rows) == 1000 and max(rows) <= 400


def test_kafka_job_starts_at_latest_and_bounds_intake(monkeypatch):
    from strandline import cli
    from strandline.streaming import logstream, sources

    seen = {}
    monkeypatch.setattr(cli, "get_spark", lambda *a, **k: None)
    monkeypatch.setattr(sources, "read_records", lambda spark, fmt, path, options, **k: seen.update(options, fmt=fmt, path=path))
    for name in ("process_stream", "write_log_stream", "run_for"):
        monkeypatch.setattr(logstream, name, lambda *a, **k: None)
    assert cli.main(["log-process", "topic1", "out", "ckpt", "--format", "kafka", "--option", "maxOffsetsPerTrigger=500"]) == 0
    assert seen == {"fmt": "kafka", "path": None, "subscribe": "topic1", "startingOffsets": "latest", "maxOffsetsPerTrigger": "500"}
    cli.main(["log-process", "topic1", "out", "ckpt", "--format", "kafka", "--option", "startingOffsets=earliest"])
    assert seen["startingOffsets"] == "earliest"


def test_equal_lines_without_ids_get_keys_of_their_own(spark, tmp_dir):
    from strandline.cli import main

    line = '203.0.113.9 - - [05/Nov/2017:01:30:00 +0000] "GET /a HTTP/1.0" 200 5 "-" "Firefox"'
    src, out = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    with open(os.path.join(src, "a.log"), "w") as fh:
        fh.write((line + "\n") * 5)
    assert main(["log-batch", src, out]) == 0
    rows = read_processed(spark, out)
    assert rows.count() == 5 and rows.select("row_key").distinct().count() == 5
    recs = spark.createDataFrame([(bytearray(line, "utf-8"),)] * 5, "value binary")
    assert process_stream(recs).select("row_key").distinct().count() == 5


def test_publishing_does_not_shuffle(spark):
    from strandline.streaming.sources import record_stream

    plan = record_stream(logs.log_lines(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_stream_utilisation_complete_equals_batch(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("ts", "event_type", "value")
    ev.repartitionByRange(3, "ts").write.parquet(src)
    stream = metrics.events_to_samples(read_table_stream(spark, src, ev.schema, 1))
    drain(start_utilisation_stream(stream, out, ckpt, "complete", available_now=True))
    got = read_complete(spark, out)
    want = metrics.utilisation_by_window(spark, SF001)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_stream_utilisation_append_drops_late_rows(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    schema = "ts timestamp_ntz, event_type string, value double"
    day = dt.datetime(2024, 1, 1)
    # Lateness is judged against the previous batch's watermark, eviction
    # against the current one: the late row comes two batches after the jump.
    files = [
        [(day + dt.timedelta(hours=1), "view", 1.0), (day + dt.timedelta(hours=2), "view", 2.0)],
        [(day + dt.timedelta(days=3), "view", 3.0)],      # watermark -> day 3
        [(day + dt.timedelta(days=3, hours=1), "view", 0.5)],
        [(day + dt.timedelta(hours=5), "view", 100.0)],    # late: dropped
        [(day + dt.timedelta(days=10), "view", 4.0)],      # closes day 4
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"f{i}"))
    stream = metrics.events_to_samples(
        read_table_stream(spark, os.path.join(src, "*"), schema, 1))
    q = start_utilisation_stream(stream, out, ckpt, "append", watermark="1 day", available_now=True)
    drain(q)
    got = sorted((r.window_start, r.used_mb) for r in spark.read.parquet(out).drop("batch").collect())
    assert got == [(day, 30), (day + dt.timedelta(days=3), 35)]
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress)
    assert dropped == 1


def test_cli_publish_and_process(spark, tmp_dir):
    from strandline.cli import main

    recs, out, ckpt = (os.path.join(tmp_dir, x) for x in ("recs", "out", "ckpt"))
    assert main(["publish-lines", f"{SF001}/events.parquet", recs]) == 0
    assert main(["log-process", recs, out, ckpt, "--available-now", "--max-files-per-trigger", "2"]) == 0
    assert read_processed(spark, out).count() == 980


def test_failed_batch_is_replayed_without_duplicates(spark, tmp_dir):
    from strandline.streaming.logstream import _batch_writer

    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    _publish(spark, src)
    good = _batch_writer(out, "parquet")

    def crash_on_second(batch, batch_id):
        good(batch, batch_id)  # output of the batch is written ...
        if batch_id == 1:
            raise RuntimeError("executor lost")  # ... but the batch never commits

    recs = read_records(spark, "parquet", src, RECORD_SCHEMA, max_files_per_trigger=1)
    q = (process_stream(recs).writeStream.foreachBatch(crash_on_second)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    try:
        q.awaitTermination(600)
    except Exception:
        pass
    assert q.exception() is not None
    recs2 = read_records(spark, "parquet", src, RECORD_SCHEMA, max_files_per_trigger=1)
    drain(write_log_stream(process_stream(recs2), out, ckpt, available_now=True))
    got = read_processed(spark, out)
    assert got.count() == 980 and got.select("event_id").distinct().count() == 980


def test_stream_utilisation_on_rocksdb_state(spark, tmp_dir):
    from strandline.streaming.utilisation import ROCKSDB_PROVIDER, state_session

    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("ts", "event_type", "value")
    ev.repartitionByRange(3, "ts").write.parquet(src)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    child = state_session(spark, 2, rocksdb=True)
    stream = metrics.events_to_samples(read_table_stream(child, src, ev.schema, 1))
    drain(start_utilisation_stream(stream, out, ckpt, "complete", available_now=True))
    got = read_complete(spark, out)
    want = metrics.utilisation_by_window(spark, SF001)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
    with open(os.path.join(ckpt, "offsets", "0")) as fh:
        logged = fh.read()
    assert ROCKSDB_PROVIDER in logged and '"spark.sql.shuffle.partitions":"2"' in logged
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_ntz_instant_round_trip_in_any_session_zone(spark):
    from strandline.functions.timeutil import instant_to_ntz, ntz_to_instant

    values = [dt.datetime(2017, 3, 12, 2, 30, 0, 123456),  # New York DST gap
              dt.datetime(2017, 11, 5, 1, 30),              # New York DST overlap
              dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 1, 1)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ["America/New_York", "Asia/Kathmandu", "UTC"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(v,) for v in values], "ts timestamp_ntz")
            out = df.select("ts", F.unix_micros(ntz_to_instant(F.col("ts"))).alias("us"),
                            instant_to_ntz(ntz_to_instant(F.col("ts"))).alias("back")).collect()
            for r in out:
                want = (r.ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
                assert r.us == want and r.back == r.ts, (zone, r)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cli_log_process_text_sink(spark, tmp_dir):
    from strandline.cli import main

    recs, out, ckpt = (os.path.join(tmp_dir, x) for x in ("recs", "out", "ckpt"))
    assert main(["publish-lines", f"{SF001}/events.parquet", recs]) == 0
    assert main(["log-process", recs, out, ckpt, "--available-now", "--sink-format", "text"]) == 0
    lines = [r.value for r in spark.read.text(os.path.join(out, "batch=*")).collect()]
    assert len(lines) == 980 and all(len(v.split("\t")[0]) == 64 for v in lines)
    assert spark.read.parquet(os.path.join(out, "quarantine")).count() == 20
