"""Keys that no replay changes, committed folders, compaction, and zeros for silent clusters."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from input_folders import SF001
from pyspark.sql import functions as F

from strandline.operators.aggregate import ratio_of_sums, with_silent
from strandline.plans import logs, metrics
from strandline.plans.logs import log_batch
from strandline.sources.loglines import read_log_lines
from strandline.streaming import manifest as mf
from strandline.streaming.logstream import _batch_writer, drain, process_stream, read_outcomes, read_processed, write_log_stream
from strandline.streaming.sources import RECORD_SCHEMA, publish_lines, read_records, read_table_stream
from strandline.streaming.utilisation import start_utilisation_stream

LINE = '203.0.113.9 - - [05/Nov/2017:01:30:00 +0000] "GET /a HTTP/1.0" 200 5 "-" "Firefox"'


def with_splits(spark, size):
    child = spark.newSession()
    child.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    child.conf.set("spark.sql.files.openCostInBytes", "0")
    return child


@pytest.fixture(scope="module")
def logs_dir(tmp_path_factory):
    """Three files: equal lines throughout, numbered lines with gaps of empty ones, one line; none ends alike."""
    d = tmp_path_factory.mktemp("logs")
    (d / "a.log").write_text((LINE + "\n") * 3000)
    (d / "b.log").write_text("\r\n".join(f"{LINE}{i}" if i % 7 else "" for i in range(2000)))
    (d / "c.log").write_text("é bad line\n")
    return str(d)


@pytest.mark.parametrize("size", [64 << 20, 10_000, 1_777])
def test_line_numbers_do_not_depend_on_splits(spark, logs_dir, size):
    session = with_splits(spark, size)
    got = {}
    for r in read_log_lines(session, logs_dir).collect():
        got.setdefault(os.path.basename(r.file), {})[r.line_no] = r.line
    for name, lines in got.items():
        with open(os.path.join(logs_dir, name), newline="") as fh:
            want = fh.read().replace("\r\n", "\n").split("\n")
        if want[-1] == "":
            want.pop()
        assert [lines[i] for i in range(len(lines))] == want, name
    assert set(got) == {"a.log", "b.log", "c.log"}
    if size < 10_000:
        assert session.read.text(logs_dir).rdd.getNumPartitions() > 50


def test_blocks_beyond_the_broadcast_bound(spark, logs_dir, monkeypatch):
    from strandline.sources import loglines

    want = {(r.file, r.line_no, r.line) for r in read_log_lines(with_splits(spark, 5_000), logs_dir).collect()}
    monkeypatch.setattr(loglines, "BLOCKS", 0)
    assert {(r.file, r.line_no, r.line) for r in read_log_lines(with_splits(spark, 5_000), logs_dir).collect()} == want


def test_batch_job_run_twice_gives_the_same_distinct_keys(spark, logs_dir, tmp_dir):
    keys = []
    for run, size in (("one", 64 << 20), ("two", 3_000)):
        log_batch(with_splits(spark, size), logs_dir, os.path.join(tmp_dir, run))
        rows = read_processed(spark, os.path.join(tmp_dir, run)).select("file", "line_no", "row_key").collect()
        keys.append({(os.path.basename(r.file), r.line_no, r.row_key) for r in rows})
        assert len({k for _, _, k in keys[-1]}) == len(rows) == 3000
    assert keys[0] == keys[1]


def test_a_retried_task_gives_the_same_keys(spark, logs_dir):
    """Recomputed from scratch, partition by partition, in another order."""
    session = with_splits(spark, 20_000)
    df = logs.process_lines(read_log_lines(session, logs_dir), ["file", "line_no"]).select("file", "line_no", "row_key")
    once, again = df.collect(), df.repartition(3, "row_key").collect()
    assert sorted(once) == sorted(again)


def test_stream_records_without_ids_are_keyed_by_their_place(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    recs = spark.createDataFrame([(None, bytearray(LINE, "utf-8"))] * 50, "key string, value binary").coalesce(1)
    recs.write.option("maxRecordsPerFile", 20).parquet(src)
    keys = []
    for run in "ab":
        stream = read_records(spark, "parquet", src, "key string, value binary", max_files_per_trigger=1, places=True)
        out = os.path.join(tmp_dir, f"out{run}")
        drain(write_log_stream(process_stream(stream), out, os.path.join(tmp_dir, f"ckpt{run}"), available_now=True))
        keys.append(sorted(r.row_key for r in read_processed(spark, out).collect()))
    assert keys[0] == keys[1] and len(set(keys[0])) == 50


# --- committed folders ---------------------------------------------------------------------


def _stream(spark, base, name="out"):
    src, out, ckpt = (os.path.join(base, x) for x in ("in", name, f"ckpt-{name}"))
    if not os.path.exists(src):
        publish_lines(logs.log_lines(spark, SF001), "parquet", src, records_per_file=100)
    return src, out, ckpt


def test_a_reader_never_sees_half_a_batch(spark, tmp_dir):
    src, out, ckpt = _stream(spark, tmp_dir)
    recs = read_records(spark, "parquet", src, RECORD_SCHEMA, max_files_per_trigger=3)
    drain(write_log_stream(process_stream(recs), out, ckpt, available_now=True))
    before = read_outcomes(spark, out)
    assert before.count() == 1000
    batch = process_stream(spark.read.schema(RECORD_SCHEMA).parquet(src).limit(300))
    seen = []
    real = mf.commit_batch

    def watched(manifest, batch_id, folder, *a, **kw):
        seen.append(folder)
        assert read_outcomes(spark, out).count() == 1000  # written, not committed: nothing shows
        real(manifest, batch_id, folder, *a, **kw)

    import strandline.streaming.logstream as ls
    old, ls.commit_batch = ls.commit_batch, watched
    try:
        _batch_writer(out, "parquet")(batch, 0)  # a replay of batch 0
    finally:
        ls.commit_batch = old
    assert seen[0] != "batch=0" and before.count() == 1000  # an open reader keeps its files
    _, state = mf.Manifest(spark, out).latest()
    assert len([e for e in state["entries"] if e["low"] == 0]) == 1


def test_a_failed_attempt_stays_invisible(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    rows = process_stream(spark.read.schema(RECORD_SCHEMA).parquet(_published(spark, tmp_dir)))
    mf.begin(mf.Manifest(spark, out), rows.schema)
    assert read_outcomes(spark, out).count() == 0 and read_outcomes(spark, out).columns == rows.columns
    os.makedirs(os.path.join(out, "batch=0", "outcome=valid"))
    rows.where("outcome = 'valid'").drop("outcome").limit(5).write.mode("append").parquet(os.path.join(out, "batch=0", "outcome=valid"))
    assert read_outcomes(spark, out).count() == 0
    _batch_writer(out, "parquet")(rows, 0)
    assert read_outcomes(spark, out).count() == 1000


def _published(spark, tmp_dir):
    return _stream(spark, tmp_dir)[0]


def test_compaction_keeps_rows_and_the_newest_batch(spark, tmp_dir):
    from strandline.cli import main

    src, out, ckpt = _stream(spark, tmp_dir)
    recs = read_records(spark, "parquet", src, RECORD_SCHEMA, max_files_per_trigger=2)
    drain(write_log_stream(process_stream(recs), out, ckpt, available_now=True))
    _, state = mf.Manifest(spark, out).latest()
    n = len(state["entries"])
    want = sorted(map(tuple, read_outcomes(spark, out).select("event_id", "row_key", "outcome", "record", "line").collect()), key=repr)
    reader = read_outcomes(spark, out)
    assert n > 3 and main(["compact-log", out]) == 0
    _, state = mf.Manifest(spark, out).latest()
    assert len(state["entries"]) == 2 and max(e["high"] for e in state["entries"]) == n - 1
    got = sorted(map(tuple, read_outcomes(spark, out).select("event_id", "row_key", "outcome", "record", "line").collect()), key=repr)
    assert got == want and reader.count() == 1000
    compacted = next(e["folder"] for e in state["entries"] if e["low"] != e["high"])
    assert len([f for f in os.listdir(os.path.join(out, compacted, "outcome=valid")) if f.endswith(".parquet")]) == 1
    assert mf.compact(spark, out) == 0  # one folder and the newest: nothing to do
    # the stream goes on after it
    publish_lines(logs.log_lines(spark, SF001).limit(10), "parquet", src)
    recs = read_records(spark, "parquet", src, RECORD_SCHEMA)
    drain(write_log_stream(process_stream(recs), out, ckpt, available_now=True))
    assert read_outcomes(spark, out).count() == 1010


def test_two_writers_lose_no_commit(spark, tmp_dir):
    m = mf.Manifest(spark, os.path.join(tmp_dir, "sink"))
    schema = spark.range(1).schema
    mf.begin(m, schema)
    tries = []

    def slow(state):
        if not tries:
            tries.append(1)
            mf.commit_batch(mf.Manifest(spark, m.path), 7, "batch=7", schema)  # the other one comes first
        return state | {"entries": [*state["entries"], {"low": 8, "high": 8, "folder": "batch=8"}]}

    m.commit(slow)
    assert [e["folder"] for e in m.latest()[1]["entries"]] == ["batch=7", "batch=8"]


# --- silent clusters -----------------------------------------------------------------------


def test_silent_cluster_is_zero(spark):
    nodes = spark.createDataFrame([("a", 3, 7), ("b", 5, 0)], "cluster string, used_mb bigint, capacity_mb bigint")
    roster = spark.createDataFrame([("a",), ("c",), ("c",)], "cluster string")
    got = with_silent(ratio_of_sums(nodes, ["cluster"], "used_mb", "capacity_mb"), roster, ["cluster"], "used_mb", "capacity_mb")
    assert sorted((r.cluster, r.used_mb, r.capacity_mb, r.pct_x100, float(r.pct)) for r in got.collect()) == [
        ("a", 3, 7, 4285, 42.85), ("b", 5, 0, 0, 0.0), ("c", 0, 0, 0, 0.0)]


def test_unlisted_nodes_do_not_count(spark):
    got = {r.cluster: r.capacity_mb for r in metrics.utilisation_all_clusters(spark, SF001).collect()}
    every = {r.cluster: r.capacity_mb for r in metrics.utilisation(spark, SF001).collect()}
    nodes = spark.read.parquet(f"{SF001}/supplier.parquet").where("s_suppkey % 10 = 7").count()
    assert nodes and sum(every.values()) - sum(got.values()) == nodes * metrics.NODE_CAPACITY_MB
    assert sum(v == 0 for c, v in got.items() if c.endswith(metrics.STANDBY)) == 5


def test_stream_fills_silent_clusters_and_windows_without_samples(spark, tmp_dir):
    """Two clusters of which one falls silent, a gap of days, a cluster that never reports, and a replay."""
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    schema = "ts timestamp_ntz, cluster string, used_mb bigint, capacity_mb bigint"
    day = lambda n, h=1: dt.datetime(2024, 1, 1 + n, h)
    files = [[(day(0), "a", 1, 4), (day(0, 5), "b", 2, 4)], [(day(1), "a", 3, 4)], [(day(5), "a", 1, 2)], [(day(9), "b", 1, 2)], [(day(12), "b", 0, 2)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"f{i}"))
    roster = spark.createDataFrame([("a",), ("b",), ("never",)], "cluster string")
    stream = read_table_stream(spark, os.path.join(src, "*"), schema, 1)
    drain(start_utilisation_stream(stream, out, ckpt, watermark="1 hour", available_now=True, roster=roster))
    got = {(r.window_start.day - 1, r.cluster): (r.used_mb, r.pct_x100) for r in mf.read_committed(spark, out).collect()}
    want = {(d, c): (0, 0) for d in range(10) for c in ("a", "b", "never")}
    want |= {(0, "a"): (1, 2500), (0, "b"): (2, 5000), (1, "a"): (3, 7500), (5, "a"): (1, 5000), (9, "b"): (1, 5000)}
    assert got == want
    assert mf.read_committed(spark, out).count() == 30
    with pytest.raises(ValueError):
        start_utilisation_stream(stream, out, ckpt, output_mode="complete", roster=roster)


def test_cli_zero_point_for_a_silent_cluster(spark, tmp_dir):
    from strandline.cli import main
    from strandline.sources.metrics import read_metrics

    report, names, out = (os.path.join(tmp_dir, x) for x in ("report", "names.txt", "points"))
    metrics.node_report(spark, SF001).where(F.col("cluster") == "ASIA").write.parquet(report)
    with open(names, "w") as fh:
        fh.write("ASIA\nMOON\n")
    assert main(["utilisation", report, out, "--clusters", names, "--run", "r", "--time", "2024-01-01T00:00:00"]) == 0
    points = {r.dimensions["Cluster"]: r.value for r in read_metrics(spark, out).collect()}
    assert set(points) == {"ASIA", "MOON"} and points["MOON"] == 0 < points["ASIA"]


def test_second_run_cuts_files_elsewhere_into_few_more_tasks(spark, tmp_dir, monkeypatch):
    """The number of tasks and files of the second run follows the first run's, whatever the input's size."""
    base, src = os.path.join(tmp_dir, "job"), os.path.join(tmp_dir, "in")
    spark.range(70_000).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 900 AS user_id",
        "'purchase' AS event_type", "id / 10 AS value").coalesce(1).write.parquet(os.path.join(src, "events.parquet"))
    monkeypatch.setattr(logs, "scratch_path", lambda *_: base)
    rows = logs.log_batch_replayed(spark, src)
    files = {run: sum(n.endswith(".parquet") for n in os.listdir(os.path.join(base, run, "outcome=valid"))) for run in ("first", "second")}
    assert files["first"] < files["second"] <= 5 * files["first"], files
    assert rows.count() == 70_000 * 49 // 50
    # small files are cut too, and an empty folder has a split size
    one, none = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "none")
    os.makedirs(one), os.makedirs(none)
    with open(os.path.join(one, "a.log"), "w") as fh:
        fh.write((LINE + "\n") * 2500)
    assert logs.replay_split(spark, one) < os.path.getsize(os.path.join(one, "a.log")) // 2
    assert logs.replay_split(spark, none) == logs.REPLAY_SPLIT
