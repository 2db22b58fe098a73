"""Report field extraction, truncating percent, first match, metric sink, sampler."""

from __future__ import annotations

import datetime as dt
import decimal

from input_folders import SF001
from pyspark.sql import functions as F

from strandline.functions.metrics import cut_field, report_value
from strandline.operators.aggregate import pct_columns
from strandline.plans import metrics, sampling
from strandline.sources.metrics import parse_dimensions, read_metrics, write_metrics


def test_percent_truncates(spark):
    df = spark.createDataFrame([(3, 7), (1, 3), (5, 0), (2, 3), (0, 0)], "u bigint, a bigint")
    got = [(r.pct_x100, r.pct) for r in pct_columns(df, "u", "a").collect()]
    want = [(4285, "42.85"), (3333, "33.33"), (0, "0.00"), (6666, "66.66"), (0, "0.00")]
    assert got == [(a, decimal.Decimal(b)) for a, b in want]


def test_cut_field_semantics(spark):
    df = spark.createDataFrame([("Memory-Used : 1024MB",), ("a  b c",), ("nodelim",), ("a b",)], "l string")
    got = [r.f for r in df.select(cut_field("l", 3).alias("f")).collect()]
    assert got == ["1024MB", "b", "nodelim", ""]
    v = df.select(report_value("l", 3, "MB").alias("v")).first().v
    assert v == 1024


def test_first_and_last_memory_values(spark):
    lines = spark.createDataFrame(
        [("c", "n1", 0, "Total Nodes:2"), ("c", "n1", 1, "Memory-Used : 10MB"), ("c", "n1", 2, "Memory-Capacity : 40MB"),
         ("c", "n2", 0, "Memory-Used : 5MB"), ("c", "n2", 1, "Memory-Capacity : 0MB")],
        "cluster string, node string, line_no int, line string")
    nodes = sorted(tuple(r) for r in metrics.node_memory(lines).collect())
    assert nodes == [("c", "n1", 10, 40), ("c", "n2", 5, 0)]


def test_storage_first_match_per_cluster(spark):
    got = dict((r.cluster, r.dfs_used_pct) for r in metrics.report_first_match(spark, SF001).collect())
    assert got == {"AFRICA": 0.25, "AMERICA": 1.25, "ASIA": 2.25, "EUROPE": 3.25, "MIDDLE EAST": 4.25}


def test_utilisation_matches_direct_sums(spark):
    util = {r.cluster: (r.used_mb, r.capacity_mb, r.pct_x100) for r in metrics.utilisation(spark, SF001).collect()}
    nodes = metrics.cluster_nodes(spark, SF001).groupBy("cluster").agg(
        F.sum(F.floor(F.abs("s_acctbal"))).alias("u"), F.count("*").alias("n"))
    for r in nodes.collect():
        used, cap, x100 = util[r.cluster]
        assert used == r.u and cap == 16384 * r.n and x100 == (r.u * 10000) // cap


def test_zero_capacity_window_gives_zero(spark):
    rows = metrics.utilisation_by_window(spark, SF001).where(F.col("cluster") == "signup").collect()
    assert rows and all(r.capacity_mb == 0 and r.pct_x100 == 0 for r in rows)


def test_dimension_lookup_is_broadcast(spark):
    plan = metrics.cluster_nodes(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_metric_sink_round_trip(spark, tmp_dir):
    pts = metrics.metric_points(spark, SF001)
    when = pts.first().time
    write_metrics(pts, tmp_dir, run="r", time=when)
    back = read_metrics(spark, tmp_dir)
    assert {r.time for r in back.collect()} == {when}
    assert back.count() == 10
    r = back.where("metric = 'DFSUsed' AND dimensions['Cluster'] = 'ASIA'").first()
    assert (r.namespace, r.unit, r.value) == ("HadoopClusters", "Percent", decimal.Decimal("2.25"))
    assert spark.range(1).select(parse_dimensions("Cluster=MyFirstCluster").alias("m")).first().m == {
        "Cluster": "MyFirstCluster"}


def test_weighted_assign_follows_weights(spark):
    df = sampling.weighted_assign(spark, "/root/testdata/sf0.01")
    n = df.count()
    channel = dict(df.groupBy("channel").count().collect())
    assert abs(channel["web"] / n - 5 / 8.5) < 0.03 and abs(channel["partner"] / n - 0.5 / 8.5) < 0.02
    tier = dict(df.groupBy("tier").count().collect())
    assert abs(tier["basic"] / n - 6 / 10) < 0.03 and set(tier) == {"basic", "plus", "pro"}
    own = sampling.assign(df.select("event_id"), "event_id", {"x": [("only", 1.0)]})
    assert own.columns == ["event_id", "x"] and own.where("x <> 'only'").count() == 0
    b = df.agg(F.min("units"), F.max("units")).first()
    assert b[0] >= 0 and b[1] <= 9999
    again = sampling.weighted_assign(spark, "/root/testdata/sf0.01")
    assert df.exceptAll(again).count() == 0


def test_cli_utilisation_writes_points(spark, tmp_dir):
    import os

    from strandline.cli import main

    nodes, storage, out = (os.path.join(tmp_dir, x) for x in ("nodes", "storage", "out"))
    metrics.node_report(spark, SF001).write.parquet(nodes)
    metrics.storage_report(spark, SF001).write.parquet(storage)
    assert main(["utilisation", nodes, out, "--storage", storage]) == 0
    got = read_metrics(spark, out)
    assert got.count() == 10 and {r.metric for r in got.collect()} == {"YarnMemUsage", "DFSUsed"}


def test_hot_cluster_sums_stay_exact(spark):
    # a third of all nodes report to one cluster: partial sums before the exchange
    report = metrics.node_report(spark, "/root/testdata/sf0.01")
    hot = report.withColumn(
        "cluster", F.when(F.abs(F.hash("node")) % 3 == 0, F.lit("HOT")).otherwise(F.col("cluster")))
    from strandline.operators.aggregate import ratio_of_sums

    util = ratio_of_sums(metrics.node_memory(hot), ["cluster"], "used_mb", "capacity_mb")
    plan = util._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    direct = (metrics.cluster_nodes(spark, "/root/testdata/sf0.01")
              .withColumn("cluster", F.when(F.abs(F.hash("node")) % 3 == 0, F.lit("HOT")).otherwise(F.col("cluster")))
              .groupBy("cluster").agg(F.sum(F.floor(F.abs("s_acctbal"))).alias("u"), F.count("*").alias("n")))
    want = {r.cluster: (r.u, 16384 * r.n) for r in direct.collect()}
    got = {r.cluster: (r.used_mb, r.capacity_mb) for r in util.collect()}
    assert got == want and "HOT" in got


def test_report_text_files_round_trip(spark, tmp_dir):
    import os

    from strandline.sources.reports import read_report_files

    report = metrics.node_report(spark, SF001)
    path = os.path.join(tmp_dir, "nodes")
    for r in report.groupBy("cluster", "node").agg(
            F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls")).collect():
        d = os.path.join(path, f"cluster={r.cluster}", f"node={r.node}")
        os.makedirs(d)
        with open(os.path.join(d, "status.txt"), "w") as fh:
            fh.write("".join(x.line + "\n" for x in r.ls))
    back = read_report_files(spark, path)
    assert sorted(tuple(r) for r in back.select("cluster", "node", "line_no", "line").collect()) == \
        sorted(tuple(r) for r in report.select("cluster", "node", "line_no", "line").collect())
    util_text = {r.cluster: r.pct_x100 for r in ratio_of_sums_from(back).collect()}
    util_table = {r.cluster: r.pct_x100 for r in metrics.utilisation(spark, SF001).collect()}
    assert util_text == util_table
    from strandline.sources.reports import read_reports

    in_row = metrics.node_memory_from_reports(read_reports(spark, path))
    assert sorted(tuple(r) for r in in_row.collect()) == sorted(tuple(r) for r in metrics.node_memory(back).collect())
    assert "Exchange" not in in_row._jdf.queryExecution().executedPlan().toString()


def ratio_of_sums_from(report):
    from strandline.operators.aggregate import ratio_of_sums

    return ratio_of_sums(metrics.node_memory(report), ["cluster"], "used_mb", "capacity_mb")


def test_storage_report_text_file_first_match(spark, tmp_dir):
    import os

    from strandline.sources.reports import read_report_files

    d = os.path.join(tmp_dir, "storage", "cluster=c1")
    os.makedirs(d)
    with open(os.path.join(d, "report.txt"), "w") as fh:
        fh.write("Configured Capacity: 1\r\nDFS Used%: 12.5%\r\nName: dn1\r\nDFS Used%: 99.99%\r\n")
    got = metrics.dfs_used(read_report_files(spark, os.path.join(tmp_dir, "storage"))).collect()
    assert [(r.cluster, r.dfs_used_pct) for r in got] == [("c1", 12.5)]


def test_cli_utilisation_from_text_reports(spark, tmp_dir):
    import os

    from strandline.cli import main

    nodes, out = os.path.join(tmp_dir, "nodes"), os.path.join(tmp_dir, "out")
    for c, n, used in [("c1", "n1", 100), ("c1", "n2", 300), ("c2", "n3", 7)]:
        d = os.path.join(nodes, f"cluster={c}", f"node={n}")
        os.makedirs(d)
        with open(os.path.join(d, "status.txt"), "w") as fh:
            fh.write(f"Node Report :\n\tMemory-Used : {used}MB\n\tMemory-Capacity : 1000MB\n")
    assert main(["utilisation", nodes, out, "--text"]) == 0
    got = {r.dimensions["Cluster"]: r.value for r in read_metrics(spark, out).collect()}
    assert got == {"c1": decimal.Decimal("20.00"), "c2": decimal.Decimal("0.70")}


def test_scale_settings():
    from strandline.session import scale_settings

    s = scale_settings(100 << 40, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == (100 << 40) // (512 << 20)
    assert int(scale_settings(1 << 30, 8)["spark.sql.shuffle.partitions"]) == 16


def test_a_repeated_run_replaces_its_points(spark, tmp_dir):
    rows = [("M", "N", "Percent", 12.5, "Cluster", "c1")]
    flat = "metric string, namespace string, unit string, value double, dim_name string, dim_value string"
    df = spark.createDataFrame(rows, flat)
    for run, hour in (("a", 1), ("b", 2), ("a", 1)):
        write_metrics(df, tmp_dir, run=run, time=dt.datetime(2024, 1, 1, hour))
    got = sorted((r["run"], r["time"], r["value"], r["dimensions"]) for r in read_metrics(spark, tmp_dir).collect())
    value = decimal.Decimal("12.50")
    assert got == [("a", dt.datetime(2024, 1, 1, 1), value, {"Cluster": "c1"}), ("b", dt.datetime(2024, 1, 1, 2), value, {"Cluster": "c1"})]


def test_only_listed_nodes_count(spark):
    listing = spark.createDataFrame([("c", "Total Nodes:2"), ("c", "         Node-Id\t     Node-State"), ("c", "n1:45454\t RUNNING\tn1:8042"),
                                     ("c", ""), ("c", None), ("c", " n2:45454\t RUNNING")], "cluster string, line string")
    assert sorted(r.node for r in metrics.listed_nodes(listing).collect()) == ["n1:45454", "n2:45454"]
    fields = metrics.report_fields(spark, SF001)
    assert fields.count() == spark.read.parquet(f"{SF001}/supplier.parquet").count()
