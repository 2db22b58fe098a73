"""Cluster utilisation metrics (B14, B15, C2, E3, G2, A9, I7 batch twin).

Node and storage reports are derived from the supplier / nation / region
tables (one node per supplier, one cluster per region); node samples from
``events``. Each report is a table of text lines, reduced by distributed
aggregates instead of a sequential loop over nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.metrics import report_value
from strandline.operators.aggregate import first_and_last_by, first_by, ratio_of_sums, with_silent
from strandline.operators.filters import exclude_lines, include_lines
from strandline.session import scratch_path
from strandline.sources.metrics import read_metrics, write_metrics
from strandline.sources.tables import read_table

# Metric names, namespace, unit and dimension of the published points.
YARN_METRIC = "YarnMemUsage"
DFS_METRIC = "DFSUsed"
NAMESPACE = "HadoopClusters"
UNIT = "Percent"
DIMENSION = "Cluster"

# Fixture values for derived reports.
NODE_CAPACITY_MB = 16384
SAMPLE_CAPACITY_MB = 4096
ZERO_CAPACITY_CLUSTER = "signup"
STANDBY = " STANDBY"     # a cluster beside each of the given ones, without nodes or samples
UNLISTED_EVERY = 10      # s_suppkey % 10 = 7: a node that reports but that its cluster no longer lists


def _lines(*pairs: tuple[int, F.Column]) -> F.Column:
    return F.inline(F.array(*[F.struct(F.lit(no).alias("line_no"), line.alias("line")) for no, line in pairs]))


def cluster_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cluster, node, s_suppkey, s_acctbal)``: each supplier a node of its region's cluster."""
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    dims = nat.join(reg, F.col("n_regionkey") == F.col("r_regionkey"))
    return sup.join(dims, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("r_name").alias("cluster"), F.col("s_name").alias("node"), "s_suppkey", "s_acctbal")


def node_list(spark: SparkSession, sf_dir: str, nodes: DataFrame | None = None) -> DataFrame:
    """``(cluster, line)``: each cluster's node listing, a line per node below its header lines."""
    nodes = nodes if nodes is not None else cluster_nodes(spark, sf_dir)
    reg = read_table(spark, sf_dir, "region").select(F.col("r_name").alias("cluster"))
    head = reg.select("cluster", F.explode(F.array(
        F.lit("Total Nodes:many"), F.lit("         Node-Id\t     Node-State\tNode-Http-Address"))).alias("line"))
    return head.unionByName(nodes.select("cluster", F.concat("node", F.lit("\t        RUNNING\t"), "node").alias("line")))


def listed_nodes(listing: DataFrame) -> DataFrame:
    """``(cluster, node)``: first tab-separated field of the listing's lines, without ``Total`` and ``Node-Id`` lines."""
    rows = exclude_lines(exclude_lines(listing, "Total"), "Node-Id")
    return rows.select("cluster", F.trim(F.split_part("line", F.lit("\t"), F.lit(1))).alias("node")).where("node <> ''")


def node_report(spark: SparkSession, sf_dir: str, nodes: DataFrame | None = None) -> DataFrame:
    """``(cluster, node, line_no, line)``: node list header, total, memory used and capacity."""
    nodes = nodes if nodes is not None else cluster_nodes(spark, sf_dir)
    used = F.floor(F.abs(F.col("s_acctbal"))).cast("bigint").cast("string")
    return nodes.select("cluster", "node", _lines(
        (0, F.lit("Node-Id             Node-State")),
        (1, F.lit("Total Nodes:1")),
        (2, F.concat(F.lit("Memory-Used : "), used, F.lit("MB"))),
        (3, F.lit(f"Memory-Capacity : {NODE_CAPACITY_MB}MB")),
    ))


def storage_report(spark: SparkSession, sf_dir: str, nodes: DataFrame | None = None) -> DataFrame:
    """``(cluster, line_no, line)``: a cluster summary first, then one section per data node.

    Every section repeats ``DFS Used%``; only the first line of the report
    carries the cluster figure.
    """
    reg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    summary = reg.select(
        F.col("r_name").alias("cluster"), F.lit(0).cast("bigint").alias("line_no"),
        F.concat(F.lit("DFS Used%: "), F.col("r_regionkey").cast("string"), F.lit(".25%")).alias("line"))
    nodes = nodes if nodes is not None else cluster_nodes(spark, sf_dir)
    pct = F.concat(F.pmod(F.col("s_suppkey"), F.lit(100)).cast("string"), F.lit("."),
                   F.lpad(F.pmod(F.col("s_suppkey"), F.lit(97)).cast("string"), 2, "0"), F.lit("%"))
    sections = nodes.select(
        "cluster", F.inline(F.array(
            F.struct((F.col("s_suppkey") * 2 + 1).alias("line_no"),
                     F.concat(F.lit("Name: "), F.col("node")).alias("line")),
            F.struct((F.col("s_suppkey") * 2 + 2).alias("line_no"),
                     F.concat(F.lit("DFS Used%: "), pct).alias("line")))))
    return summary.unionByName(sections)


def node_memory(report: DataFrame) -> DataFrame:
    """``(cluster, node, used_mb, capacity_mb)`` from node report lines.

    Keep ``Memory-`` lines, take the third blank-separated field without
    ``MB``; the first such value of a node is used memory, the last its
    capacity. Lines of a node sit together, so the partial aggregate folds
    them before the exchange.
    """
    mem = include_lines(report, "Memory-").select(
        "cluster", "node", "line_no", report_value("line", 3, "MB").alias("mb"))
    return first_and_last_by(mem, ["cluster", "node"], "mb", "line_no", "used_mb", "capacity_mb")


def node_memory_from_reports(reports: DataFrame) -> DataFrame:
    """``(cluster, node, used_mb, capacity_mb)`` from whole node reports, one row each.

    A report file holds one node, so its first and last ``Memory-`` line are
    picked inside the row (a short array): no exchange on (cluster, node),
    unlike the line-table form in :func:`node_memory`.
    """
    mem = F.filter("lines", lambda line: line.contains("Memory-"))
    return reports.select(
        "cluster", "node",
        F.when(F.size(mem) > 0, report_value(F.get(mem, 0), 3, "MB")).alias("used_mb"),
        F.when(F.size(mem) > 0, report_value(F.element_at(mem, -1), 3, "MB")).alias("capacity_mb"))


def listed_report(spark: SparkSession, sf_dir: str, nodes: DataFrame | None = None) -> DataFrame:
    """Report lines of the nodes that the cluster's listing names.

    Both sides are dealt by (cluster, node), as the values are gathered.
    """
    report, listing = node_report(spark, sf_dir, nodes), node_list(spark, sf_dir, nodes)
    return report.join(listed_nodes(listing), ["cluster", "node"], "left_semi")


def report_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_memory(listed_report(spark, sf_dir))


def dfs_used(report: DataFrame) -> DataFrame:
    """``(cluster, dfs_used_pct)``: the first ``DFS Used%`` line of each report."""
    hits = include_lines(report, "DFS Used%").select(
        "cluster", "line_no", report_value("line", 3, "%", "decimal(20,2)").alias("pct"))
    return first_by(hits, ["cluster"], "pct", "line_no", "dfs_used_pct")


def report_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dfs_used(storage_report(spark, sf_dir))


def utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory use per cluster: sums over nodes and the truncated percentage."""
    return ratio_of_sums(report_fields(spark, sf_dir), ["cluster"], "used_mb", "capacity_mb")


def cluster_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cluster)``: every region's cluster and its standby, which has no nodes."""
    reg = read_table(spark, sf_dir, "region")
    return reg.select(F.explode(F.array("r_name", F.concat("r_name", F.lit(STANDBY)))).alias("cluster"))


def utilisation_all_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory use of every cluster of the roster: listed nodes only, zeros where a cluster lists none."""
    nodes = cluster_nodes(spark, sf_dir)
    listing = node_list(spark, sf_dir, nodes.where(F.pmod("s_suppkey", F.lit(UNLISTED_EVERY)) != 7))
    report = node_report(spark, sf_dir, nodes).join(listed_nodes(listing), ["cluster", "node"], "left_semi")
    ratios = ratio_of_sums(node_memory(report), ["cluster"], "used_mb", "capacity_mb")
    return with_silent(ratios, cluster_roster(spark, sf_dir), ["cluster"], "used_mb", "capacity_mb")


def sample_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cluster)``: the clusters of the node samples and a standby of each, which sends none."""
    names = read_table(spark, sf_dir, "events").select("event_type").distinct()
    return names.select(F.explode(F.array("event_type", F.concat("event_type", F.lit(STANDBY)))).alias("cluster"))


def node_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ts, cluster, used_mb, capacity_mb)`` samples, one per event."""
    ev = read_table(spark, sf_dir, "events").select("ts", "event_type", "value")
    return events_to_samples(ev)


def events_to_samples(ev: DataFrame) -> DataFrame:
    cap = F.when(F.col("event_type") == ZERO_CAPACITY_CLUSTER, F.lit(0)).otherwise(F.lit(SAMPLE_CAPACITY_MB))
    return ev.select("ts", F.col("event_type").alias("cluster"),
                     F.floor(F.col("value") * 10).cast("bigint").alias("used_mb"),
                     cap.cast("bigint").alias("capacity_mb"))


def utilisation_by_window(spark: SparkSession, sf_dir: str, width: str = "1 day") -> DataFrame:
    """Per tumbling window and cluster: sums and truncated percentage.

    ``window`` over TIMESTAMP_NTZ counts from the epoch without a time zone,
    so one-day windows are UTC days whatever the session zone.
    """
    s = node_samples(spark, sf_dir)
    agg = ratio_of_sums(s, [F.window("ts", width).alias("w"), "cluster"], "used_mb", "capacity_mb")
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "cluster", "used_mb", "capacity_mb", "pct_x100", "pct")


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of one run, written to the metric table and read back.

    ``(metric, namespace, unit, time, value, dim_name, dim_value)``; the run's
    time is that of the last event.
    """
    nodes = cluster_nodes(spark, sf_dir)
    util = ratio_of_sums(node_memory(listed_report(spark, sf_dir, nodes)), ["cluster"], "used_mb", "capacity_mb")
    mem = util.select(F.lit(YARN_METRIC).alias("metric"), F.col("pct").alias("value"), "cluster")
    dfs = dfs_used(storage_report(spark, sf_dir, nodes)).select(
        F.lit(DFS_METRIC).alias("metric"), F.col("dfs_used_pct").alias("value"), "cluster")
    points = mem.unionByName(dfs).select(
        "metric", F.lit(NAMESPACE).alias("namespace"), F.lit(UNIT).alias("unit"), "value",
        F.lit(DIMENSION).alias("dim_name"), F.col("cluster").alias("dim_value"))
    time = read_table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    path = scratch_path(spark, "metrics")
    write_metrics(points, path, run="report", time=time)
    return read_metrics(spark, path).select(
        "metric", "namespace", "unit", "time", "value", F.explode("dimensions").alias("dim_name", "dim_value"))
