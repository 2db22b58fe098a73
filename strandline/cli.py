"""Command-line jobs, one per pipeline, taking input and output paths.

    spark-submit -m strandline.cli dump-load  <dump dir> <page table>
    spark-submit -m strandline.cli word-count <page table> <tsv dir>
    spark-submit -m strandline.cli log-process <record source> <out dir> <checkpoint> [--interval-ms N]
    spark-submit -m strandline.cli log-batch <log text files> <out dir>
    spark-submit -m strandline.cli compact-log <out dir of log-process>
    spark-submit -m strandline.cli publish-lines <events table> <record dir>
    spark-submit -m strandline.cli utilisation <node reports> <metric table> [--storage <reports>] [--text]

Paths are any Spark filesystem URI (HDFS, S3A, local). Each job builds a
plan and lets Spark run it; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from strandline.session import get_spark, scale_settings


def _dump_load(spark, a) -> int:
    from strandline.plans.text import articles, dump_load_to_table, load_dump
    from strandline.sources.articles import write_article_pairs

    if a.pairs:
        write_article_pairs(articles(load_dump(spark, a.input)), a.output)
        return 0
    n = dump_load_to_table(spark, a.input, a.output)
    print(f"ARTICLES={n}")
    return 0


def _word_count(spark, a) -> int:
    from strandline.operators.ordering import key_partitioned_sorted
    from strandline.plans.text import count_words, word_count_articles
    from strandline.sources.articles import read_article_pairs, write_tsv

    counts = count_words(read_article_pairs(spark, a.input)) if a.pairs else word_count_articles(spark, a.input)
    write_tsv(key_partitioned_sorted(counts, "word", a.partitions), a.output, "word", "n")
    return 0


def _log_process(spark, a) -> int:
    from strandline.streaming.logstream import StreamCut, drain, process_stream, run_for, write_log_stream
    from strandline.streaming.sources import read_records

    opts = dict(kv.split("=", 1) for kv in a.option)
    if a.format == "shardlog":
        return _log_process_shards(spark, a)
    if a.format == "kafka":
        opts.setdefault("subscribe", a.source)        # the stream name
        opts.setdefault("startingOffsets", "latest")  # start at the newest records
    recs = read_records(spark, a.format, None if a.format == "kafka" else a.source, options=opts,
                        max_files_per_trigger=a.max_files_per_trigger)
    q = write_log_stream(process_stream(recs), a.output, a.checkpoint, fmt=a.sink_format,
                         interval_ms=a.interval_ms, available_now=a.available_now)
    if not a.available_now:
        run_for(q, a.timeout_s)
        return 0
    try:
        drain(q, a.timeout_s)
    except StreamCut as e:
        print(f"INCOMPLETE: {e}", file=sys.stderr)
        return 1
    return 0


def _log_process_shards(spark, a) -> int:
    from strandline.streaming.logstream import process_stream, run_for, write_log_stream
    from strandline.streaming.shards import drain_shards, read_shards
    from strandline.streaming.sources import RECORD_SCHEMA

    recs = read_shards(spark, a.source, a.checkpoint, RECORD_SCHEMA, start=a.start,
                       rows_per_batch=a.max_rows_per_trigger, rows_per_second=a.max_rows_per_second)
    q = write_log_stream(process_stream(recs), a.output, a.checkpoint, fmt=a.sink_format, interval_ms=a.interval_ms)
    if a.available_now:
        drain_shards(q, a.source, a.checkpoint)
    else:
        run_for(q, a.timeout_s)
    return 0


def _log_batch(spark, a) -> int:
    from pyspark.sql import Observation

    from strandline.plans.logs import log_batch

    counts = Observation("lines")
    log_batch(spark, a.input, a.output, counts)
    print(f"VALID={counts.get['valid']} QUARANTINED={counts.get['quarantined']}")
    return 0


def _compact_log(spark, a) -> int:
    from strandline.streaming.manifest import compact

    print(f"FOLDERS={compact(spark, a.path, file_bytes=a.file_mb << 20)}")
    return 0


def _publish(spark, a) -> int:
    from strandline.plans.logs import events_to_log_lines
    from strandline.streaming.sources import publish_lines

    events = spark.read.parquet(a.input).select("event_id", "ts", "user_id", "event_type", "value")
    opts = dict(kv.split("=", 1) for kv in a.option)
    if a.format == "shardlog":
        from strandline.streaming.shards import publish_batch
        from strandline.streaming.sources import record_stream

        publish_batch(record_stream(events_to_log_lines(events)), a.output, int(opts.get("shards", 8)))
        return 0
    if a.format == "kafka":
        opts.setdefault("topic", a.output)
    publish_lines(events_to_log_lines(events), a.format, None if a.format == "kafka" else a.output, opts)
    return 0


def _utilisation(spark, a) -> int:
    a.run = a.run or a.time.strftime("%Y%m%dT%H%M%S")
    from strandline.operators.aggregate import ratio_of_sums, with_silent
    from strandline.plans import metrics as m
    from strandline.sources.metrics import write_metrics

    from strandline.sources.reports import read_report_files, read_reports

    def lines(path):
        return read_report_files(spark, path) if a.text else spark.read.parquet(path)

    # a report file is one node: pick its values in the row, no node-level exchange
    nodes = m.node_memory_from_reports(read_reports(spark, a.input)) if a.text else m.node_memory(lines(a.input))
    util = ratio_of_sums(nodes, ["cluster"], "used_mb", "capacity_mb")
    if a.clusters:  # a cluster without a report has a point too: 0
        names = spark.read.text(a.clusters).select(F.trim("value").alias("cluster")).where("cluster <> ''")
        util = with_silent(util, names, ["cluster"], "used_mb", "capacity_mb")
    pts = util.select(F.lit(m.YARN_METRIC).alias("metric"), F.col("pct").alias("value"), "cluster")
    if a.storage:
        dfs = m.dfs_used(lines(a.storage))
        pts = pts.unionByName(dfs.select(F.lit(m.DFS_METRIC).alias("metric"),
                                         F.col("dfs_used_pct").alias("value"), "cluster"))
    write_metrics(pts.select("metric", F.lit(m.NAMESPACE).alias("namespace"), F.lit(m.UNIT).alias("unit"),
                             "value", F.lit(m.DIMENSION).alias("dim_name"),
                             F.col("cluster").alias("dim_value")), a.output, run=a.run, time=a.time)
    return 0


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strandline")
    p.add_argument("--master", default=None)
    p.add_argument("--input-gb", type=float, default=None, help="input volume, to size partitions")
    p.add_argument("--cores", type=int, default=None, help="total executor cores, with --input-gb")
    sub = p.add_subparsers(dest="cmd", required=True)

    d = sub.add_parser("dump-load", help="XML dump -> page table (articles under outcome=valid)")
    d.add_argument("input")
    d.add_argument("output")
    d.add_argument("--pairs", action="store_true", help="write the good articles as key/value files of Hadoop jobs")
    d.set_defaults(fn=_dump_load)

    w = sub.add_parser("word-count", help="page or article table -> word<TAB>count files")
    w.add_argument("input")
    w.add_argument("output")
    w.add_argument("--partitions", type=int, default=None)
    w.add_argument("--pairs", action="store_true", help="the input is key/value files of Hadoop jobs")
    w.set_defaults(fn=_word_count)

    lp = sub.add_parser("log-process", help="stream of log records -> per-batch folders")
    lp.add_argument("source")
    lp.add_argument("output")
    lp.add_argument("checkpoint")
    lp.add_argument("--format", default="parquet")
    lp.add_argument("--option", action="append", default=[], help="source option key=value")
    lp.add_argument("--interval-ms", type=int, default=None)
    lp.add_argument("--available-now", action="store_true")
    lp.add_argument("--max-files-per-trigger", type=int, default=None)
    lp.add_argument("--start", default="latest", choices=["latest", "earliest"], help="of a shardlog, on the first run")
    lp.add_argument("--max-rows-per-trigger", type=int, default=None, help="of a shardlog")
    lp.add_argument("--max-rows-per-second", type=float, default=None, help="of a shardlog")
    lp.add_argument("--sink-format", default="parquet", choices=["parquet", "text"])
    lp.add_argument("--timeout-s", type=float, default=None)
    lp.set_defaults(fn=_log_process)

    lb = sub.add_parser("log-batch", help="access-log text files -> records and quarantine, one pass")
    lb.add_argument("input")
    lb.add_argument("output")
    lb.set_defaults(fn=_log_batch)

    cl = sub.add_parser("compact-log", help="merge the committed folders of log-process, while it runs or not")
    cl.add_argument("path")
    cl.add_argument("--file-mb", type=int, default=128)
    cl.set_defaults(fn=_compact_log)

    pb = sub.add_parser("publish-lines", help="events table -> access-log records on a stream")
    pb.add_argument("input")
    pb.add_argument("output")
    pb.add_argument("--format", default="parquet")
    pb.add_argument("--option", action="append", default=[], help="sink option key=value")
    pb.set_defaults(fn=_publish)

    u = sub.add_parser("utilisation", help="node report lines -> metric points")
    u.add_argument("input")
    u.add_argument("output")
    u.add_argument("--storage", default=None)
    u.add_argument("--clusters", default=None, help="text file of all cluster names; one without reports gets 0")
    u.add_argument("--time", type=dt.datetime.fromisoformat, default=dt.datetime.now(dt.UTC).replace(tzinfo=None),
                   help="time of the points (UTC, ISO 8601); now if not given")
    u.add_argument("--run", default=None, help="name of the run; a repeated run replaces its points; the time if not given")
    u.add_argument("--text", action="store_true",
                   help="inputs are folders of report files: cluster=<c>/node=<n>/<file>, cluster=<c>/<file>")
    u.set_defaults(fn=_utilisation)
    return p


def main(argv: list[str] | None = None) -> int:
    a = build_parser().parse_args(argv)
    extra = scale_settings(int(a.input_gb * (1 << 30)), a.cores or 8) if a.input_gb else None
    spark = get_spark(a.master, extra=extra)
    return a.fn(spark, a)


if __name__ == "__main__":
    sys.exit(main())
