"""Access-log pipelines (B2-B8, B11-B13, C1) over log lines derived from ``events``.

``log_lines`` renders one access-log line per event; every other query
parses those lines again, so the parse does real work on every row. The
processing is narrow; the only exchange is the category count's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandline.functions.logs import (
    anonymize,
    categorize_ua,
    parse_access_log,
    random_row_key,
    render_log_line,
    render_record,
    row_key,
)
from strandline.operators.aggregate import count_per_key
from strandline.operators.quarantine import quarantined_rows, valid_rows, write_split
from strandline.session import scratch_path
from strandline.sources.loglines import read_log_lines
from strandline.sources.tables import read_table, spread

# Test fixture values: one agent per ``event_id % 7``; 0 and 6 are Chrome
# family (6 is an Edge agent that also names Chrome), 3 is Opera (names
# Chrome, Safari and OPR), 5 is a command-line client.
FIXTURE_AGENTS = [
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 14_2) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.2 Safari/605.1.15",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 OPR/106.0.0.0",
    "Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko",
    "curl/8.5.0",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/51.0.2704.79 Safari/537.36 Edge/14.14393",
]
FIXTURE_REFERER = "http://example.com/"
REPLAY_SPLIT = 64 << 10  # bytes of a split in the batch job's second run, at least
REPLAY_CUTS = 3          # splits of the second run for one of the first
BAD_LINE_EVERY = 50  # event_id % 50 = 49 gives an unparsable line


#: Rows that the batch job writes.
BATCH_SCHEMA = ("file STRING, line_no BIGINT, line STRING, reason STRING, row_key STRING, ip STRING, ts TIMESTAMP_NTZ, "
                "local_ts TIMESTAMP_NTZ, offset_min INT, method STRING, resource STRING, status INT, bytes BIGINT, "
                "user_agent STRING, record STRING, outcome STRING")


def events_to_log_lines(events: DataFrame) -> DataFrame:
    """``(event_id, line)``: an access-log line per event, every 50th one broken."""
    e = events
    agents = F.array(*[F.lit(a) for a in FIXTURE_AGENTS])
    good = render_log_line(
        ip=F.concat(F.lit("10.0."), F.pmod(F.col("user_id"), F.lit(256)).cast("string"), F.lit("."),
                    F.pmod(F.col("event_id"), F.lit(256)).cast("string")),
        ts=F.col("ts"),
        method=F.when(F.col("event_type") == "purchase", F.lit("POST"))
        .when(F.col("event_type") == "signup", F.lit("PUT")).otherwise(F.lit("GET")),
        resource=F.concat(F.lit("/"), F.col("event_type")),
        status=F.when(F.col("event_type") == "error", F.lit(404)).otherwise(F.lit(200)),
        nbytes=F.floor(F.col("value") * 10).cast("bigint"),
        referer=F.lit(FIXTURE_REFERER),
        ua=F.element_at(agents, (F.pmod(F.col("event_id"), F.lit(len(FIXTURE_AGENTS))) + 1).cast("int")),
    )
    line = F.when(F.pmod(F.col("event_id"), F.lit(BAD_LINE_EVERY)) == BAD_LINE_EVERY - 1,
                  F.concat(F.lit("bad line "), F.col("event_id").cast("string"))).otherwise(good)
    return e.select("event_id", line.alias("line"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return events_to_log_lines(spread(events))


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_log(log_lines(spark, sf_dir), "line")


def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed fields of every good line."""
    return valid_rows(parsed_lines(spark, sf_dir)).select(
        "event_id", "ip", "ts", "local_ts", "offset_min", "method", "resource", "status", "bytes", "user_agent")


def log_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that failed to parse, with the reason."""
    return quarantined_rows(parsed_lines(spark, sf_dir)).select("event_id", "line", "reason")


def log_anonymize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_parse(spark, sf_dir).select("event_id", anonymize("ip").alias("ip_anon"))


def log_ua_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_parse(spark, sf_dir).select("event_id", categorize_ua("user_agent").alias("ua_category"))


def log_ua_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good lines per browser family (partial counts before the exchange)."""
    cats = log_parse(spark, sf_dir).select(categorize_ua("user_agent").alias("ua_category"))
    return count_per_key(cats, "ua_category", "n")


def log_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic key per record from its id and raw line."""
    return valid_rows(parsed_lines(spark, sf_dir)).select("event_id", row_key("event_id", "line").alias("row_key"))


def process_lines(lines: DataFrame, id_cols: list[str], line: str = "line",
                  keep: list[str] | None = None) -> DataFrame:
    """Lines -> every row with its ``reason``; good rows fully processed.

    ``id_cols`` identify a record: its key is then the same on every replay
    (an id, a place in a topic, or a file and a place in it).
    Without them (``[]``) each record gets a random key, so that equal lines
    stay apart. ``keep`` names more columns to carry along.

    The reference chain parse -> anonymise -> categorise -> key -> render as
    column replacements on one narrow projection over the parsed rows. Good
    rows carry ``row_key``, the anonymised ``ip``, the ``user_agent``
    category and the rendered ``record``; bad rows keep ``line`` and
    ``reason``. Batch jobs, the streaming job and the command line share it.
    """
    carried = [*id_cols, *(keep or [])]
    parsed = parse_access_log(lines.select(*carried, line), line)
    good = F.col("reason").isNull()
    key = row_key(*id_cols, line) if id_cols else random_row_key()
    out = parsed.select(
        *carried, line, "reason", F.when(good, key).alias("row_key"),
        F.when(good, anonymize("ip")).alias("ip"), "ts", "local_ts", "offset_min", "method", "resource",
        "status", "bytes", F.when(good, categorize_ua("user_agent")).alias("user_agent"))
    record = render_record(F.col("ip"), F.col("local_ts"), F.col("offset_min"), F.col("method"),
                           F.col("resource"), F.col("status"), F.col("bytes"), F.col("user_agent"))
    return out.withColumn("record", F.when(good, record))


def log_batch(spark: SparkSession, source: str, out: str, counter: Observation | None = None) -> None:
    """The batch job over log text files: rows by outcome in one pass, keyed by file and line number.

    Run again, on other splits or after a retry, it writes the same rows with the same keys.
    """
    write_split(process_lines(read_log_lines(spark, source), ["file", "line_no"]), out, counter=counter)


def replay_split(spark: SparkSession, source: str) -> int:
    """Bytes of a split that cuts the files elsewhere than a plain read does, into about ``REPLAY_CUTS`` times as many.

    It follows the plain read's splits, so the number of tasks, and of the files they write, doesn't
    grow faster than a plain read's. Only the files' lengths are read.
    """
    n, total, longest = spark.read.format("binaryFile").load(source).agg(F.count("length"), F.sum("length"), F.max("length")).first()
    if not n:
        return REPLAY_SPLIT
    plain = spark.read.text(source).rdd.getNumPartitions()
    return max(REPLAY_SPLIT, min(longest, total // max(1, plain)) // REPLAY_CUTS)


def log_batch_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records of the batch job over text files, found under the same key in a second run with other splits."""
    base = scratch_path(spark, "logbatch")
    log_lines(spark, sf_dir).select("line").write.text(f"{base}/in")
    log_batch(spark, f"{base}/in", f"{base}/first")
    again = spark.newSession()
    again.conf.set("spark.sql.files.maxPartitionBytes", str(replay_split(spark, f"{base}/in")))
    log_batch(again, f"{base}/in", f"{base}/second")
    cols = ["row_key", "ip", "ts", "method", "resource", "status", "bytes", "user_agent", "record"]
    first, second = (spark.read.schema(BATCH_SCHEMA).parquet(f"{base}/{run}").where(F.col("outcome") == "valid") for run in ("first", "second"))
    return first.select(*cols).join(second.select("row_key", F.col("line").alias("line")), "row_key").select(*cols[1:], "line")


def process_records(lines: DataFrame, id_cols: list[str], line: str = "line") -> DataFrame:
    """Good lines only, as processed records."""
    return valid_rows(process_lines(lines, id_cols, line)).select(
        *id_cols, "row_key", "ip", "ts", "method", "resource", "status", "bytes", "user_agent", "record")


def log_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each good record printed as ``ip time method resource status bytes agent``."""
    good = valid_rows(parsed_lines(spark, sf_dir))
    record = render_record(F.col("ip"), F.col("local_ts"), F.col("offset_min"), F.col("method"),
                           F.col("resource"), F.col("status"), F.col("bytes"), F.col("user_agent"))
    return good.select("event_id", record.alias("record"))


def log_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch log job: parse, anonymise, categorise, key, render."""
    return process_records(log_lines(spark, sf_dir), ["event_id"])
