"""The streaming log processor.

records -> decode -> parse -> anonymise -> categorise -> key, with the same
DataFrame functions as the batch job, then one write per micro-batch into
a folder, good and quarantined rows together, partitioned by outcome, which is
then put on the sink's list of committed folders (:mod:`manifest`).
Progress lives in the checkpoint; a restart resumes from the last committed
batch, and a replayed batch's folder takes the place of the earlier one on
the list: readers see each batch whole and once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.functions.logs import decode_line
from strandline.operators.quarantine import concurrent_writers, outcome
from strandline.plans.logs import BATCH_SCHEMA, process_lines
from strandline.streaming.manifest import Manifest, begin, commit_batch, fresh_folder, read_committed


def process_stream(records: DataFrame, id_cols: list[str] | None = None) -> DataFrame:
    """Raw ``(value BINARY, ...)`` records -> processed rows with ``reason``.

    Good rows carry ``row_key, ip`` (anonymised), ``user_agent`` (category)
    and ``record`` (rendered); bad rows keep their line and reason. Stateless
    and narrow: every micro-batch is processed where it is read.
    """
    if id_cols is None:
        # what identifies a record: our file records carry event_id, Kafka
        # records their position, other records their place in a file where the
        # source tells it; with none of these, every record gets a random key
        places = [["event_id"], ["topic", "partition", "offset"], ["file", "row"]]
        id_cols = next((p for p in places if set(p) <= set(records.columns)), [])
    lines = records.select(*id_cols, decode_line("value").alias("line"))
    return outcome(process_lines(lines, id_cols))


def _batch_writer(path: str, fmt: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        manifest = Manifest(batch.sparkSession, path)
        if fmt == "text":
            target = f"{path}/batch={batch_id}"
            # the reference layout: one folder per batch of ``key<TAB>record``
            # lines; quarantined rows go to a sibling folder. The batch is
            # cached for the two writes so that it is parsed once; a lost
            # block is parsed again.
            batch.persist()
            try:
                (batch.where(F.col("outcome") == "valid")
                 .select(F.concat_ws("\t", "row_key", "record").alias("value"))
                 .write.mode("overwrite").text(target))
                (batch.where(F.col("outcome") != "valid").drop("outcome")
                 .write.mode("overwrite").parquet(f"{path}/quarantine/batch={batch_id}"))
            finally:
                batch.unpersist()
        else:
            folder = fresh_folder(manifest, batch_id)
            with concurrent_writers(batch.sparkSession):
                batch.write.partitionBy("outcome").format(fmt).save(f"{path}/{folder}")
            commit_batch(manifest, batch_id, folder, batch.schema)
    return write


def write_log_stream(processed: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                     interval_ms: int | None = None, available_now: bool = False,
                     query_name: str | None = None) -> StreamingQuery:
    """Start the sink: one folder ``batch=<id>`` per micro-batch under ``path``.

    ``fmt="parquet"``: each batch folder holds all rows, partitioned by
    ``outcome``, and counts once it is on the list of committed folders (read with
    :func:`read_processed`, merged by :func:`manifest.compact`). ``fmt="text"``: each batch folder holds ``key<TAB>record``
    lines of the good rows (read them as ``path/batch=*``), and the
    quarantined rows go to ``path/quarantine/batch=<id>`` as Parquet.

    ``interval_ms`` sets a processing-time trigger (the batch interval);
    ``available_now`` drains what is there in bounded batches and stops.
    """
    if fmt != "text":
        begin(Manifest(processed.sparkSession, path), processed.schema)  # readable before its first batch
    w = processed.writeStream.foreachBatch(_batch_writer(path, fmt)).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval_ms:
        w = w.trigger(processingTime=f"{int(interval_ms)} milliseconds")
    return w.start()


def preview(stream: DataFrame, n: int = 10, interval_ms: int | None = None) -> StreamingQuery:
    """Print the first ``n`` rows of every micro-batch on the driver console.

    ``show(n)`` fetches only the rows it prints (partitions are scanned
    until ``n + 1`` rows are found). Spark's ``console`` sink would instead
    send every row of the batch to the driver before printing.
    """
    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"-------- batch {batch_id} --------")
        batch.show(n, truncate=False)

    w = stream.writeStream.foreachBatch(show)
    if interval_ms:
        w = w.trigger(processingTime=f"{int(interval_ms)} milliseconds")
    return w.start()


class StreamCut(RuntimeError):
    """A bounded drain was stopped before it had read everything."""


def drain(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until a bounded query (``availableNow``) has read everything.

    There is no deadline unless the caller gives one, and hitting it raises
    :class:`StreamCut`: what the sink then holds is not the whole result.
    """
    ended = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if timeout_s is not None and not ended:
        query.stop()
        raise StreamCut(f"stopped after {timeout_s} s with input left")
    if query.exception() is not None:
        raise query.exception()


def run_for(query: StreamingQuery, seconds: float | None = None) -> None:
    """Run an unbounded query until it is stopped elsewhere, or for some time; then stop it cleanly."""
    if seconds is None:
        query.awaitTermination()
    else:
        query.awaitTermination(seconds)
    if query.isActive:
        query.stop()
    if query.exception() is not None:
        raise query.exception()


def read_outcomes(spark: SparkSession, path: str, schema: str = BATCH_SCHEMA) -> DataFrame:
    """All rows of a log sink with their ``outcome``: a stream's committed folders, or a batch job's folder.

    A stream's rows have the schema its list names; a batch job's ``schema``.
    """
    rows = read_committed(spark, path)
    return spark.read.schema(schema).parquet(path) if rows is None else rows


def read_processed(spark: SparkSession, path: str, which: str = "valid", schema: str = BATCH_SCHEMA) -> DataFrame:
    """The rows of one outcome (``valid`` or a reason)."""
    return read_outcomes(spark, path, schema).where(F.col("outcome") == which)
