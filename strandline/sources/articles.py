"""Key/value article tables (A2, A3) and the tab-separated text sink (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandline.operators.quarantine import concurrent_writers


def write_articles(df: DataFrame, path: str, counter: Observation | None = None) -> None:
    """Write ``(title, text)`` as Parquet; optionally count rows on the way.

    The counter rides on the write (``DataFrame.observe``): no second pass.
    """
    out = df.select("title", "text")
    if counter is not None:
        out = out.observe(counter, F.count(F.lit(1)).alias("articles"))
    out.write.mode("overwrite").parquet(path)


def write_pages(parsed: DataFrame, path: str, counter: Observation | None = None) -> None:
    """Write parsed pages in one pass, partitioned by outcome.

    Good pages land in ``outcome=valid`` as ``(title, text)``; bad ones in
    ``outcome=<reason>`` with the raw fragment kept for inspection. The
    counter gets ``articles`` and ``quarantined`` from the same pass.
    """
    good = F.col("reason").isNull()
    out = parsed.select("title", "text", F.when(~good, F.col("fragment")).alias("fragment"),
                        F.coalesce(F.col("reason"), F.lit("valid")).alias("outcome"))
    if counter is not None:
        out = out.observe(counter, F.count_if(F.col("outcome") == "valid").alias("articles"),
                          F.count_if(F.col("outcome") != "valid").alias("quarantined"))
    with concurrent_writers(parsed.sparkSession):
        out.write.mode("overwrite").partitionBy("outcome").parquet(path)


#: Columns of both table forms; the plain one has neither fragment nor outcome.
PAGE_SCHEMA = "title STRING, text STRING, fragment STRING, outcome STRING"


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Read ``(title, text)`` from :func:`write_articles` or :func:`write_pages` output.

    Of the partitioned form only the ``outcome=valid`` folder is read; a table
    without a page, which has no file to take a schema from, has no rows.
    """
    df = spark.read.schema(PAGE_SCHEMA).parquet(path)
    return df.where(F.coalesce(F.col("outcome"), F.lit("valid")) == "valid").select("title", "text")


def tsv_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key<TAB>value`` lines (Hadoop text output) in a column ``value``."""
    return df.select(F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string")).alias("value"))


def write_tsv(df: DataFrame, path: str, key: str, value: str) -> None:
    """Write ``key<TAB>value`` text lines, partition layout as given."""
    tsv_lines(df, key, value).write.mode("overwrite").text(path)


TEXT = "org.apache.hadoop.io.Text"  # class of both sides of a pair


def write_article_pairs(df: DataFrame, path: str) -> None:
    """Write ``(title, text)`` as key/value files of Hadoop jobs (``Text``, ``Text``); refuses an existing folder.

    The container and the codec are Spark's and Hadoop's own. The format has no nulls: a null is written as ''.
    Rows pass through Python a batch at a time; for tables that only Spark reads, :func:`write_articles` is the fast form.
    """
    pairs = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("title", "text")])
    pairs.rdd.map(tuple).saveAsNewAPIHadoopFile(
        path, "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat", TEXT, TEXT)


def read_article_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Read ``(title, text)`` from key/value files (``Text``, ``Text``), a task per split of a file."""
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path, TEXT, TEXT), "title STRING, text STRING")
