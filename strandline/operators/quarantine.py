"""Valid / quarantine split.

A parse step adds a ``reason`` column (NULL when the row is good). The split
keeps one parse: both outputs are filters over the same DataFrame, and a
writer can store them in one pass partitioned by outcome. ``fail_fast``
restores the stop-on-first-bad-record behaviour.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VALID = "valid"
OUTCOMES = 16  # files a task keeps open at once; above the number of outcomes


@contextmanager
def concurrent_writers(spark: SparkSession, n: int = OUTCOMES) -> Iterator[None]:
    """Let a write keep a file open per outcome, instead of sorting whole rows by it first.

    Beyond ``n`` outcomes in one task Spark sorts the rest, so the result is
    the same for any number of them.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def outcome(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Add ``outcome``: ``'valid'`` or the reason, for a partitioned write."""
    return df.withColumn("outcome", F.coalesce(F.col(reason), F.lit(VALID)))


def valid_rows(df: DataFrame, reason: str = "reason", fail_fast: bool = False) -> DataFrame:
    """Rows without a reason; with ``fail_fast`` a bad row fails the task."""
    if fail_fast:
        df = df.withColumn(
            reason,
            F.when(F.col(reason).isNotNull(),
                   F.raise_error(F.concat(F.lit("bad record: "), F.col(reason)))).otherwise(F.col(reason)),
        )
    return df.where(F.col(reason).isNull()).drop(reason)


def quarantined_rows(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows with a reason."""
    return df.where(F.col(reason).isNotNull())


def write_split(df: DataFrame, path: str, reason: str = "reason", fmt: str = "parquet",
                counter: Observation | None = None) -> None:
    """Write valid and quarantined rows in one pass, partitioned by outcome.

    With ``counter`` the numbers of ``valid`` and ``quarantined`` rows ride on
    the same write (``DataFrame.observe``), no second pass.
    """
    out = outcome(df, reason)
    if counter is not None:
        out = out.observe(counter, F.count_if(F.col("outcome") == VALID).alias("valid"),
                          F.count_if(F.col("outcome") != VALID).alias("quarantined"))
    with concurrent_writers(df.sparkSession):
        out.write.mode("overwrite").partitionBy("outcome").format(fmt).save(path)
