"""Reading the input tables.

Each table is one Parquet dataset ``<dir>/<name>.parquet``. Callers select
the columns they need right after the read, so the scan's ``ReadSchema``
holds only those and filters reach ``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


PARTITIONS = "strandline.input.partitions"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many partitions as the caller's setting :data:`PARTITIONS` names.

    Without the setting nothing happens: the scan's own splits are used. It is
    for tables stored as one row group, which a scan cannot split (the test
    tables); the input's size is never looked at.
    """
    n = df.sparkSession.conf.get(PARTITIONS, None)
    return df.repartition(int(n)) if n and not df.isStreaming else df
