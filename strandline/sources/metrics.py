"""Metric point sink.

A point is ``(metric, namespace, unit, time, value, dimensions)``: ``time``
when it was taken, ``value`` a DECIMAL(20,2), the dimensions a string map
(``Cluster -> name``). Points are stored as Parquet partitioned by metric and
run: a reader of one metric prunes the others, and a run that is repeated
replaces its own points instead of adding them again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINT_SCHEMA = ("namespace STRING, unit STRING, time TIMESTAMP_NTZ, value DECIMAL(20,2), "
                "dimensions MAP<STRING, STRING>, metric STRING, run STRING")


def to_points(df: DataFrame, run: str, time: dt.datetime) -> DataFrame:
    """Flat ``(metric, namespace, unit, value, dim_name, dim_value)`` -> point schema."""
    return df.select("namespace", "unit", F.lit(time).cast("timestamp_ntz").alias("time"),
                     F.col("value").cast("decimal(20,2)").alias("value"),
                     F.create_map("dim_name", "dim_value").alias("dimensions"),
                     "metric", F.lit(run).alias("run"))


def parse_dimensions(spec: str) -> F.Column:
    """``"Cluster=a,Env=b"`` -> map column, as the command-line form writes them."""
    return F.str_to_map(F.lit(spec), F.lit(","), F.lit("="))


def write_metrics(df: DataFrame, path: str, run: str, time: dt.datetime) -> None:
    """Store the points of one run; points of the same metric and run from before are replaced."""
    (to_points(df, run, time).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("metric", "run").parquet(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POINT_SCHEMA).parquet(path)
