"""Weighted assignment of attributes over ``events``.

Each event gets one value of each attribute, drawn from weighted lists, and a
count below a bound, all from hashes of its id, so the assignment is
reproducible and needs no shuffle. The lists are the caller's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.sampling import bounded_uniform, hash32, weighted_choice, weighted_choice_from
from strandline.sources.tables import read_table

Weighted = dict[str, list[tuple[str, float]]]

#: The query's attributes; weights need not sum to anything.
EVENT_ATTRIBUTES: Weighted = {
    "channel": [("web", 5.0), ("app", 3.0), ("partner", 0.5)],
    "tier": [("basic", 6.0), ("plus", 3.0), ("pro", 1.0)],
    "priority": [("low", 2.0), ("normal", 5.0), ("high", 0.25)],
}
UNITS = 10000
WEIGHT_SALT = 5


def assign(df: DataFrame, key: str, attributes: Weighted, units: int | None = None) -> DataFrame:
    """Add a column per attribute, drawn from ``key``, and ``units`` in ``[0, units)``.

    Every column has a hash stream of its own (the salts 1, 2, ...).
    """
    k = F.col(key)
    cols = [weighted_choice(hash32(k, salt), items).alias(name) for salt, (name, items) in enumerate(attributes.items(), 1)]
    if units:
        cols.append(bounded_uniform(hash32(k, len(cols) + 1), units).cast("bigint").alias("units"))
    return df.select("*", *cols)


def weighted_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select("event_id")
    return assign(events, "event_id", EVENT_ATTRIBUTES, UNITS)


def weighted_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier for each event, drawn with the suppliers' balances as weights (a list of any length from a table)."""
    weights = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("value"), F.floor(F.abs("s_acctbal")).cast("bigint").alias("weight"))
    events = read_table(spark, sf_dir, "events").select("event_id")
    return events.select("event_id", weighted_choice_from(F.col("event_id"), weights, WEIGHT_SALT).alias("s_suppkey"))
