"""Aggregations: count per key (E1), ratio of sums (E3), first match.

All are declarative aggregates: Spark plans a partial aggregate before the
exchange (map-side combine), so a key holding a third of all rows sends one
partial row per task, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, key: str | Column, out: str = "n") -> DataFrame:
    """``(key, n)`` with a 64-bit count (no 32-bit wrap)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def pct_columns(df: DataFrame, num: str, den: str) -> DataFrame:
    """Add ``pct_x100`` and ``pct``: ``num/den`` in percent, cut at 2 decimals.

    ``(num*10000) div den`` in integers, so the quotient is truncated exactly
    as a ``scale=4`` calculator division would be (3 of 7 -> 42.85, not
    42.86); ``den = 0`` gives 0. ``pct`` is that value divided by 100, as DECIMAL(20,2).
    """
    return df.withColumn(
        "pct_x100",
        F.expr(f"coalesce((cast(`{num}` as bigint) * 10000) div nullif(cast(`{den}` as bigint), 0), 0)"),
    ).withColumn("pct", (F.col("pct_x100").cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,2)"))


def ratio_of_sums(df: DataFrame, keys: list[str | Column], num: str, den: str,
                  num_out: str | None = None, den_out: str | None = None) -> DataFrame:
    """Per key: ``sum(num)``, ``sum(den)`` and their truncated percentage."""
    num_out, den_out = num_out or num, den_out or den
    sums = df.groupBy(*keys).agg(F.sum(num).cast("bigint").alias(num_out),
                                 F.sum(den).cast("bigint").alias(den_out))
    return pct_columns(sums, num_out, den_out)


def with_silent(ratios: DataFrame, roster: DataFrame, keys: list[str], num: str, den: str) -> DataFrame:
    """``ratios`` (from :func:`ratio_of_sums`) plus a row of zeros for each row of ``roster`` without one.

    Keys that the roster lacks stay. The sums are one row a key by now, so only those move.
    """
    full = roster.select(*keys).distinct().join(ratios, keys, "full_outer")
    zero = F.lit(0).cast("bigint")
    return pct_columns(full.select(*keys, F.coalesce(num, zero).alias(num), F.coalesce(den, zero).alias(den)), num, den)


def first_by(df: DataFrame, keys: list[str], value: str, order: str, out: str | None = None) -> DataFrame:
    """Per key, ``value`` of the row with the smallest ``order`` (``grep -m 1``)."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(out or value))


def first_and_last_by(df: DataFrame, keys: list[str], value: str, order: str,
                      first_out: str, last_out: str) -> DataFrame:
    """Per key, ``value`` at the smallest and at the largest ``order``."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(first_out),
                                 F.max_by(value, order).alias(last_out))
