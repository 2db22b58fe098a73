"""Line include / exclude filters (C2): ``grep`` and ``grep -v`` on a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def include_lines(df: DataFrame, needle: str, col: str = "line") -> DataFrame:
    """Keep rows whose ``col`` contains ``needle`` (literal, case-sensitive)."""
    return df.where(F.col(col).contains(needle))


def exclude_lines(df: DataFrame, needle: str, col: str = "line") -> DataFrame:
    """Drop rows whose ``col`` contains ``needle``; NULL lines are dropped too."""
    return df.where(~F.col(col).contains(needle))
