"""Evaluate a projection once, below any filter on its result.

Catalyst pushes a filter beneath the projection that computes its columns by
substituting the expressions into the condition. For a parse step that means
the whole parse runs twice per row (once in the filter, once in the
projection), and the doubled expression tree can overflow the 64 KB method
limit of whole-stage codegen, which then falls back to interpreted rows.
Passing the row through a one-element ``inline`` generator keeps the
computed values as generator output: a filter on them stays above it, and
the plan remains one code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame) -> DataFrame:
    """Same rows and columns; later filters are not pushed below this point."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.select(F.inline(F.array(F.struct(*cols))))
