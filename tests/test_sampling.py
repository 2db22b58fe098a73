"""Weight lists from a table: the alias table's shares are exact, long lists stay one literal."""

from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions import sampling
from strandline.functions.sampling import TWO32, alias_table, weighted_choice_from


@given(st.lists(st.integers(1, 10**9), min_size=1, max_size=60))
def test_every_value_gets_its_share(weights):
    n, total = len(weights), sum(weights)
    bounds, alias = alias_table(weights)
    share = [0] * n  # in units of 2**-32 of a slot
    for i, (b, a) in enumerate(zip(bounds, alias)):
        assert 0 <= b <= TWO32 and 0 <= a < n
        share[i] += b
        share[a] += TWO32 - b
    for w, s in zip(weights, share):  # a bound is rounded up by less than one unit
        assert abs(s - w * n * TWO32 / total) < n + 1


def test_ten_thousand_values_from_a_table(spark):
    weights = spark.range(10_000).select(F.concat(F.lit("v"), "id").alias("value"), (F.col("id") % 7).alias("weight"))
    df = spark.range(200_000, numPartitions=4).select("id", weighted_choice_from(F.col("id"), weights, 3).alias("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "CASE" not in plan.replace("CASE WHEN (", "", 1) and plan.count("*(") >= 1
    number = F.substring("v", 2, 9).cast("int")
    got = {r["w"]: r["n"] for r in df.groupBy((number % 7).alias("w")).agg(F.count("*").alias("n")).collect()}
    assert 0 not in got and set(got) == {1, 2, 3, 4, 5, 6}
    for w, n in got.items():
        assert abs(n / 200_000 - w / 21) < 0.01


def test_odd_lists(spark, monkeypatch):
    keys = spark.range(50)

    def values(rows):
        weights = spark.createDataFrame(rows, "value string, weight bigint")
        return {r[0] for r in keys.select(weighted_choice_from(F.col("id"), weights, 1)).collect()}

    assert values([]) == {None} and values([("a", 0), ("b", None)]) == {None}
    assert values([("a", 3)]) == {"a"} and values([("a", 1), ("a", 2), ("b", 0)]) == {"a"}
    assert values([('quote " and \\ and é', 1)]) == {'quote " and \\ and é'}
    monkeypatch.setattr(sampling, "MAX_VALUES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        values([("a", 1), ("b", 1)])
