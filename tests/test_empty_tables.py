"""Every registered query over tables without rows: its usual columns, and what DuckDB says."""

from __future__ import annotations

import pytest
from empty_tables import write_empty_tables
from input_folders import SF001
from oracle import compare, duck

from strandline.plans.registry import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write_empty_tables(str(tmp_path_factory.mktemp("empty")))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_over_empty_tables(spark, folder, name):
    df = QUERIES[name](spark, folder)
    ok, message = compare(df, duck(folder), ORACLE_SQL[name])
    assert ok, message


@pytest.mark.parametrize("name", ["dump_load", "log_batch_replayed", "stream_log_process", "stream_utilisation_all"])
def test_columns_are_the_usual_ones(spark, folder, name):
    assert QUERIES[name](spark, folder).dtypes == QUERIES[name](spark, SF001).dtypes
