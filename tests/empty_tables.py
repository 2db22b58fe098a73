"""The input tables without rows."""

from __future__ import annotations

import os

import pyarrow.parquet as pq
from input_folders import SF001
from oracle import TABLES


def write_empty_tables(folder: str) -> str:
    for t in TABLES:
        table = pq.read_table(os.path.join(SF001, f"{t}.parquet"))
        pq.write_table(table.slice(0, 0), os.path.join(folder, f"{t}.parquet"))
    return folder
