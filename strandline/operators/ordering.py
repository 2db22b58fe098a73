"""Key-partitioned output sorted inside each file (G1).

Hadoop's default output: rows hash-partitioned by key, each reducer file in
key byte order. ``repartition(n, key)`` after an aggregate on the same key
reuses that aggregate's exchange when the partition counts agree, so no
second shuffle is added; only the per-partition sort is. Spark compares
strings by their UTF-8 bytes, as Hadoop compares ``Text``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def key_partitioned_sorted(df: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``key`` (optionally into ``num_partitions``), sort within."""
    parted = df.repartition(num_partitions, key) if num_partitions else df.repartition(key)
    return parted.sortWithinPartitions(key)
