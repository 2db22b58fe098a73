"""Log text files as lines with a place that no replay changes.

A line's place is its file and its number in the file. Spark reads a file in
blocks, so the number is the lines of all blocks before plus the line's place in its own
block. A first pass counts the lines of every block (one row a block leaves a
task); sums over a file's blocks give each block's first number, and lines look theirs
up by (file, block). Where splits fall changes the blocks but not the sums.

The blocks' numbers are sent to all tasks only when their count is below
``BLOCKS``; beyond it the join is Spark's choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCKS = 200_000  # blocks whose numbers are broadcast: about 40 MB


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, line)`` of text files; ``line_no`` counts from 0 in each file."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    # a task reads a block's lines in one run, so they follow the block's first id
    counted = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # a number a file and split: as many as splits, known before any line moves
    if raw.rdd.getNumPartitions() <= BLOCKS and len(raw.inputFiles()) <= BLOCKS:
        blocks = F.broadcast(blocks)
    return raw.join(blocks, ["file", "block"]).select(
        "file", (F.col("base") + F.col("at") - F.col("first")).alias("line_no"), "line")
