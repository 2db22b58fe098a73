"""Node and storage reports as text files (the output of cluster status commands).

Layout: ``<root>/cluster=<name>/node=<id>/<file>`` for node reports and
``<root>/cluster=<name>/<file>`` for storage reports; each file is one
report, small. Every file is read whole (``wholetext``), so line order and
line numbers come from the file itself, and cut into ``(line_no, line)``
with ``posexplode``. Files are many and small, so parallelism comes from
their number; no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """``(cluster, [node,] lines)``: one row per report file, its lines in order."""
    files = spark.read.text(path, wholetext=True)  # the keyword, or text() resets it
    keys = [c for c in ("cluster", "node") if c in files.columns]
    body = F.regexp_replace(F.col("value"), r"\r?\n$", "")
    return files.select(*[F.col(k).cast("string").alias(k) for k in keys],
                        F.split(body, r"\r?\n").alias("lines"))


def read_report_files(spark: SparkSession, path: str) -> DataFrame:
    """``(cluster, [node,] line_no, line)`` from a folder of report files.

    Partition folders (``cluster=``, ``node=``) become columns. A final
    newline does not make an extra empty line; ``\\r\\n`` line ends are cut
    like ``\\n``.
    """
    files = spark.read.text(path, wholetext=True)  # the keyword, or text() resets it
    keys = [c for c in ("cluster", "node") if c in files.columns]
    body = F.regexp_replace(F.col("value"), r"\r?\n$", "")
    return files.select(*[F.col(k).cast("string").alias(k) for k in keys],
                        F.posexplode(F.split(body, r"\r?\n")).alias("line_no", "line"))

