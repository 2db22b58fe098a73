"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strandline

from strandline.session import checkpoint_root, scratch_path

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of an input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, for tasks that run its Python code."""
    sc = spark.sparkContext
    if getattr(sc, "_strandline_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(strandline.__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="strandline-ship-"), "strandline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(os.path.join(root, "strandline")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), root))
    sc.addPyFile(path)
    sc._strandline_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below ``spark.checkpoint.dir`` for files other than tables."""
    checkpoint_root(spark)
    return scratch_path(spark, name)


def words_of(text: Column) -> Column:
    """The words of a text as an array (null text: empty array)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """64-bit key that tells rows of one document id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def with_rows(docs: DataFrame) -> DataFrame:
    """``row`` (all columns, whatever their names), ``_id``, ``_key`` of each document."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), text_key(F.col("text")).alias("_key"))


def matching(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose ``(doc_id, text_key)`` is (``left_semi``) or is not (``left_anti``) in ``found``."""
    f = found.select(F.col("doc_id").alias("_id2"), F.col("text_key").alias("_key2"))
    d = with_rows(docs)
    return d.join(f, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")), how).select("row.*")
