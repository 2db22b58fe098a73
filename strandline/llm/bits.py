"""A bit set of fixed size over 64-bit hashes: which rows of a scan can matter at all.

The set is built by Spark (one word of 64 bits a row, merged by ``bit_or``) and
has ``2 ** BITS`` bits whatever the data, so the driver and each task hold 8 MB.
A row whose bit is not set is certainly absent; one whose bit is set may be, so
an exact join always follows. With more values than bits it only filters less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26


def _word(hash_: Column) -> Column:
    return F.shiftright(hash_.bitwiseAND(F.lit((1 << BITS) - 1)), 6).cast("int")


def _bit(hash_: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), hash_.bitwiseAND(F.lit(63)).cast("int"))


def bit_words(hashes: DataFrame, col: str) -> DataFrame:
    """The bits of a column of 64-bit hashes: ``(w, b)``, a row for each word of 64 bits that isn't zero."""
    words = hashes.select(_word(F.col(col)).alias("w"), _bit(F.col(col)).alias("b"))
    return words.groupBy("w").agg(F.bit_or("b").alias("b"))


def flagged(df: DataFrame, hash_: Column, words: DataFrame, name: str = "possible") -> DataFrame:
    """``df`` and whether the hash of each row may be among those of ``words`` (from :func:`bit_words`).

    ``words`` has ``2 ** (BITS - 6)`` rows at most, so it is broadcast: no row of ``df`` moves.
    """
    words = words.select(F.col("w").alias("_w"), F.col("b").alias("_b"))
    at = df.withColumn("_h", hash_)
    hit = F.coalesce(F.col("_b").bitwiseAND(_bit(F.col("_h"))) != 0, F.lit(False))
    return at.join(F.broadcast(words), _word(F.col("_h")) == F.col("_w"), "left").withColumn(name, hit).drop("_h", "_w", "_b")


def bit_set(df: DataFrame, col: str) -> np.ndarray:
    """The bits of a column of 64-bit hashes, as ``2 ** BITS / 64`` unsigned words."""
    found = bit_words(df, col).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().view(np.uint64)
    return out


def has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set."""
    low = values.view(np.uint64) & np.uint64((1 << BITS) - 1)
    return (bits[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def keep_possible(df: DataFrame, col: str, bits: np.ndarray) -> DataFrame:
    """Rows whose hash in ``col`` may be in the set."""
    shared = df.sparkSession.sparkContext.broadcast(bits)
    at = df.columns.index(col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(has(shared.value, b.column(at).to_numpy())))

    return df.mapInArrow(run, df.schema)
