"""The training-data pipeline: documents to packed sequences.

Five stages, each an operator of ``strandline.llm`` at work on what the stage
before kept: documents the quality rules reject go; lines that an earlier
document has go, and documents left without any; one document of each SimHash
group stays; documents that hold a benchmark item go; the rest is packed. A
stage's rows are written as Parquet below ``spark.checkpoint.dir`` and read
again, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from strandline.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep; thresholds from the table ``labels``."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has."""
    return line_dedup.clean_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 4-word shingles, links at 4 bits or fewer."""
    return simhash.keep_first(docs, words=4, max_bits=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the table ``benchmark``."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences of 4096 tokens."""
    return packing.pack(docs, packing.word_bpe()).drop("text_key")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", pack),
]

#: SQL has neither the tokenizer nor the learned models; tests/llm/test_pipeline.py
#: holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
