"""Articles as key/value files of Hadoop jobs."""

from __future__ import annotations

import glob

from strandline.cli import main
from strandline.functions.text import tokenize
from strandline.plans.text import render_documents_dump
from strandline.sources.articles import read_article_pairs, write_article_pairs
from input_folders import SF001
from pyspark.sql import functions as F


def test_written_by_one_job_read_by_another(spark, tmp_dir):
    rows = [("a", "x y"), ("a", "x y"), ("", "tab\there\nand line"), ("é\U0001f600", "long " * 50_000), (None, None)]
    write_article_pairs(spark.createDataFrame(rows, "title string, text string").repartition(3), f"{tmp_dir}/pairs")
    head = open(sorted(glob.glob(f"{tmp_dir}/pairs/part-*"))[0], "rb").read(80)
    assert head[:3] == b"SEQ" and head.count(b"org.apache.hadoop.io.Text") == 2
    got = sorted(map(tuple, read_article_pairs(spark, f"{tmp_dir}/pairs").collect()))
    assert got == sorted((t or "", x or "") for t, x in rows)


def test_no_articles(spark, tmp_dir):
    write_article_pairs(spark.createDataFrame([], "title string, text string"), f"{tmp_dir}/pairs")
    df = read_article_pairs(spark, f"{tmp_dir}/pairs")
    assert df.columns == ["title", "text"] and df.count() == 0


def test_the_two_jobs_of_the_command_line(spark, tmp_dir):
    dump = render_documents_dump(spark, SF001)
    assert main(["dump-load", dump, f"{tmp_dir}/pairs", "--pairs"]) == 0
    assert main(["word-count", f"{tmp_dir}/pairs", f"{tmp_dir}/tsv", "--pairs"]) == 0
    words = read_article_pairs(spark, f"{tmp_dir}/pairs").select(F.explode(tokenize(F.col("text"))).alias("w"))
    assert spark.read.text(f"{tmp_dir}/tsv").count() == words.distinct().count()
