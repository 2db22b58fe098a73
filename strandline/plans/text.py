"""Text pipelines: dump loading (A1, B1, C1, E2, A2) and word count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandline.functions.text import extract_title, tokenize
from strandline.functions.xml import extract_first_elements
from strandline.operators.aggregate import count_per_key
from strandline.operators.barrier import evaluate_once
from strandline.operators.ordering import key_partitioned_sorted
from strandline.operators.quarantine import valid_rows
from strandline.session import scratch_path
from strandline.sources.articles import read_article_pairs, read_articles, tsv_lines, write_article_pairs, write_pages
from strandline.sources.tables import read_table, spread
from strandline.sources.xmldump import render_page, scan_fragments, write_dump

# ---------------------------------------------------------------- dump load


def parse_pages(fragments: DataFrame) -> DataFrame:
    """Fragments -> ``(title, text, reason, fragment)``; ``reason`` NULL when good.

    Reasons: ``bad_xml`` (not well-formed), ``no_title``, ``no_text`` (the
    element is missing), ``unclosed_page`` (a head without an end tag, from
    the scan). Map-only: no shuffle.
    """
    # a record gives its page and, if it has one, the head of an unclosed page
    # before it: one row each out of the same scan
    page = F.struct(F.col("fragment").alias("fragment"), F.lit(False).alias("unclosed"))
    head = F.struct(F.col("unclosed_head").alias("fragment"), F.lit(True).alias("unclosed"))
    rows = fragments.select(F.inline(F.when(F.col("unclosed_head").isNull(), F.array(page)).otherwise(F.array(head, page))))
    rows = rows.withColumn("page", F.when(~F.col("unclosed"), F.col("fragment")))
    parsed = extract_first_elements(rows, "page", ["title", "text"])
    return evaluate_once(parsed.select(
        F.when(~F.col("unclosed"), F.col("title")).alias("title"),
        F.when(~F.col("unclosed"), F.col("text")).alias("text"), "fragment",
        F.when(F.col("unclosed"), F.lit("unclosed_page"))
        .when(~F.col("ok"), F.lit("bad_xml"))
        .when(F.col("n_title") == 0, F.lit("no_title"))
        .when(F.col("n_text") == 0, F.lit("no_text")).alias("reason"),
    ))


def load_dump(spark: SparkSession, path: str) -> DataFrame:
    """Scan a dump and extract ``(title, text, reason, fragment)`` per page."""
    return parse_pages(scan_fragments(spark, path))


def articles(parsed: DataFrame, fail_fast: bool = False) -> DataFrame:
    """Good pages only, as ``(title, text)``; ``fail_fast`` fails on the first bad page."""
    return valid_rows(parsed, fail_fast=fail_fast).select("title", "text")


def render_documents_dump(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Write ``documents`` as an XML dump below the checkpoint root; return its path.

    Title ``{source}-{doc_id}``, text the document text. One file per input
    split, written JVM-side. ``root`` wraps each file in a root
    element (an Arrow pass in Python); the loader does not need it.
    """
    # no spread here: escaping is a few literal replaces, cheaper than a
    # shuffle, and the text file written is split for the load anyway
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    pages = docs.select(render_page(F.concat_ws("-", "source", F.col("doc_id").cast("string")), F.col("text"))
                        .alias("page"))
    path = scratch_path(spark, "dump")
    write_dump(pages, path, root=root)
    return path


def dump_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render the dump, load it: ``(title, text)`` per good page."""
    return articles(load_dump(spark, render_documents_dump(spark, sf_dir)))


def dump_load_to_table(spark: SparkSession, dump_path: str, out_path: str) -> int:
    """The loader job: dump in, page table out; returns the article count.

    One pass writes good articles (``outcome=valid``) and quarantined pages
    (``outcome=<reason>``); both counts ride on that write.
    """
    counter = Observation("pages")
    write_pages(load_dump(spark, dump_path), out_path, counter)
    return int(counter.get["articles"])


def dump_article_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in the table the loader wrote: ``(articles)``; the job's own report counts on the write."""
    dump = render_documents_dump(spark, sf_dir)
    table = scratch_path(spark, "articles")
    dump_load_to_table(spark, dump, table)
    return read_articles(spark, table).agg(F.count(F.lit(1)).alias("articles"))


# ---------------------------------------------------------------- word count


def words(texts: DataFrame, col: str = "text") -> DataFrame:
    """One row per token: ``word``.

    The tokenizer stays inside ``explode``: computed in a projection of its
    own, Spark would infer a ``size(tokens) > 0`` filter and push it below
    any exchange, tokenizing every text twice.
    """
    return texts.select(F.explode(tokenize(F.col(col))).alias("word"))


def count_words(texts: DataFrame, col: str = "text") -> DataFrame:
    """``(word, n)``: partial count per task, one exchange on ``word``, final count."""
    return count_per_key(words(texts, col), "word", "n")


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word count over the document texts."""
    return count_words(spread(read_table(spark, sf_dir, "documents").select("text")))


def word_count_articles(spark: SparkSession, articles_path: str) -> DataFrame:
    """Word count over an article table written by the loader."""
    return count_words(read_articles(spark, articles_path))


def dump_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-job chain: dump -> loader -> article table -> word count job."""
    dump = render_documents_dump(spark, sf_dir)
    table = scratch_path(spark, "articles")
    dump_load_to_table(spark, dump, table)
    return word_count_articles(spark, table)


def dump_article_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loader's articles through key/value files of Hadoop jobs: written by one job, read back by the next."""
    path = scratch_path(spark, "article_pairs")
    write_article_pairs(dump_load(spark, sf_dir), path)
    return read_article_pairs(spark, path)


def word_count_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``word<TAB>n`` files hash-partitioned and sorted by word; read back ``line``."""
    counts = key_partitioned_sorted(word_count(spark, sf_dir), "word")
    path = scratch_path(spark, "wordcount_tsv")
    tsv_lines(counts, "word", "n").write.mode("overwrite").text(path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: token count and empty-token count.

    The tokenizer can only produce an empty token in first place (a leading
    blank run, or the one token of an empty text), so the empty count is a
    test of the first token; no per-element lambda.
    """
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    toks = docs.select("doc_id", tokenize(F.col("text")).alias("t"))
    return toks.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.coalesce((F.get("t", 0) == F.lit("")).cast("bigint"), F.lit(0).cast("bigint")).alias("n_empty"),
    )


# ---------------------------------------------------------------- page titles


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ``<title>`` of each raw web page, references decoded, NULL without one: ``(page_id, title)``."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", extract_title("html").alias("title"))
