"""strandline: text, access-log and cluster-metric pipelines on Spark DataFrames.

Every operator is a function that takes and returns a DataFrame (or a Column
expression), so the same code serves batch jobs and Structured Streaming.
Work runs inside Spark SQL expressions; no Python UDF is used on a hot path.

Layout:
    functions/  column expressions (tokenise, parse, anonymise, render, ...)
    sources/    readers and writers (tag-delimited scan, articles, TSV, streams, metrics)
    operators/  DataFrame -> DataFrame building blocks (quarantine split, sums, first match)
    plans/      the pipelines and the query registry used by ``__spark_entry__``
    streaming/  streaming jobs built from the same functions
"""

from strandline.functions.logs import (
    anonymize,
    categorize_ua,
    decode_line,
    parse_access_log,
    render_log_line,
    render_record,
    row_key,
)
from strandline.functions.metrics import cut_field, report_value
from strandline.functions.text import extract_title, tokenize, xml_escape
from strandline.operators.aggregate import count_per_key, first_by, pct_columns, ratio_of_sums
from strandline.operators.quarantine import quarantined_rows, valid_rows, write_split
from strandline.plans.logs import process_lines
from strandline.plans.text import count_words, load_dump
from strandline.session import get_spark, scale_settings, scratch_path
from strandline.sources.articles import read_articles, write_pages, write_tsv
from strandline.sources.xmldump import render_page, scan_fragments, write_dump

__all__ = [
    "anonymize", "categorize_ua", "count_per_key", "count_words", "cut_field", "decode_line",
    "extract_title", "first_by", "get_spark", "load_dump", "parse_access_log", "pct_columns",
    "process_lines", "quarantined_rows", "ratio_of_sums", "read_articles", "render_log_line",
    "render_page", "render_record", "report_value", "row_key", "scale_settings", "scan_fragments",
    "scratch_path", "tokenize", "valid_rows", "write_dump", "write_pages", "write_split", "write_tsv",
    "xml_escape",
]
