"""The query registry: one Spark callable and one DuckDB statement per query.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables (or data Spark derives from them). Each SQL string computes
the same result over the pre-registered views; it shares fixture values (log
pattern, agents, categories) with the query but none of its code.
Column names agree between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.plans import logs, metrics, sampling, streams, text
from strandline.plans.oracle_sql import LOGS, METRICS, TEXT_EXTRA

Query = Callable[[SparkSession, str], DataFrame]

# DuckDB form of the Java whitespace split (trailing empties dropped). Java's
# \s is [ \t\n\x0B\f\r]; the RE2 \s lacks the vertical tab, so the class is spelled out.
_WS = r"[ \t\n\x0B\f\r]"
_SQL_TOKENS = f"""CASE WHEN text = '' THEN ['']
       WHEN regexp_full_match(text, '{_WS}+') THEN []::VARCHAR[]
       ELSE regexp_split_to_array(regexp_replace(text, '{_WS}+$', ''), '{_WS}+') END"""

# Texts XML 1.0 can carry: no C0 control other than tab, line feed and
# carriage return, and no U+FFFE / U+FFFF (other pages are quarantined).
_SQL_XML_TEXT = r"NOT regexp_matches(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]')"

QUERIES: dict[str, Query] = {
    "word_count": text.word_count,
    "word_count_tsv": text.word_count_tsv,
    "doc_tokens": text.doc_tokens,
    "dump_load": text.dump_load,
    "dump_article_count": text.dump_article_count,
    "dump_word_count": text.dump_word_count,
    "dump_article_pairs": text.dump_article_pairs,
    "page_titles": text.page_titles,
    "log_lines": logs.log_lines,
    "log_parse": logs.log_parse,
    "log_quarantine": logs.log_quarantine,
    "log_anonymize": logs.log_anonymize,
    "log_ua_category": logs.log_ua_category,
    "log_ua_counts": logs.log_ua_counts,
    "log_keyed": logs.log_keyed,
    "log_render": logs.log_render,
    "log_process": logs.log_process,
    "log_batch_replayed": logs.log_batch_replayed,
    "report_fields": metrics.report_fields,
    "report_first_match": metrics.report_first_match,
    "utilisation": metrics.utilisation,
    "utilisation_all_clusters": metrics.utilisation_all_clusters,
    "utilisation_by_window": metrics.utilisation_by_window,
    "metric_points": metrics.metric_points,
    "stream_log_process": streams.stream_log_process,
    "stream_log_quarantine": streams.stream_log_quarantine,
    "stream_log_shards": streams.stream_log_shards,
    "stream_log_latest": streams.stream_log_latest,
    "stream_utilisation": streams.stream_utilisation,
    "stream_utilisation_all": streams.stream_utilisation_all,
    "weighted_assign": sampling.weighted_assign,
    "weighted_supplier": sampling.weighted_supplier,
}

ORACLE_SQL: dict[str, str] = {
    "word_count": f"""
SELECT word, count(*) AS n
FROM (SELECT unnest({_SQL_TOKENS}) AS word FROM documents)
GROUP BY word""",
    "word_count_tsv": f"""
SELECT word || chr(9) || CAST(count(*) AS VARCHAR) AS line
FROM (SELECT unnest({_SQL_TOKENS}) AS word FROM documents)
GROUP BY word""",
    "doc_tokens": f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(t, lambda x: x = '')) AS BIGINT) AS n_empty
FROM (SELECT doc_id, {_SQL_TOKENS} AS t FROM documents)""",
    "dump_load": f"""
SELECT source || '-' || CAST(doc_id AS VARCHAR) AS title, text FROM documents WHERE {_SQL_XML_TEXT}""",
    "dump_article_count": f"""
SELECT count(*) AS articles FROM documents WHERE {_SQL_XML_TEXT}""",
}
ORACLE_SQL.update(LOGS)
ORACLE_SQL.update(METRICS)
ORACLE_SQL.update(TEXT_EXTRA)
ORACLE_SQL["dump_word_count"] = ORACLE_SQL["word_count"].replace("FROM documents", f"FROM documents WHERE {_SQL_XML_TEXT}")
ORACLE_SQL["dump_article_pairs"] = ORACLE_SQL["dump_load"]
ORACLE_SQL["stream_log_process"] = ORACLE_SQL["log_process"]
ORACLE_SQL["stream_log_quarantine"] = ORACLE_SQL["log_quarantine"]
ORACLE_SQL["stream_log_shards"] = ORACLE_SQL["log_process"]
ORACLE_SQL["stream_log_latest"] = f"""
SELECT p.* FROM ({ORACLE_SQL["log_process"]}) p JOIN events e USING (event_id),
  (SELECT min(CAST(ts AS DATE)) AS low, max(CAST(ts AS DATE)) AS high FROM events)
WHERE CAST(e.ts AS DATE) >= low + CAST((high - low) // 2 AS INTEGER)"""
ORACLE_SQL["stream_utilisation"] = ORACLE_SQL["utilisation_by_window"]
