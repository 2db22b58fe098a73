"""Line deduplication within one word edit, by a deletion-neighbourhood join.

A line is its words, white space aside. It is removed when an earlier line of
the table, by (document id, line number), is equal to it or one word edit away
(a word replaced, added or missing); the earliest stays. Blank lines and lines
under ``MIN_WORDS`` words always stay; one edit counts from ``NEAR_WORDS`` words
on, where it leaves seven words in eight alike.

Every line emits the hash of itself and of each variant with one word deleted.
Lines with an equal variant are joined, and the distance is verified on the
words. Variants are only formed for lines that can have a partner: two
sequences one edit apart share at least their first or their last half, so
each line first emits hashes of its halves (two to four keys), and a line none
of whose keys is shared cannot match. No line with a partner is lost by that.

Equal variants never become all pairs: lines that lost a word at the same place
are all one edit apart, so the smallest of such a group stands for it, and a
line equal to the variant itself is unique. Groups are folded by partial
aggregates before any row moves, and the joins are ones Spark splits when a key
is hot.

Defined cases: a null text has no lines; documents with a null id come last;
rows with the same id are separate texts, and a row repeated with id and text
is the same occurrence, so its lines don't remove each other; an empty table
gives no rows; other columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.bits import bit_words, flagged
from strandline.llm.common import ship, stored, table, text_key, with_rows, words_of
from strandline.operators.barrier import evaluate_once

MIN_WORDS = 3
NEAR_WORDS = 8
_LAST = 2**63 - 1


def occurrences(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` -> one row per line of at least ``MIN_WORDS`` words, with its hashes; no text."""
    # a document's key once, not for each of its lines; Spark splits three times for an explode that isn't outer
    each = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.split("text", "\n").alias("ls"))
    lines = each.select("doc_id", "text_key", F.posexplode_outer("ls").alias("line_no", "line"))
    # words joined by single spaces, so that a line's first or last words are a piece of one string
    odd = reduce(or_, [F.contains("line", F.lit(x)) for x in ("  ", "\t", "\x0b", "\x0c", "\r")])
    flat = F.when(odd, F.regexp_replace("line", r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]", " ")).otherwise(F.col("line"))
    lines = lines.select("doc_id", "text_key", "line_no", F.trim(flat).alias("w"))
    lines = evaluate_once(lines.withColumn("n", F.octet_length("w") - F.octet_length(F.replace("w", F.lit(" "))) + 1))
    short, long = F.floor(F.col("n") / 2).cast("int"), F.floor((F.col("n") + 1) / 2).cast("int")
    ends = lambda k: F.call_function("substring_index", F.col("w"), F.lit(" "), k)
    halves = F.array_distinct(F.array(
        *[F.xxhash64(F.lit("head"), ends(k)) for k in (short, long)],
        *[F.xxhash64(F.lit("tail"), ends(-k)) for k in (short, long)]))
    return lines.where(F.col("n") >= MIN_WORDS).select(
        "doc_id", "text_key", "line_no", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"),
        F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"), F.when(F.col("n") >= NEAR_WORDS, halves).alias("halves"))


def _variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes of a line and of its one-word deletions; ``at`` is the deleted word, -1 for none."""
    base = 0x9E3779B97F4A7C15
    for pdf in batches:
        out, sizes = [], []
        for words in pdf["wh"]:
            x = np.asarray(words, dtype=np.int64).view(np.uint64)
            n = len(x)
            none, power = np.zeros(1, np.uint64), np.full(n + 1, base, np.uint64)
            power[0] = 1
            power = np.multiply.accumulate(power)
            with np.errstate(over="ignore"):
                # head[i]: words before i at their places; moved[i]: words after i, each one place down
                head = np.concatenate((none, np.cumsum(x * power[:n], dtype=np.uint64)))
                moved = np.concatenate((np.cumsum((x[1:] * power[: n - 1])[::-1], dtype=np.uint64)[::-1], none))
                keys = np.concatenate((head[n:], head[:n] + moved))
                keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
                keys[0] ^= np.uint64(n)
                keys[1:] ^= np.uint64(n - 1)
            out.append(keys.view(np.int64))
            sizes.append(n + 1)
        if out:
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.arange(len(row)) - np.repeat(np.cumsum([0, *sizes[:-1]]), sizes) - 1
            columns = {c: pdf[c].to_numpy()[row] for c in ("h1", "doc", "line_no")}
            yield pd.DataFrame({"v": np.concatenate(out), "at": at.astype(np.int32), **columns})


def within_one(a: F.Column, b: F.Column) -> F.Column:
    """Whether two word arrays are at most one word edit apart."""
    la, lb = F.size(a), F.size(b)
    least = F.least(la, lb)
    spot = F.array_position(F.zip_with(F.slice(a, 1, least), F.slice(b, 1, least), lambda x, y: x != y), True)
    first = F.when(spot > 0, spot).otherwise(least + 1).cast("int")  # first differing place
    rest = lambda c, n, skip: F.slice(c, first + skip, F.greatest(n - first - skip + 1, F.lit(0)))
    return (F.when(la == lb, rest(a, la, 1) == rest(b, lb, 1))
            .when(la == lb + 1, rest(a, la, 1) == rest(b, lb, 0))
            .when(lb == la + 1, rest(a, la, 0) == rest(b, lb, 1)).otherwise(False))


def removals(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, text_key, line_no, near)`` for every line to remove."""
    ship(docs.sparkSession)
    every = stored(occurrences(docs), "lines")
    place = F.struct("doc", "line_no", "h1")
    lines = every.groupBy("h1", "h2").agg(
        F.min(F.struct("doc", "line_no", "text_key")).alias("first"), F.count("*").alias("times"), F.first("halves").alias("halves"))
    # lines with a half in common with another line
    lines = stored(lines, "lines-distinct")
    halves = lines.where("halves IS NOT NULL").select("h1", "h2", "first", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    maybe = stored(halves.join(shared, "half", "left_semi").select("h1", "h2", "first").distinct(), "lines-maybe")
    # their words, from the place of their first occurrence (a repeated
    # row gives a line twice, which changes no minimum below)
    at = F.xxhash64("doc", "text_key", "line_no")
    places = bit_words(maybe.select(F.xxhash64("first.doc", "first.text_key", "first.line_no").alias("at")), "at")
    d = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), text_key(F.col("text")).alias("text_key"), "text")
    each = d.select("doc", "text_key", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    # only lines whose place may be wanted leave the scan; the join then decides
    found = (flagged(each, at, places).where("possible")
             .select("doc", "text_key", "line_no", "line"))
    spots = maybe.select("h1", "h2", F.col("first.doc").alias("doc"), F.col("first.line_no").alias("line_no"),
                         F.col("first.text_key").alias("text_key"))
    texts = stored(found.join(spots, ["doc", "text_key", "line_no"]).select("h1", "h2", "doc", "line_no", words_of(F.col("line")).alias("w")), "lines-words")
    keyed = texts.select("h1", "doc", "line_no", F.transform("w", lambda x: F.xxhash64(x)).alias("wh"))
    variants = stored(keyed.mapInPandas(_variants, "v long, at int, h1 long, doc long, line_no int"), "lines-variants")
    # the smallest line of each (variant, deleted place); groups of one say nothing
    cut = variants.where("at >= 0")
    groups = cut.groupBy("v", "at").agg(F.min(place).alias("m"), F.count("*").alias("n")).where("n > 1")
    beside = cut.join(groups, ["v", "at"]).select(place.alias("t"), "m")
    whole = variants.where("at < 0").select("v", place.alias("whole"))
    across = cut.select("v", place.alias("cut")).join(whole, "v").select(
        F.greatest("cut", "whole").alias("t"), F.least("cut", "whole").alias("m"))
    best = beside.union(across).where("m < t").groupBy("t").agg(F.min("m").alias("m"))
    # verify on the words
    left = texts.select(place.alias("t"), F.col("h2"), F.col("w").alias("a"))
    right = texts.select(place.alias("m"), F.col("w").alias("b"))
    near = best.join(left, "t").join(right, "m").where(within_one(F.col("a"), F.col("b"))).select(F.col("t.h1").alias("h1"), "h2")
    near = stored(near.distinct(), "lines-near")
    # back to occurrences: only lines that have something to remove
    verdict = (lines.select("h1", "h2", "first", "times").join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
               .where(F.col("near") | (F.col("times") > 1)))
    at = F.struct("doc", "line_no", "text_key")
    later = F.struct("doc", "line_no") > F.struct("first.doc", "first.line_no")
    return (every.join(verdict, ["h1", "h2"]).where(F.col("near") | (later & (at != F.col("first"))))
            .select("doc_id", "text_key", "line_no", (~later).alias("near")).distinct())


def _left(docs: DataFrame) -> DataFrame:
    """``row`` of each document with what is left of its text, and counts."""
    gone = stored(removals(docs.select("doc_id", "text")), "lines-gone")
    gone = gone.groupBy("doc_id", "text_key").agg(
        F.collect_list("line_no").alias("gone"), F.sum((~F.col("near")).cast("long")).alias("n_exact"),
        F.sum(F.col("near").cast("long")).alias("n_near"))
    gone = gone.select(F.col("doc_id").alias("_id2"), F.col("text_key").alias("_key2"), "gone", "n_exact", "n_near")
    # documents that lost nothing for certain stay where they are; the others meet what they lost
    every = flagged(with_rows(docs), F.xxhash64("_id", "_key"), bit_words(gone.select(F.xxhash64("_id2", "_key2").alias("at")), "at"))
    lost = every.where("possible").join(gone, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")), "left")
    d = lost.unionByName(every.where("NOT possible"), allowMissingColumns=True)
    lines = F.split("row.text", "\n")
    kept = F.filter(lines, lambda x, i: ~F.array_contains("gone", i))
    long = lambda x: F.size(words_of(x)) >= MIN_WORDS
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return d.select(
        "row", F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        count(F.size(F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))).alias("n_lines"),
        count(F.col("n_exact")).alias("n_exact"), count(F.col("n_near")).alias("n_near"),
        (F.col("gone").isNotNull() & (F.size(F.filter(kept, long)) == 0)).alias("copied"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, text, n_lines, n_exact, n_near, copied)``, one row per input row.

    ``text`` is rid of its removed lines; ``n_lines`` counts lines with a word.
    ``copied``: lines were removed and none of ``MIN_WORDS`` words is left.
    """
    return _left(docs).select("row.doc_id", "text", "n_lines", "n_exact", "n_near", "copied")


def clean_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) without removed lines and without documents that were copies throughout; ``n_chars`` follows."""
    d = _left(docs).where("NOT copied")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return d.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line deduplication leaves of every document."""
    d = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_exact", "n_near", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


#: Equal lines by their words; near ones among lines that share their first or
#: last half, compared word by word.
OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line_no, ls[i] AS line, regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i)),
worded AS (SELECT *, array_to_string(w, ' ') AS k, len(w) AS n FROM lines WHERE len(w) >= 3),
firsts AS (SELECT k, min((doc_id, line_no)) AS f, any_value(w) AS w, any_value(n) AS n FROM worded GROUP BY k),
halves AS (
  SELECT DISTINCT k, f, w, n, unnest(['h' || array_to_string(w[1:n // 2], ' '), 'h' || array_to_string(w[1:(n + 1) // 2], ' '),
    't' || array_to_string(w[n - n // 2 + 1:n], ' '), 't' || array_to_string(w[n - (n + 1) // 2 + 1:n], ' ')]) AS half
  FROM firsts WHERE n >= 8),
pairs AS (
  SELECT DISTINCT a.k, a.w AS wa, b.w AS wb FROM halves a JOIN halves b ON a.half = b.half AND b.f < a.f AND abs(a.n - b.n) <= 1),
near AS (
  SELECT DISTINCT k FROM pairs WHERE CASE
    WHEN len(wa) = len(wb) THEN len(list_filter(range(1, len(wa) + 1), lambda p: wa[p] <> wb[p])) <= 1
    WHEN len(wa) > len(wb) THEN len(list_filter(range(1, len(wa) + 1), lambda p: list_concat(wa[1:p - 1], wa[p + 1:len(wa)]) = wb)) > 0
    ELSE len(list_filter(range(1, len(wb) + 1), lambda p: list_concat(wb[1:p - 1], wb[p + 1:len(wb)]) = wa)) > 0 END),
judged AS (
  SELECT l.doc_id, l.line_no, l.line, len(l.w) > 0 AS worded,
    coalesce((l.doc_id, l.line_no) > f.f, false) AS exact,
    f.f IS NOT NULL AND (l.doc_id, l.line_no) = f.f AND near.k IS NOT NULL AS near
  FROM lines l LEFT JOIN worded x ON l.doc_id = x.doc_id AND l.line_no = x.line_no
  LEFT JOIN firsts f ON x.k = f.k LEFT JOIN near ON near.k = x.k)
SELECT doc_id, CAST(count(*) FILTER (WHERE worded) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE exact) AS BIGINT) AS n_exact,
  CAST(count(*) FILTER (WHERE near) AS BIGINT) AS n_near,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT exact AND NOT near), '')) AS text_sha256
FROM judged GROUP BY doc_id"""
