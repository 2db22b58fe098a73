"""Quality rules whose cutoffs carry a guarantee, in DataFrame functions only.

Every rule is a ratio or count of a text and rejects a document when it
reaches a cutoff. Cutoffs are not set by hand: for each stratum (language),
rule and cutoff of a fixed grid, labelled holdout documents that are good give
``n`` trials and ``k`` false rejections, and the cutoff is certified when the
exact binomial tail ``P(Bin(n, alpha) <= k)`` is at most ``delta`` divided by
the number of all (stratum, rule, cutoff) tests (Bonferroni). So with
probability ``1 - delta`` every certified cutoff, however it is picked, falsely
rejects at most ``alpha`` of its stratum's good documents; all rules together
at most ``alpha`` times their number. Among certified cutoffs the one with the
most gain (bad documents caught minus ``weight`` times good documents lost) is
used, and none if nothing gains. A stratum where a rule has no certified cutoff
uses the pooled one, certified on all strata together; the pooled guarantee
then holds for the pool.

The toxic-term rule counts words from a list learned on the other fold of the
labels: a bounded sample (``lexicon_docs`` labelled rows, lowest hash first), so
its holdout is untouched.

Defined cases: a null text has no words and fails the base rule; a null or
unlabelled language uses the pooled cutoffs; labels with a null value count on
neither side; repeated rows give repeated results; with too few labels nothing
is certified and only the base rule rejects; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import WORD, matching, stored, table, text_key, words_of

WINDOW = 8
POOLED = "*"
RATIOS = (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7)
COUNTS = (1.0, 2.0, 3.0, 4.0, 6.0, 8.0)

#: Rule name -> grid of cutoffs, fixed before any label is seen.
RULES: dict[str, tuple[float, ...]] = {
    "symbols": RATIOS,       # symbol characters per word character
    "repeats": RATIOS,       # words in repeated windows per word
    "dup_lines": RATIOS,     # repeated lines per line with a word
    "capitals": RATIOS,      # capital letters per word character
    "toxic_terms": COUNTS,   # listed words
}


@dataclass(frozen=True)
class Risk:
    alpha: float = 0.01        # false rejections a rule may cost, per stratum
    delta: float = 0.05        # chance that any certificate is wrong
    weight: float = 5.0        # good documents lost against bad ones caught
    lexicon_docs: int = 8000   # bound of the labelled sample the term list is learned from
    lexicon_terms: int = 200   # bound of the term list


def base_columns(words: Column, text: Column) -> dict[str, Column]:
    """Counts that need no label; ``words`` and ``text`` are plain columns."""
    bare = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def _covered(spots: Column) -> Column:
    """Words covered by windows that start at the ascending positions ``spots``."""
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        spots, zero,
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
        lambda a: a["n"])


def with_features(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``(doc_id, text, lang)`` -> base counts and one value per rule; one row per input row, one pass, no shuffle."""
    d = docs.select("doc_id", "lang", text_key(F.col("text")).alias("text_key"),
                    F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("words", words_of(F.col("text")))
    n = F.size("words")
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    empty = F.array().cast(T.ArrayType(T.LongType(), False))
    d = d.select("doc_id", "lang", "text_key", "text", "words",
                 F.when(n >= WINDOW, hashes).otherwise(empty).alias("h"))
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    # only texts with an equal pair of windows pay for the sort
    twice = F.size(F.array_distinct("h")) < F.size("h")
    d = d.select("doc_id", "lang", "text_key", "text",
                 *[c.alias(k) for k, c in base_columns(F.col("words"), F.col("text")).items()],
                 F.when(twice, pairs).alias("s"))
    same = F.filter("s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"]))
    spots = F.sort_array(F.transform(same, lambda x: x["i"]))
    d = d.withColumn("n_repeat_words", F.coalesce(_covered(spots), F.lit(0)).cast("long"))
    capitals = F.length(F.regexp_replace("text", r"[^\p{Lu}]+", ""))
    toxic = F.regexp_count(F.lower("text"), F.lit(term_pattern(terms))) if terms else F.lit(0)
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return d.select(
        "doc_id", "lang", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        per("n_symbols", "word_chars").alias("symbols"), per("n_repeat_words", "n_words").alias("repeats"),
        per("n_dup_lines", "n_lines").alias("dup_lines"),
        (capitals / F.greatest(F.col("word_chars"), F.lit(1))).alias("capitals"),
        toxic.cast("double").alias("toxic_terms"))


def term_pattern(terms: list[str]) -> str:
    """Listed terms as one pattern: ``abcd*`` matches words with that beginning, others whole words."""
    heads = sorted(t[:-1] for t in terms if t.endswith("*"))
    whole = sorted(t for t in terms if not t.endswith("*") and not any(t.startswith(h) for h in heads))
    parts = [h for h in heads] + [w + r"(?!\p{L})" for w in whole]
    return r"(?<!\p{L})(?:" + "|".join(parts) + ")"


def learn_terms(docs: DataFrame, labels: DataFrame, risk: Risk) -> list[str]:
    """Words and word beginnings that mark toxic documents, from a bounded sample of the training fold.

    A term is listed when at least 5 sampled documents hold it and nine in ten
    of them are toxic. The list is bounded, so it may come to the driver.
    """
    fold = labels.where(~holdout(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("quality").isNotNull())
    sample = (fold.where(F.col("quality") == 1).select("doc_id", "toxic")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(risk.lexicon_docs))
    letters = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    seen = (docs.select("doc_id", "text").join(sample, "doc_id")
            .select("toxic", F.array_distinct(letters).alias("w"))
            .select("toxic", F.explode(F.array_distinct(F.concat(
                F.filter("w", lambda x: F.length(x) >= 4),
                F.transform(F.filter("w", lambda x: F.length(x) >= 5), lambda x: F.concat(F.substring(x, 1, 4), F.lit("*")))))).alias("term")))
    stats = seen.groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad"))
    best = (stats.where((F.col("n") >= 5) & (F.col("bad") >= 0.9 * F.col("n")))
            .orderBy(F.desc("bad"), "term").limit(risk.lexicon_terms))
    return [r["term"] for r in best.collect()]


def holdout(doc_id: Column) -> Column:
    """Fold of the labels that cutoffs are certified on; the other one is for learning."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(2)) == 1


def log_tail(n: Column, k: Column, alpha: float) -> Column:
    """Logarithm of ``P(Bin(n, alpha) <= k)``, exactly, term by term in log space; needs 0 <= k <= n."""
    odds = math.log(alpha) - math.log1p(-alpha)
    first = n * math.log1p(-alpha)

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + odds
        high = F.greatest(a["total"], term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(a["total"] - high) + F.exp(term - high))).alias("total"))

    return F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.cast("double").alias("term"), first.cast("double").alias("total")), step, lambda a: a["total"])


def certified(features: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """One row per stratum: the chosen cutoff of each rule that has a certified one."""
    marked = labels.where(holdout(F.col("doc_id"))).select(
        F.col("doc_id"),
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1)
        .when((F.col("quality") == 0) | (F.col("toxic") == 1), 0).alias("good")).where("good IS NOT NULL")
    rows = (features.where("NOT base_failed").join(marked, "doc_id")
            .select("good", F.explode(F.array_distinct(F.array(F.coalesce("lang", F.lit(POOLED)), F.lit(POOLED)))).alias("stratum"),
                    *RULES))
    totals = rows.groupBy("stratum").agg(F.sum("good").alias("n"), F.sum(1 - F.col("good")).alias("bad"))
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).cast("double").alias("cutoff"), F.lit(i).alias("at"))
                     for i, (r, cs) in enumerate(RULES.items()) for c in cs])
    values = F.array(*[F.col(r) for r in RULES])
    hits = (rows.select("good", "stratum", F.explode(
                F.filter(grid, lambda g: F.get(values, g["at"]) >= g["cutoff"])).alias("g"))
            .groupBy("stratum", "g.rule", "g.cutoff")
            .agg(F.sum("good").alias("k"), F.sum(1 - F.col("good")).alias("caught")))
    n_tests = sum(map(len, RULES.values())) * max(1, totals.count())
    gain = F.col("caught") / F.greatest("bad", F.lit(1)) - risk.weight * F.col("k") / F.greatest("n", F.lit(1))
    # k >= n * alpha can never pass, so the exact sum is only formed below that
    passed = F.when(F.col("k") < F.col("n") * risk.alpha, log_tail(F.col("n"), F.col("k"), risk.alpha)
                    <= math.log(risk.delta / n_tests)).otherwise(False)
    return (hits.join(totals, "stratum").withColumn("gain", gain).where(passed & (F.col("gain") > 0))
            .groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct("gain", "cutoff")).alias("cutoff"))
            .groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")))


def verdicts(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """One row per document row: base counts, ``base_failed``, rule values, the rules that fired, ``kept``.

    Texts are read twice (term list, features); the features, a hundred bytes a
    row, are written once and feed both the certificates and the verdicts.
    """
    labels = labels.select("doc_id", "quality", "toxic")
    features = stored(with_features(docs, learn_terms(docs, labels, risk)), "quality-features")
    cutoffs = stored(certified(features, labels, risk), "quality-cutoffs")
    pool = cutoffs.where(F.col("stratum") == POOLED).first()  # one row, an entry per rule
    pooled = pool["cutoffs"] if pool else {}
    own = cutoffs.where(F.col("stratum") != POOLED).select(F.col("stratum").alias("lang"), "cutoffs")
    joined = features.join(own, "lang", "left")
    none = F.create_map().cast("map<string,double>")
    limit = lambda r: F.coalesce(F.try_element_at(F.coalesce("cutoffs", none), F.lit(r)),
                                 F.lit(pooled.get(r)).cast("double"))
    fired = F.filter(F.array(*[F.when(F.col(r) >= limit(r), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    return (joined.withColumn("fired", fired)
            .withColumn("kept", ~F.col("base_failed") & (F.size("fired") == 0)).drop("cutoffs"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every document."""
    v = verdicts(table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                 table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return v.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", F.array_join("fired", ",").alias("fired"))


def keep_good(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` (all columns) that are kept."""
    kept = verdicts(docs.select("doc_id", "text", "lang"), labels, risk).where("kept")
    return matching(docs, kept.select("doc_id", "text_key").distinct(), "left_semi")


#: The same verdicts in DuckDB. Word windows as strings, the tail by the log-gamma
#: function, the fold by a bitwise CRC-32; the bound on labelled rows isn't reached
#: on tables with under 8,000 of them.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, regexp_extract_all(lower(text), '\p{L}+') AS runs,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i)),
hit AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hit, (SELECT unnest(range(8)) AS k) GROUP BY doc_id),
fold AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(id) + 1), lambda i: CAST(ord(id[i]) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 2 = 1 AS held
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS id FROM labels)),
seen AS (
  SELECT toxic, unnest(list_distinct(list_concat(list_filter(runs, lambda r: length(r) >= 4),
    list_transform(list_filter(runs, lambda r: length(r) >= 5), lambda r: substr(r, 1, 4) || '*')))) AS term
  FROM w JOIN fold USING (doc_id) WHERE NOT held AND toxic IS NOT NULL AND quality = 1),
terms AS (
  SELECT list(term) AS l FROM (SELECT term FROM seen GROUP BY term HAVING count(*) >= 5 AND sum(toxic) >= 0.9 * count(*) ORDER BY sum(toxic) DESC, term LIMIT 200)),
base AS (
  SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(ls) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS n_capitals,
    coalesce(len(list_filter(runs, lambda r: list_contains(l, r) OR length(r) >= 4 AND list_contains(l, substr(r, 1, 4) || '*'))), 0) AS n_toxic
  FROM w LEFT JOIN cov USING (doc_id), terms),
feat AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    [n_symbols / greatest(word_chars, 1), n_repeat_words / greatest(n_words, 1), n_dup_lines / greatest(n_lines, 1),
     n_capitals / greatest(word_chars, 1), CAST(n_toxic AS DOUBLE)] AS v FROM base),
ratios AS (SELECT unnest([0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7]::DOUBLE[]) AS cutoff),
grid AS (
  SELECT r AS rule, cutoff FROM (SELECT unnest([1, 2, 3, 4]) AS r), ratios
  UNION ALL SELECT 5, unnest([1, 2, 3, 4, 6, 8]::DOUBLE[])),
marked AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN quality = 0 OR toxic = 1 THEN 0 END AS good FROM fold WHERE held),
rows_ AS (
  SELECT good, v, unnest(list_distinct([coalesce(lang, '*'), '*'])) AS stratum
  FROM feat JOIN marked USING (doc_id) WHERE NOT base_failed AND good IS NOT NULL),
totals AS (SELECT stratum, sum(good) AS n, sum(1 - good) AS bad, count(*) OVER () AS strata FROM rows_ GROUP BY stratum),
hits AS (
  SELECT stratum, rule, cutoff, sum(good) AS k, sum(1 - good) AS caught FROM rows_, grid WHERE v[rule] >= cutoff GROUP BY ALL),
passed AS (
  SELECT stratum, rule, cutoff, caught / greatest(bad, 1) - 5.0 * k / greatest(n, 1) AS gain
  FROM hits JOIN totals USING (stratum)
  WHERE k < n * 0.01 AND list_sum(list_transform(range(0, CAST(k AS BIGINT) + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))) <= 0.05 / (54 * strata)),
chosen AS (
  SELECT stratum, rule, cutoff FROM passed WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1),
judged AS (
  SELECT f.doc_id, list(r.name ORDER BY r.rule) FILTER (WHERE f.v[r.rule] >= coalesce(o.cutoff, p.cutoff)) AS fired
  FROM feat f, (SELECT unnest([1, 2, 3, 4, 5]) AS rule, unnest(['symbols', 'repeats', 'dup_lines', 'capitals', 'toxic_terms']) AS name) r
  LEFT JOIN chosen o ON o.stratum = f.lang AND o.rule = r.rule AND o.stratum <> '*' LEFT JOIN chosen p ON p.stratum = '*' AND p.rule = r.rule
  GROUP BY f.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND fired IS NULL AS kept, coalesce(array_to_string(fired, ','), '') AS fired
FROM feat JOIN judged USING (doc_id)"""
