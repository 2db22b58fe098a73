"""Quality rules: base counts by brute force, the exact bound, the guarantee, odd rows."""

from __future__ import annotations

import math
import re

from pyspark.sql import functions as F
from tests_paths import SF001

from strandline.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    times = {}
    for x in win:
        times[x] = times.get(x, 0) + 1
    hit = {i + k for i, x in enumerate(win) if times[x] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            n < 20 or 100 * len(hit) > 30 * n)


def test_base_counts(spark, edge, labels):
    rows = [("a b c d e f g h " * 5,), ("x " * 40,), ("one\ntwo\none\n \none",), ("é# |ü🙂 $" * 10,), ("a b c d e f g h i j a b c d e f g h z",)]
    texts = spark.createDataFrame([(i, t, "en") for i, (t,) in enumerate(rows)], "doc_id long, text string, lang string")
    for df in (texts, edge.select("doc_id", "text", "lang")):
        got = q.verdicts(df, labels).collect()
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        have = sorted((tuple(r[n] for n in names) for r in got), key=repr)
        assert have == sorted((brute(r["text"]) for r in df.collect()), key=repr)
        assert all(not r["kept"] for r in got if r["base_failed"])


def test_query_base_counts(spark):
    import __spark_entry__ as se

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = se.queries()["op2_quality_rules"](spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(docs[r["doc_id"]])


def test_tail_is_exact(spark):
    cases = [(50, 0), (50, 3), (400, 7), (3000, 20), (100000, 900)]
    df = spark.createDataFrame(cases, "n long, k long")
    got = {(r["n"], r["k"]): r["p"] for r in df.select("n", "k", q.log_tail(F.col("n"), F.col("k"), 0.01).alias("p")).collect()}
    for n, k in cases:
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.01) + (n - i) * math.log(0.99) for i in range(k + 1)]
        top = max(terms)
        assert abs(got[n, k] - (top + math.log(sum(math.exp(t - top) for t in terms)))) < 1e-6


def test_cutoffs_reject_junk_and_keep_good(spark):
    good = "plain words follow each other in an easy line and nothing here is odd at all so it stays where it is "
    rows, marks = [], []
    for i in range(4000):
        junk = i % 10 == 0
        words = [f"{w}{i * 7 % 997}" + ("###" if junk else "") for w in good.split()]
        rows.append((i, " ".join(words) + (" vileword" if i % 13 == 1 else ""), "en" if i % 3 else "de"))
        marks.append((i, 0 if junk else 1, int(i % 13 == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    v = q.verdicts(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    bad = {i for i, a, t in marks if not a or t}
    assert {r["doc_id"] for r in v if not r["kept"]} == bad


def test_few_labels_certify_nothing(spark, labels):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}###" for i in range(60)), "en")], "doc_id long, text string, lang string")
    row = q.verdicts(docs, labels).first()
    assert row["kept"] and row["fired"] == []


def test_keep_good_on_odd_rows(spark, edge, empty, labels):
    kept = q.keep_good(edge, labels)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 8]
    assert q.keep_good(empty, labels).count() == 0
    assert q.keep_good(edge, labels.limit(0)).count() == 3


def test_plan_is_native(spark, edge):
    plan = q.with_features(edge, ["abcd*", "word"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
