"""Language identification: the model's probabilities, held-out accuracy, odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_paths import SF01

from strandline.llm import langid as g


def _models(words):
    counts = np.array(list(words.values()))
    alphabet = len({c for w in words for c in w}) + 2
    return g.Models(g.fit(list(words), counts, alphabet).assign(lang="xx"), alphabet), alphabet


def _next(models, context, c):
    """Log probability of one character after a context, by plain lookups."""
    (keys, values), (ctx, back) = models.arrays[0]
    have, weight = dict(zip(keys.tolist(), values.tolist())), dict(zip(ctx.tolist(), back.tolist()))
    grams = g.Grams([context + c])
    at, total = len(context), 0.0
    for k in range(g.ORDER, 0, -1):
        if grams.depth[at] < k - 1:
            continue
        key = int(grams.grams(k)[at])
        if key in have:
            return total + have[key]
        total += weight.get(int(grams.contexts(k)[at]), 0.0)
    return total + models.floor


WORDS = {"abba": 3, "abc": 1, "b": 5, "cab": 2, "abcabcabc": 1, "aaaaaa": 1}


def test_probabilities_of_the_next_character_sum_to_one():
    models, _ = _models(WORDS)
    for context in ("", "a", "ab", "abb", "abca", "zz", "cabz", "aaaaa"):
        total = sum(np.exp(_next(models, context, c)) for c in ("a", "b", "c", "z", chr(g.STOP)))
        assert abs(total - 1) < 1e-6, (context, total)


def test_word_scores_are_sums_of_their_characters():
    models, _ = _models(WORDS)
    words = ["abba", "zab", "", "abcabcz", "b"]
    scores, sizes = models.word_scores(words)
    for w, s, n in zip(words, scores[:, 0], sizes):
        whole = w + chr(g.STOP)
        assert n == len(whole) and abs(s - sum(_next(models, whole[:i], c) for i, c in enumerate(whole))) < 1e-5


def test_arrays_are_sorted():
    models, _ = _models({"abc": 2, "bcd": 1})
    for pair in models.arrays[0]:
        assert (np.diff(pair[0].astype(object)) > 0).all()


@pytest.mark.parametrize("text,want", [("Ab c!", ["ab", "c"]), ("12 ² Ⅷ _", []), ("ÉÜ-ß", ["éü", "ß"]), ("", []), ("中文 x", ["中文", "x"])])
def test_letters(text, want):
    assert g.letters(text) == want


def test_held_out_accuracy(spark):
    import __spark_entry__ as se

    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang", "text")
    rows = se.queries()["op6_language_id"](spark, SF01).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) < 0.03 * len(rows)


def test_foreign_text_is_rejected(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    models = g.train(docs)
    odd = spark.createDataFrame([(1, "zzxq wvvk qqjx zkxw " * 30), (2, "Привет мир это текст " * 30)], "doc_id long, text string")
    assert all(r["rejected"] and r["lang_pred"] in models.langs for r in g.identify(odd, models).collect())


def test_odd_rows(spark, edge, empty):
    models = g.train(edge)
    rows = {}
    for r in g.identify(edge, models).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert len(rows[1]) == 3
    for i in (2, 3, 4):
        assert rows[i][0]["lang_pred"] == "und" and rows[i][0]["score"] == 0
    assert g.identify(empty, models).count() == 0
    none = g.train(empty)
    assert none.langs == [] and {r["lang_pred"] for r in g.identify(edge, none).collect()} == {"und"}
    assert g.train(edge.withColumn("lang", F.lit(None).cast("string"))).langs == []
