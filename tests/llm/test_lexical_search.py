"""Ranked search against brute force: scores, ties, blocks of items, bounds, odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strandline.llm import lexical_search as ls

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def cut(text):
    return _TERM.findall((text or "").translate(_LOWER))


def brute(docs, items, k=10):
    bags = [(d, Counter(cut(t)), len(cut(t))) for d, t in docs]
    bags = [b for b in bags if b[2]]
    n, length = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scores = []
        for d, bag, size in bags:
            m = 25 + (75 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in cut(text) if t in bag)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(docs, items, k=10):
    return sorted([tuple(r) for r in ls.search(docs, items, k).select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    word = lambda: f"t{int(rng.paretovariate(0.7)) % vocabulary}"
    docs = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 20, 80])))) for i in range(n)]
    docs += [(n + i, docs[i][1]) for i in range(0, n, 3)]  # copies: equal scores
    return docs, [(i, " ".join(word() for _ in range(rng.randrange(1, 12)))) for i in range(25)]


def test_ranks_equal_brute_force(spark):
    docs, items = corpus(1, 300)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(d, spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(ls, "ITEMS", 4)
    docs, items = corpus(2, 60)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(d, spark.createDataFrame(items, "item_id long, text string"), 3) == brute(docs, items, 3)


def test_odd_rows(spark, edge, empty, benchmark):
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()] + [(5, "WORD word"), (5, "Émile Zola"), (6, "émile zola ligne ligne")]
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("own")).withColumn("score", F.lit(1))
    assert found(edge, b) == brute(docs, items)
    assert ls.search(empty, b).count() == 0 and ls.search(edge, b.limit(0)).count() == 0


def test_bounds_hold_and_save_work(monkeypatch):
    """A sketch bound is never below the score, colliding terms included, and most documents aren't rescored."""
    docs, items = corpus(3, 900, 3000)
    for width in (7, 1024):
        monkeypatch.setattr(ls, "WIDTH", width)
        q = ls.Queries([ls.terms(t) for _, t in items])
        bags = [(d, len(ls.terms(t)), Counter(w for w in ls.terms(t) if w in q.vocabulary)) for d, t in docs]
        bags = [b for b in bags if b[2]]
        df = np.zeros(len(q.vocabulary), np.int64)
        for _, _, tf in bags:
            for w in tf:
                df[q.vocabulary[w]] += 1
        mean = (len(docs), sum(len(ls.terms(t)) for _, t in docs))
        q.weigh(mean[0], df)
        hits = ls.Found(len(items), 10)
        rescored = ls.search_batch(q, q.lookups(), bags, mean, hits)
        assert [(i, r, doc, -s) for i, best in enumerate(hits.best) for r, (s, _, doc) in enumerate(best, 1)] == sorted(brute(docs, items), key=lambda x: x[:2])
        if width == 1024:
            assert rescored < len(bags) * len(items) / 5
