"""Components of the n-gram join against brute force, the split of large groups, and odd rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_paths import SF001

from strandline.llm import ngram_join as nj

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, words=4, percent=85):
    """doc index -> (size, smallest reachable id)."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
        sets.append({tuple(w)} if 0 < len(w) < words else {tuple(w[i:i + words]) for i in range(len(w) - words + 1)})
    top = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * len(a | sets[j]):
                x, y = top[i], top[j]
                top = [min(x, y) if t in (x, y) else t for t in top]
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top[j] == top[i] and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def near_copies(seed, n, length, vocabulary=400):
    """Documents in families of near copies that also quote one common passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passage = [word() for _ in range(length // 3)]
    out, doc = [], 0
    while len(out) < n:
        base = [word() for _ in range(rng.randrange(3, length))]
        if rng.random() < 0.7:
            base[len(base) // 2:len(base) // 2] = passage
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.2:
                copy = copy + [word() for _ in range(rng.randrange(1, 8))]
            out.append((doc, " ".join(copy)))
            doc += 1
    return out[:n]


def found(df, **kw):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in nj.linked(df, **kw).collect()], key=repr)


@pytest.fixture(scope="module")
def family():
    return near_copies(3, 260, 70)


def test_components_equal_brute_force(spark, family):
    df = spark.createDataFrame(family, "doc_id long, text string")
    want = brute(family)
    assert len({c for _, _, c in want}) < len(family) - 60
    assert found(df) == want


def test_split_groups_lose_no_link(spark, family):
    df = spark.createDataFrame(family, "doc_id long, text string")
    assert found(df, group=400) == brute(family)


def test_other_threshold_and_length(spark):
    rows = near_copies(5, 80, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, words=2, percent=60) == brute(rows, 2, 60)


def test_one_table_against_sql_names(spark):
    df = nj.op11_ngram_join(spark, SF001)
    assert df.columns == ["doc_id", "n_shingles", "component_id"] and dict(df.dtypes)["n_shingles"] == "bigint"


def test_odd_rows(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert found(edge) == brute(rows)
    assert nj.linked(empty).count() == 0
    none = edge.select(F.lit(None).cast("long").alias("doc_id"), "text")
    assert {r.component_id for r in nj.linked(none).collect()} == {None}


@pytest.mark.parametrize("seed", range(12))
def test_trie_joins_all_links(seed):
    """The tree alone, with small sets over few shingles, so that paths part and end everywhere."""
    rng = np.random.default_rng(seed)
    sets = {tuple(np.unique(rng.integers(0, rng.integers(3, 30), rng.integers(1, 25)))) for _ in range(60)}
    sets = [np.array(s, np.int64) for s in sorted(sets)]
    percent = int(rng.integers(40, 100))
    trie = nj.Trie(sets)
    got = trie.join(np.arange(len(sets)), np.ones(len(sets), bool), percent)
    label = list(range(len(sets)))
    for i, a in enumerate(trie.order):
        for j in range(i):
            x, y = set(sets[a].tolist()), set(sets[trie.order[j]].tolist())
            if 100 * len(x & y) >= percent * len(x | y):
                p, q = label[i], label[j]
                label = [min(p, q) if t in (p, q) else t for t in label]
    assert got.tolist() == label


def test_steps_of_long_paths():
    """Edges longer than a step, sets that end inside another's path."""
    base = np.arange(300)
    sets = [base, base[:290], base[:200], np.concatenate((base[:150], base[150:] + 1000)), base[5:]]
    trie = nj.Trie([np.array(s) for s in sets])
    got = trie.join(np.arange(5), np.ones(5, bool), 85)
    groups = {}
    for at, label in zip(trie.order, got):
        groups.setdefault(label, set()).add(int(at))
    assert sorted(map(sorted, groups.values())) == [[0, 1, 4], [2], [3]]


def test_sets_of_shared_passages_are_dealt_once(spark, monkeypatch):
    """Texts put together from common passages share prefixes with all others and are near copies of few."""
    rng = random.Random(8)
    passages = [[f"w{rng.randrange(3000)}" for _ in range(40)] for _ in range(60)]
    rows = []
    for _ in range(90):
        text = [w for p in rng.sample(passages, 5) for w in p]
        rows.append((len(rows), " ".join(text)))
        if len(rows) % 9 == 0:
            rows.append((len(rows), " ".join(text[1:])))
    dealt, edges = [], nj.group_edges

    def group_edges(df, percent):
        dealt.append(df.count())
        return edges(df, percent)

    monkeypatch.setattr(nj, "group_edges", group_edges)
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), group=1500) == brute(rows)
    assert sum(dealt) <= len(rows)


@pytest.mark.parametrize("percent", [40, 60, 85, 99])
def test_linked_sets_have_an_equal_segment(percent):
    rng = np.random.default_rng(percent)
    pairs = []
    while len(pairs) < 400:
        n = int(rng.integers(1, 40) if rng.random() < 0.5 else rng.integers(1, 800))
        pool = rng.integers(-(1 << 63), 1 << 63, 3 * n, dtype=np.int64)
        gone, more = (int(rng.integers(0, n * (100 - percent) // 50 + 2)) for _ in range(2))
        a, b = np.unique(pool[:n]), np.unique(np.concatenate((pool[gone:n], pool[n:n + more])))
        both = len(np.intersect1d(a, b))
        if len(b) and both < max(len(a), len(b)) and 100 * both >= percent * (len(a) + len(b) - both):
            pairs.append((a, b))
    sets = [s for p in pairs for s in p]
    row, key = nj.segments(np.array([len(s) for s in sets]), np.concatenate(sets), np.repeat(np.arange(400), 2), percent)
    for i in range(400):
        assert len(np.intersect1d(key[row == 2 * i], key[row == 2 * i + 1]))
