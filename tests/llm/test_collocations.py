"""Phrase mining against brute force, the automata alone, and odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from strandline.llm import collocations as co

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, top=co.TOP):
    counts, total = {}, Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, 5):
                counts.setdefault(lang or "und", Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i:i + k]] = max(around[p[i:i + k]], a)
        rows_ = []
        for p, a in cands.items():
            score, cut = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not (around[p] and 100 * around[p] >= 80 * a):
                rows_.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, r, p.decode(), -a, left, right, total[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = ["on", "The", "of", "new", "york", "état", "a", "x"] + [f"w{i}" for i in range(40)]
    fixed = ["New York state of mind", "on the other hand", "x x x x x", "état de l'art"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.15 else rng.choice(vocabulary))
            if rng.random() < 0.1:
                parts.append(rng.choice([".", ", ", "\n", "\t", "!?"]))
        out.append((" ".join(parts), rng.choice(["en", "en", "en", "fr", None])))
    return out


def found(df, **kw):
    return sorted(tuple(r) for r in co.mined(df, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases_equal_brute_force(spark):
    rows = corpus(1, 400)
    want = brute(rows, 12)
    assert len(want) > 15 and {len(r[2].split()) for r in want} == {2, 3, 4}
    assert found(spark.createDataFrame(rows, "text string, lang string").repartition(5), least=12) == want


def test_top_and_small_tasks(spark, monkeypatch):
    """Tasks that build many automata, and a cut of the ranking among ties."""
    monkeypatch.setattr(co, "HELD", 300)
    rows = corpus(2, 150)
    assert found(spark.createDataFrame(rows, "text string, lang string"), least=5, top=7) == brute(rows, 5, 7)


def test_a_clash_of_hashes_moves_to_the_next_seed(spark, monkeypatch):
    real, turns = co._seed, []

    def counted(lang, turn):
        turns.append(turn)
        return real(lang, turn)

    monkeypatch.setattr(co, "_seed", counted)
    first, calls = co._spellings, []

    def clash(two, frequent, turn):
        calls.append(turn)
        df = first(two, frequent, turn)
        return df.withColumn("id", df["id"] * 0) if turn == 0 else df

    monkeypatch.setattr(co, "_spellings", clash)
    rows = corpus(3, 120)
    assert found(spark.createDataFrame(rows, "text string, lang string"), least=8) == brute(rows, 8)
    assert calls == [0, 1]


def test_odd_rows(spark, edge, empty):
    rows = [(r.text, r.lang) for r in edge.collect()]
    assert found(edge, least=2) == brute(rows, 2)
    assert co.mined(empty).count() == 0
    assert co.mined(edge.where("text IS NULL")).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_automata(seed):
    """Round trip, union with sums, lookups of present, absent, shorter and longer phrases, fewer states than prefixes."""
    rng = np.random.default_rng(seed)

    def some(n):
        labels = rng.integers(1, 6, (n, 4)).astype(np.uint64)
        for row in labels:
            row[rng.integers(1, 5):] = 0
        return co._summed(labels, rng.integers(1, 3, n).astype(np.int64))

    parts = [some(int(rng.integers(1, 200))) for _ in range(3)]
    autos = [co.Automaton.decode(co.Automaton.build(*p).encode()) for p in parts]
    want = Counter()
    for labels, counts in parts:
        for row, n in zip(labels.tolist(), counts.tolist()):
            want[tuple(row)] += n
    whole = co.united(autos)
    labels, counts = whole.phrases()
    assert dict(zip(map(tuple, labels.tolist()), counts.tolist())) == dict(want)
    asked = rng.integers(0, 7, (500, 4)).astype(np.uint64)
    for row in asked:
        row[0] = max(row[0], 1)
        zero = np.flatnonzero(row == 0)
        if len(zero):
            row[zero[0]:] = 0
    assert whole.weights(asked).tolist() == [want[tuple(r)] for r in asked.tolist()]
    assert co.united(autos, 4).phrases()[1].min(initial=9) >= 4
    arcs = sum(len(layer[1]) for layer in whole.layers)
    prefixes = {tuple(r[:d]) for r in labels.tolist() for d in range(1, 5) if r[d - 1]}
    assert arcs <= len(prefixes)


def test_equal_continuations_are_one_state():
    labels = np.array([[a, b, c, 0] for a in range(1, 50) for b in (1, 2) for c in (3, 4)], np.uint64)
    automaton = co.Automaton.build(*co._summed(labels, np.full(len(labels), 7, np.int64)))
    assert [len(layer[1]) for layer in automaton.layers] == [49, 2, 2, 0]
