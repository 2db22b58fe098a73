"""Masked pseudo-likelihood: probabilities, gradients, learning, odd rows."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest
from tests_paths import SF001

from strandline.llm import lm_score as m


def _net(seed=0):
    rng = np.random.default_rng(seed)
    return m.Network(rng.normal(0, 0.3, m.Network.start().shape).astype(np.float32))


def test_probabilities_sum_to_one():
    net = _net()
    flat, at, _ = m.laid_out([np.array([5, 9, 100, 7, 3], dtype=np.int32)])
    total = 0.0
    for t in range(m.TOKENS):
        flat[at[2]] = t
        total += np.exp(net.log_prob(flat, at[2:3])[0])
    assert abs(total - 1) < 1e-4


def test_context_is_both_sides_and_ends_are_padded():
    flat, at, begin = m.laid_out([np.array([1, 2, 3], np.int32), np.array([], np.int32), np.array([4], np.int32)])
    assert flat[at].tolist() == [1, 2, 3, 4] and begin[0] == 2
    rows = m.Network.contexts(flat, at[1:2])
    assert [int(r[0]) - k * (m.TOKENS + 1) for k, r in enumerate(rows)] == [m.PAD, 1, 3, m.PAD]
    alone = m.Network.contexts(flat, at[3:4])
    assert [int(r[0]) - k * (m.TOKENS + 1) for k, r in enumerate(alone)] == [m.PAD] * 4


def test_learning_lowers_the_loss_and_order_matters():
    rng = np.random.default_rng(0)
    text = np.tile(np.array([3, 500, 41, 9, 77, 1200], np.int32), 400)
    flat, at, _ = m.laid_out([text])
    net = m.Network(m.Network.start())
    squares, used = np.zeros(len(net.w), np.float32), np.zeros(len(net.w), np.float32)
    before = net.log_prob(flat, at).mean()
    for _ in range(30):
        net.learn(flat, at[rng.permutation(len(at))[:512]], squares, used)
    mixed = text.copy()
    rng.shuffle(mixed)
    other, places, _ = m.laid_out([mixed])
    assert net.log_prob(flat, at).mean() > max(before, net.log_prob(other, places).mean()) + 2


def test_step_follows_the_gradient():
    net = _net(1)
    net.w = net.w.astype(np.float64)
    flat, at, _ = m.laid_out([np.array([5, 9, 100, 7, 3, 2000], dtype=np.int32)])
    start = net.w.copy()
    net.learn(flat, at, np.full(len(net.w), 1e12), np.zeros(len(net.w)), rate=1.0)
    step = (start - net.w) * 1e6  # the gradient of the summed loss, nearly
    rng = np.random.default_rng(0)
    moved = np.argwhere(np.abs(step) > 1e-3)
    for r, c in moved[rng.integers(0, len(moved), 12)]:
        if r < m._IN and c == m.WIDTH - 1:
            continue
        loss = []
        for d in (1e-4, -1e-4):
            net.w = start.copy()
            net.w[r, c] += d
            loss.append(-net.log_prob(flat, at).sum())
        assert abs((loss[0] - loss[1]) / 2e-4 - step[r, c]) < 2e-2 * max(1, abs(step[r, c]))


def test_query(spark):
    import __spark_entry__ as se

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in se.queries()["op7_lm_score"](spark, SF001).collect()}
    assert set(rows) == set(docs)
    for i, r in rows.items():
        assert r["n_tokens"] == len((docs[i] or "").split()) and r["log_prob"] <= 0
        assert r["mean_log_prob"] == pytest.approx(r["log_prob"] / r["n_tokens"])


def test_scores_equal_plain_sums(spark):
    rows = [(1, "a b c d e f"), (2, "c"), (3, None), (4, "b a " * 40000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    m.ship(spark)
    known = m.vocabulary(df)
    net = _net(2)
    got = {r["doc_id"]: r for r in m.score(df, known, net.w).collect()}
    words = m.Words(known)
    for i, t in rows:
        flat, at, _ = m.laid_out([words.tokens(m.split(t))])
        assert got[i]["log_prob"] == pytest.approx(net.log_prob(flat, at).sum() if len(at) else 0.0)
    assert got[3]["n_tokens"] == 0 and got[3]["mean_log_prob"] is None


def test_averaging_over_tasks(spark):
    texts = [(i, "one two three four five six " * 20) for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    m.ship(spark)
    known = m.vocabulary(df)
    assert set(known) == {"one", "two", "three", "four", "five", "six"}
    for n in (1, 6):
        weights = m.train(df.repartition(n), known)
        base = m.score(df, known, m.Network.start()).first()["mean_log_prob"]
        assert m.score(df, known, weights).first()["mean_log_prob"] > base + 0.5


def test_every_token_is_learned_from(spark, monkeypatch):
    rows = [("one two three four five six seven " * 40,), ("eight",), ("nine ten",), ("one",), (None,)]
    m.ship(spark)
    df = spark.createDataFrame(rows, "text string").coalesce(1)
    known = m.vocabulary(df)
    seen: list[int] = []
    learn = m.Network.learn
    monkeypatch.setattr(m.Network, "learn", lambda self, flat, at, *a: (seen.extend(flat[at].tolist()), learn(self, flat, at, *a))[1])

    class Rows:
        """The table, with its tasks run here."""

        sparkSession = spark

        def select(self, _):
            return self

        def mapInArrow(self, run, kind):
            monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
            list(run([pa.RecordBatch.from_pylist([{"text": t} for t, in rows])]))
            monkeypatch.undo()
            return spark.createDataFrame([], kind)

    m.train(Rows(), known)
    assert sorted(known[t] for t in seen) == sorted(w for t, in rows for w in (t or "").split())


def test_random_strings_score_below_held_out_text(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    m.ship(spark)
    seen, held = docs.where("doc_id % 5 <> 0").cache(), docs.where("doc_id % 5 = 0 AND length(text) > 200")
    known = m.vocabulary(seen)
    rng = np.random.default_rng(4)
    noise = [(-i, " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9))) for _ in range(120))) for i in range(1, 21)]
    both = held.union(spark.createDataFrame(noise, "doc_id long, text string"))
    got = m.score(both, known, m.train(seen, known), m.spelling(seen, known)).where("n_tokens > 20").collect()
    clean = [r["mean_log_prob"] for r in got if r["doc_id"] >= 0]
    random = [r["mean_log_prob"] for r in got if r["doc_id"] < 0]
    assert len(random) == 20 and max(random) < np.quantile(clean, 0.05)


def test_words_of_a_bucket_are_a_distribution():
    pairs = np.zeros((m.BYTES, m.BYTES))
    for a in b"abc\n":
        for b in b"abc":
            pairs[a, b] = 1e7 * (1 + (a + 2 * b) % 3)
        pairs[a, 10] = 0 if a == 10 else 5e7
    known = ["a", "ab", "cab"]
    letters = m.Spelling(known, pairs)
    words = {bytes(w) for n in range(1, 10) for w in itertools.product(b"abc", repeat=n)} - set(letters)
    letters.add(words)
    in_bucket = np.zeros(m.OTHER)
    for w in words:
        in_bucket[m.bucket(w + b"\n")] += np.exp(letters[w])
    used = {m.bucket(w + b"\n") for w in words}
    assert all(0.95 < in_bucket[b] <= 1 + 1e-9 for b in used)
    letters.add({b"zeb"})
    assert letters.sum([b"ab", b"a"]) == 0 and letters[b"zeb"] < -10


def test_chains_step_by_step_and_a_full_cache(monkeypatch):
    rng = np.random.default_rng(5)
    letters = m.Spelling([], rng.integers(0, 50, (m.BYTES, m.BYTES)))
    words = ["é".encode(), b"x", b"ab", b"abc" * 50]
    for w, p in zip(words, letters.chains(words)):
        x = b"\n" + w + b"\n"
        assert p == pytest.approx(sum(letters.log[a, b] for a, b in zip(x, x[1:])))
    letters.add(set(words))
    before = {w: letters[w] for w in words}
    monkeypatch.setattr(m, "CACHED", 2)
    letters.add({b"new"})
    assert set(letters) == {b"new"}
    letters.add(set(words))
    assert {w: letters[w] for w in words} == before


def test_spelling_counts_every_occurrence(spark):
    rows = [("aa b aa\u00a0c known",), ("b b b",), (None,), ("",)]
    m.ship(spark)
    n = m.spelling(spark.createDataFrame(rows, "text string"), ["known"])
    want = np.zeros((m.BYTES, m.BYTES))
    for t, in rows:
        for w in m.split(t):
            if w != b"known":
                x = b"\n" + w + b"\n"
                np.add.at(want, (list(x[:-1]), list(x[1:])), 1)
    assert np.array_equal(n, want) and n.sum() > 0


def test_odd_rows(spark, edge, empty):
    m.ship(spark)
    known = m.vocabulary(edge)
    rows = m.score(edge, known, m.train(edge, known)).collect()
    assert len(rows) == edge.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert m.vocabulary(empty) == []
    weights = m.train(empty, [])
    assert np.array_equal(weights, m.Network.start()) and m.score(empty, [], weights).count() == 0


def test_texts_are_numbered_and_spelled_together():
    known = ["ab", "a", "zoo"]
    words = m.Words(known)
    letters = m.Spelling(known, np.random.default_rng(3).integers(0, 50, (m.BYTES, m.BYTES)))
    texts = [m.split(t) for t in (None, "ab c Zoo \x85x", "", "q ß日 a\n\ta qq " + "long" * 30)]
    each, tokens, x = m.numbered(texts, words)
    number = lambda w: known.index(w.decode()) if w.decode() in known else m.KNOWN + m.bucket(w + b"\n")
    assert [t.tolist() for t in each] == [[number(w) for w in t] for t in texts]
    flat = [w for t in texts for w in t]
    letters.add(set(flat))
    assert letters.of(tokens, x) == pytest.approx([letters[w] for w in flat])
    each, tokens, x = m.numbered([[], []], words)
    assert [len(t) for t in each] == [0, 0] and letters.of(tokens, x).shape == (0,)


def test_added_rows():
    rng = np.random.default_rng(8)
    x, row = rng.random((30, 5)), rng.integers(0, 30, 400)
    first = np.concatenate(([0], np.sort(rng.choice(np.arange(1, 400), 70, replace=False))))
    assert np.allclose(m.added(x, row, first), np.add.reduceat(x[row], first))
