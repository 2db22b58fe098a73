"""Packing: exact token round trip, valid plans, never worse than best fit decreasing, odd rows."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests_paths import SF001
from tokenizers import Tokenizer

from strandline.llm import packing as p

PATH = p.word_bpe()


def bins_of(plan, counts):
    bins = defaultdict(list)
    for s, runs in plan.slots.items():
        assert sum(k for k, _, _ in runs) == counts[s]
        for k, first, offset in runs:
            for i in range(k):
                bins[first + i].append((offset, s))
    assert sorted(bins) == list(range(plan.sequences))
    for b in bins.values():
        end = 0
        for offset, s in sorted(b):
            assert offset == end
            end += s
        assert end <= plan.capacity
    return bins


def best_fit(items, capacity):
    rooms = []
    for s in sorted(items, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


@pytest.mark.parametrize("capacity,low", [(10, 1), (20, 4), (50, 13), (100, 21), (100, 30), (97, 1)])
def test_plans(capacity, low):
    rng = random.Random(capacity * 100 + low)
    for _ in range(150):
        items = [rng.randint(low, rng.choice([capacity, capacity // 2 + 1])) if low <= capacity // 2 else rng.randint(low, capacity) for _ in range(rng.randint(0, 50))]
        counts = Counter(items)
        plan = p.Plan(dict(counts), capacity)
        bins_of(plan, counts)
        assert -(-sum(items) // capacity) <= plan.sequences <= best_fit(items, capacity)


def test_reduction_keeps_an_optimum():
    rng = random.Random(9)
    for _ in range(120):
        capacity = rng.randint(8, 30)
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)

        def optimum(rest, limit):
            def place(i, rooms):
                if i == len(rest):
                    return len(rooms)
                best = 99
                for j in sorted({r: j for j, r in enumerate(rooms) if r >= rest[i]}.values()):
                    best = min(best, place(i + 1, rooms[:j] + (rooms[j] - rest[i],) + rooms[j + 1:]))
                return min(best, place(i + 1, rooms + (limit - rest[i],)))
            return place(0, ())

        class Reduced(p.Plan):
            def _best_fit(self):
                pass

        plan = Reduced(dict(Counter(items)), capacity)
        left = sorted((s for s, n in plan.left.items() for _ in range(n)), reverse=True)
        assert plan.fixed + optimum(left, capacity) == optimum(items, capacity), items


def test_large_histogram_is_fast_and_tight():
    rng = np.random.default_rng(1)
    counts = {int(s): int(n) for s, n in zip(*np.unique(np.minimum(4096, rng.lognormal(6.5, 1.2, 3_000_000)).astype(int) + 1, return_counts=True)) if s <= 4096}
    counts = {s: n * 1000 for s, n in counts.items()}
    plan = p.Plan(counts)
    total = sum(s * n for s, n in counts.items())
    assert plan.sequences <= 1.001 * -(-total // 4096) + 2 * sum(n for s, n in counts.items() if s > 4000)


TEXTS = ["", None, " \n", "it's DON'T we'LL 's'", "a<|endoftext|>B <|startoftext|>", "É é İx ſt K ß ΑΣ ΑΣ. x'sy 12ab3", "ª µ º ß÷ø ²³x¼ ÀÉ×Ü¿ É´s É’s", "a1b2-c3's",
         "İ ͅa'ͅs", "x y a\x1cb a\x85b", "\x00 \x01a\x02", "é ño", "中文 🙂🙂 a🙂b", "x" * 5000, "word " * 9000, "|a|b|| --- !!! ???"]


def test_tokens():
    t = Tokenizer.from_file(PATH)
    for text in TEXTS:
        assert np.frombuffer(p.token_bytes(text, PATH), "<u4").tolist() == t.encode(text or "", add_special_tokens=False).ids + [1], text


def test_cache_that_overflows(monkeypatch):
    monkeypatch.setattr(p, "CACHED", 3)
    test_tokens()


def check(rows, docs):
    t = Tokenizer.from_file(PATH)
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by) == set(docs)
    total = 0
    for i, text in docs.items():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        total += len(ids)
        own = sorted(by[i], key=lambda r: r["piece"])
        assert len(own) == -(-len(ids) // 4096)
        for k, r in enumerate(own):
            part = ids[4096 * k:4096 * k + 4096]
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (k, 4096 * k, len(part), zlib.crc32(part.tobytes()))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    return len(sequences), -(-total // 4096)


def test_query(spark):
    import __spark_entry__ as se

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    used, least = check(se.queries()["op9_packing"](spark, SF001).collect(), docs)
    assert used <= least + 1


def test_odd_rows(spark, edge, empty):
    rows = p.pack(edge, PATH).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert Counter(r["doc_id"] for r in rows)[1] == 3 and Counter(r["length"] for r in rows)[1] == 3  # null, empty, blank
    docs = {i: t for i, t in enumerate(TEXTS)}
    check(p.pack(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5), PATH).collect(), docs)
    assert p.pack(empty, PATH).count() == 0


def test_equal_sizes_over_many_parts(spark):
    docs = {i: "a b c" for i in range(3000)}
    rows = p.pack(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(7), PATH).collect()
    assert check(rows, docs) == (3, 3)
    assert list(itertools.islice(sorted(Counter(r["sequence_id"] for r in rows).values()), 3)) == [952, 1024, 1024]


def test_kept_ids_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(p, "CACHED", 20_000)
    ids, whole = p._Ids(p.word_bpe()), Tokenizer.from_file(p.word_bpe())
    for i in range(3000):
        word = f"Wörd{i * 7919}x" + "y" * (i % 60)
        copy = "".join(list(word))  # a string keeps its UTF-8 once it was asked for, which adds to its size
        assert ids[word] == np.array(whole.encode(copy, add_special_tokens=False).ids, dtype="<u4").tobytes()
        kept = sum(p.getsizeof(k) + p.getsizeof(v) + p.SLOT for d in (ids, ids.plain) for k, v in d.items())
        assert ids.held <= 20_000 and kept <= 1.1 * ids.held
