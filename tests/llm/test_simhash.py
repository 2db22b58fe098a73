"""SimHash: fingerprints, links and components by brute force."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from tests_paths import SF001

from strandline.llm import components as k
from strandline.llm import simhash as s


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, labels, bits=4):
    fps, out = np.array(fps, dtype=np.uint64), list(labels)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    while True:
        new = [min(out[j] for j in np.flatnonzero(near[i])) for i in range(len(fps))]
        if new == out:
            return out
        out = new


def test_fingerprint():
    texts = ["", None, " \n", "One", "a b c", "a b c d", "A B  c\td e " * 200, "Éa É É e f g " * 80, "x " * 600]
    for t in texts:
        assert s.fingerprint(t, 4) == brute_fingerprint(t), t


def test_index_finds_every_link():
    rng = np.random.default_rng(2)
    for _ in range(25):
        n = int(rng.integers(1, 500))
        base = rng.integers(0, 2**63, size=12, dtype=np.uint64)
        f = base[rng.integers(0, 12, n)]
        for _ in range(int(rng.integers(0, 7))):
            f = f ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        f = np.unique(f)
        f = f[s._gray_order(f)]
        assert s.group_components(f, 4).tolist() == brute_components(f, range(len(f)))


def test_gray_neighbours_differ_by_one_bit():
    codes = np.arange(256, dtype=np.uint64)
    order = codes[s._gray_order(codes)]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


def test_links_survive_splitting(spark, monkeypatch):
    rng = np.random.default_rng(3)
    center = np.uint64(0x123456789ABCDEF0)
    f = np.unique(np.concatenate([center ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)),
                                  rng.integers(0, 2**63, 300, dtype=np.uint64)]))
    monkeypatch.setattr(s, "GROUP", 40)
    s.ship(spark)
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    edges = {(r["a"], r["root"]) for r in k.components(s.links(df, 4), "test").collect()}
    want = brute_components(f, range(len(f)))
    root = dict(edges)
    have = [root.get(int(x), int(x)) for x in f.view(np.int64)]
    assert {tuple(i for i, v in enumerate(want) if v == w) for w in want} == {tuple(i for i, v in enumerate(have) if v == w) for w in have}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, j) for j in range(1001, 1100)] + [(5, 5)]
    got = {r["a"]: r["root"] for r in k.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert all(got[i] == 1 for i in range(2, 61)) and all(got[j] == 1000 for j in range(1001, 1100))
    assert len(got) == 59 + 99


def test_query(spark):
    import __spark_entry__ as se

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in se.queries()["op5_simhash"](spark, SF001).collect()}
    ids = sorted(docs)
    fps = [brute_fingerprint(docs[i]) for i in ids]
    assert [rows[i]["fingerprint"] for i in ids] == [f"{x:016x}" for x in fps]
    assert [rows[i]["component_id"] for i in ids] == brute_components(fps, ids)


def test_odd_rows(spark, edge, empty):
    rows = s.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    blank = {r["doc_id"]: r for r in rows if r["fp"] == 0}
    assert set(blank) == {2, 3, 4} and {r["component_id"] for r in blank.values()} == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] == 8} == {1}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    kept = s.keep_first(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 1, 2, 5, 6, 7, 9]
    assert s.near_duplicates(empty).count() == 0 and s.keep_first(empty).count() == 0
