"""The pipeline: each stage against plain Python on its own input, and the whole run."""

from __future__ import annotations

from collections import Counter

import pytest
from test_line_dedup import brute as brute_lines
from test_packing import check as check_packing
from test_simhash import brute_components, brute_fingerprint
from tests_paths import SF001, SF01

import corpus_pipeline as cp
from strandline.llm import decontaminate, quality_rules
from strandline.llm.common import stored


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage on the small table."""
    docs, out = spark.read.parquet(f"{SF01}/documents.parquet"), []
    for name, f in cp.STAGES:
        result = stored(f(spark, docs, SF01), "test-stage")
        out.append((name, docs, result))
        docs = result
    return out


def test_stage_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_quality_keeps_what_the_rules_keep(spark, stages):
    _, before, after = stages[0]
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    kept = {r["doc_id"] for r in quality_rules.verdicts(before, labels).collect() if r["kept"]}
    assert {r["doc_id"] for r in after.collect()} == kept


def test_lines(stages):
    _, before, after = stages[1]
    want = {}
    for i, exact, near, text in brute_lines([(r["doc_id"], r["text"]) for r in before.collect()]):
        left = [x for x in (text or "").split("\n") if len(x.split()) >= 3]
        if left or not exact + near:
            want[i] = text
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want


def test_near_duplicates(stages):
    _, before, after = stages[2]
    rows = {r["doc_id"]: r["text"] for r in before.collect()}
    ids = sorted(rows)
    assert {r["doc_id"] for r in after.collect()} == set(brute_components([brute_fingerprint(rows[i]) for i in ids], ids))


def test_benchmark(spark, stages):
    _, before, after = stages[3]
    flat = lambda t: " " + " ".join(x.decode() for x in decontaminate.words(t)) + " "
    items = [r["text"] for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in after.collect()}
    for r in before.collect():
        held = any(flat(i) in flat(r["text"]) for i in items)
        if r["doc_id"] in kept:
            assert not held
        elif not held:  # an item that lost a line to the stage before
            pieces, vocabulary = decontaminate.pieces_of(list(enumerate(items)))
            w = [vocabulary.get(x, 0) for x in decontaminate.words(r["text"])]
            assert max(decontaminate.common(len(p.terms), p.at, w) / len(p.terms) for p in pieces) >= decontaminate.COVER


def test_packing(stages):
    _, before, after = stages[4]
    used, least = check_packing(after.collect(), {r["doc_id"]: r["text"] for r in before.collect()})
    assert used <= least + 1


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, f in cp.STAGES:
        docs = f(spark, docs, SF001)
    lengths = lambda df: Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in df.collect())
    assert lengths(cp.run(spark, SF001)) == lengths(docs)


def test_odd_documents(spark, edge, empty):
    for docs in (edge, empty.select("*")):
        for _, f in cp.STAGES:
            docs = stored(f(spark, docs, SF001), "test-odd")
        assert "sequence_id" in docs.columns
    assert docs.count() == 0


def test_benchmark_stage_fits_on_every_document_it_is_given(spark, monkeypatch):
    """Its latent space is a model of all documents that reach the stage, more of them than any sample's size."""
    docs = spark.range(2500).selectExpr("id AS doc_id", "concat('seven tall trees and ', id % 50, ' more words') AS text")
    seen, times = [], decontaminate._times
    monkeypatch.setattr(decontaminate, "_times", lambda texts, idf, q: seen.append(texts.count()) or times(texts, idf, q))
    assert cp.benchmark(spark, docs, SF001).columns == docs.columns
    assert seen == [2500] * (decontaminate.ROUNDS + 1)
