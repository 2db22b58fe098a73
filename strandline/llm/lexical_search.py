"""Ranked lexical search with hashed max-sketches.

Every document scores for every query item; each item's ``k`` best documents
are returned. A document's impact for a term is what one occurrence of the term in a query adds to
the score. Its sketch has ``WIDTH`` coordinates: an impact is folded by maximum into
the coordinate its term hashes to. A query's upper bound for a
document is the sum of the coordinates its terms hash to, so the bounds of a
batch of documents and all items are one matrix product. For each item
documents are then rescored exactly in order of falling bound, until the next bound is
below the ``k``-th best exact score so far: nothing after it can enter the result.

The corpus statistics (documents, terms, document frequencies of the items' terms) come
from one pass over all documents; the second pass builds sketches and searches.
Items are taken in blocks of at most ``ITEMS``, which bounds what is sent to the
tasks, whatever their number. A task sends ``k`` rows an item at most, and the
best of all tasks are found in two levels, so no task ranks them all.

Scores are whole numbers; a bound is a sum of doubles that are whole numbers
below 2**53, so it is exact. For queries whose sum could pass that, bounds are widened
by a part in 2**40.

Defined cases: a null, empty or term-free text is no document (it counts
nowhere and scores for nothing); a null or term-free item finds nothing; items with
equal ids are ranked each on its own; documents with equal ids each
take a rank; a null document id comes last among equal scores; no documents or
no items give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import ship, stored, table

WIDTH = 1024   # coordinates of a sketch
ITEMS = 5000   # items of a block
BATCH = 512    # documents whose bounds are one product
CHUNK = 16     # documents rescored before the threshold is looked at again
SALTS = 64     # first-level parts of the final ranking

# Term bytes stay, A-Z become small, all else of ASCII a blank; bytes from 0x80 on are parts of term characters.
_PREPARE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
                 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in turn, as UTF-8."""
    return [t for t in (text or "").encode("utf-8", "surrogatepass").translate(_PREPARE).split(b" ") if t]


def weight(documents: int, df: int) -> int:
    """``floor(1000 ln((2 N + 2) / (2 df + 1)))``."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impact(w: int, tf: int, m: int) -> int:
    """What one occurrence of a term in a query adds to the score of a document."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Queries:
    """A block of items: their terms with repeats, the vocabulary and its weights."""

    def __init__(self, items: list[list[bytes]]) -> None:
        counted = [Counter(t) for t in items]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))} if counted else {}
        self.items = [(np.array([self.vocabulary[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in counted]
        self.coordinate = np.array([xxhash.xxh64_intdigest(t) % WIDTH for t in self.vocabulary], np.int64)
        self.weights = np.zeros(len(self.vocabulary), np.int64)

    def weigh(self, documents: int, df: np.ndarray) -> None:
        self.weights = np.array([weight(documents, int(d)) for d in df], np.int64)

    def lookups(self) -> np.ndarray:
        """Coordinates by items: how often an item's terms hash to each coordinate."""
        out = np.zeros((WIDTH, len(self.items)))
        for i, (t, n) in enumerate(self.items):
            np.add.at(out[:, i], self.coordinate[t], n)
        return out


class Found:
    """The best documents of each item so far: ``(-score, id is null, id, row)``, best first."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.best = k, [[] for _ in range(items)]

    def threshold(self, i: int) -> int:
        """A bound below this cannot enter the result; equal scores still can, by id."""
        return -self.best[i][-1][0] if len(self.best[i]) == self.k else 1

    def add(self, i: int, rows: list[tuple]) -> None:
        self.best[i] = sorted(self.best[i] + rows)[: self.k]


def search_batch(q: Queries, lookups: np.ndarray, docs: list[tuple[int | None, int, Counter]], mean: tuple[int, int], found: Found) -> int:
    """Add a batch's best documents ``(id, terms, query terms' counts)`` to ``found``; the number rescored.

    ``mean`` is (documents, all their terms).
    """
    documents, length = mean
    impacts = []
    sketch = np.zeros((len(docs), WIDTH))
    for d, (_, n, tf) in enumerate(docs):
        m = 25 + (75 * n * documents) // length
        at = np.fromiter(map(q.vocabulary.__getitem__, tf), np.int64, len(tf))
        count = np.fromiter(tf.values(), np.int64, len(tf))
        own = q.weights[at] * ((1_000_000_000 * count) // (1000 * count + 8 * m))
        np.maximum.at(sketch[d], q.coordinate[at], own)
        impacts.append(dict(zip(at.tolist(), own.tolist())))
    bounds = sketch @ lookups
    if bounds.size and bounds.max() >= 2.0**53:
        bounds *= 1 + 2.0**-40
    rescored = 0
    for i, (t, times) in enumerate(q.items):
        near = np.flatnonzero(bounds[:, i] >= found.threshold(i))
        near = near[np.argsort(-bounds[near, i], kind="stable")]
        pairs = list(zip(t.tolist(), times.tolist()))
        for lo in range(0, len(near), CHUNK):
            chunk = near[lo:lo + CHUNK]
            if bounds[chunk[0], i] < found.threshold(i):
                break
            rows = []
            for d in chunk.tolist():
                own = impacts[d]
                score = sum(own[x] * c for x, c in pairs if x in own)
                if score > 0:
                    doc = docs[d][0]
                    rows.append((-score, doc is None, 0 if doc is None else doc))
            rescored += len(chunk)
            found.add(i, rows)
    return rescored


def _counts(docs: DataFrame, q: Queries) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and document frequencies of the block's vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(q.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        n, length, df = 0, 0, np.zeros(len(vocabulary), np.int64)
        for b in batches:
            for t in b.column(0):
                words = terms(t.as_py())
                n += bool(words)
                length += len(words)
                for w in vocabulary.keys() & set(words):
                    df[vocabulary[w]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-2, -1], at))), pa.array(np.concatenate(([n, length], df[at])))], ["t", "n"])

    sums = docs.select("text").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(q.vocabulary) + 2, np.int64)
    df[sums.column("t").to_numpy() + 2] = sums.column("n").to_numpy()
    return int(df[0]), int(df[1]), df[2:]


def _search_block(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """``(at, doc_id, score)`` of one block of items: each task's best, ``at`` the item's place in the block."""
    q = Queries([terms(text) for _, text in items])
    documents, length, df = _counts(docs, q)
    q.weigh(documents, df)
    shared = docs.sparkSession.sparkContext.broadcast(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        lookups, found, held = own.lookups(), Found(len(own.items), k), []
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1)):
                words = terms(text.as_py())
                tf = Counter(w for w in words if w in own.vocabulary)
                if tf:
                    held.append((doc.as_py(), len(words), tf))
                if len(held) == BATCH:
                    search_batch(own, lookups, held, (documents, length), found)
                    held = []
        if held:
            search_batch(own, lookups, held, (documents, length), found)
        rows = [(i, None if none else doc, -minus) for i, best in enumerate(found.best) for minus, none, doc in best]
        yield pa.RecordBatch.from_pydict({"at": [r[0] for r in rows], "doc_id": [r[1] for r in rows], "score": [r[2] for r in rows]},
                                         schema=pa.schema([("at", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "at int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``(doc_id, text)`` and ``(item_id, text)`` -> ``(item_id, rank, doc_id, score)``, ``k`` rows an item at most."""
    spark = docs.sparkSession
    ship(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    found = []

    def block(rows: list[tuple]) -> None:
        best = _search_block(docs, rows, k)
        ids = spark.createDataFrame(pd.DataFrame({"at": pd.array(range(len(rows)), "int32"), "item_id": pd.Series([r[0] for r in rows], dtype=object)}),
                                    f"at int, item_id {kind}")
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        parts = best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        for keys in (["at", "salt"], ["at"]):
            parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        found.append(stored(parts.join(F.broadcast(ids), "at").select("item_id", "rank", "doc_id", "score"), "search-found"))

    rows: list[tuple] = []
    for r in items.select("item_id", "text").toLocalIterator():  # a block at a time on the driver
        rows.append((r[0], r[1]))
        if len(rows) == ITEMS:
            block(rows)
            rows = []
    if rows or not found:
        block(rows)
    return reduce(DataFrame.union, found)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every item of ``benchmark``."""
    return search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


#: Every (item, document) pair with a term in common is scored.
OP12_SQL = r"""
WITH doc_terms AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n FROM doc_terms WHERE len(t) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM doc_terms) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
wanted AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
scored AS (
  SELECT item_id, tf.doc_id, CAST(sum(times * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (term) JOIN df USING (term) JOIN sizes ON sizes.doc_id = tf.doc_id, corpus GROUP BY 1, 2)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""
