"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Fingerprints: per document one pass over its words in Arrow batches, a bit set
when more than half of the shingle hashes have it.

Links: distinct fingerprints within ``max_bits`` differing bits. Two such
fingerprints agree wholly on one of ``max_bits + 1`` bit blocks, so every
fingerprint is dealt by each (block, bits of the block): a lossless blocking.
Inside such a group the index works: fingerprints are sorted by Gray rank, runs
of them become leaves, runs of leaves upper nodes, and a node keeps only the
mask of bits all its members share and their pattern. Two nodes whose shared
patterns already differ in more than ``max_bits`` bits are pruned with all that
is below them; two whose bits cannot differ more are joined without a look at
their members; differences accumulate on the way down. Links are folded into
components at once, so a group of n near copies yields n - 1 edges, never its
pairs. A group above ``GROUP`` fingerprints is split by a salt into parts that
meet pairwise, so no task holds more than two parts.

Components of the folded edges: :mod:`strandline.llm.components`.

Defined cases: a null or empty text has fingerprint zero and links like any
other; rows with equal ids are one node per fingerprint; a null id takes part
but is never a smallest id unless its component has no other; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import matching, ship, stored, table, text_key
from strandline.llm.components import components

SEED = 42
GROUP = 50_000   # fingerprints a task compares at once
LEAF = 16        # members of a leaf, and children of a node
_SPACES = bytes(0x20 if c in b"\t\n\x0b\x0c\r " else c for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PREPARE = bytes(_LOWER[_SPACES[c]] for c in range(256))


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of one text as an unsigned 64-bit number."""
    if not text:
        return 0
    tokens = text.encode("utf-8", "surrogatepass").translate(_PREPARE).split(b" ")
    flat = b" ".join([t for t in tokens if t])
    if not flat:
        return 0
    at = np.flatnonzero(np.frombuffer(flat, np.uint8) == 0x20)
    n = len(at) + 1
    h = xxhash.xxh64_intdigest
    if n <= words:
        return h(flat, SEED)
    starts = np.concatenate(([0], at + 1))[: n - words + 1].tolist()
    ends = np.concatenate((at, [len(flat)]))[words - 1:].tolist()
    hashes = np.array([h(flat[i:j], SEED) for i, j in zip(starts, ends)], dtype=">u8")
    bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
    full = len(bits) // 255 * 255
    counts = bits[full:].sum(axis=0, dtype=np.int64)
    if full:  # sums of 255 bits fit a byte
        counts += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, text_key, fp)``; one row per input row, ``fp`` as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2)
            fps = np.array([fingerprint(texts[i].as_py(), words) for i in range(len(texts))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"])

    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


# --- the index inside one group -------------------------------------------------------------


def _gray_order(fps: np.ndarray) -> np.ndarray:
    """Order by Gray rank: the number whose Gray code a fingerprint is."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return np.argsort(rank, kind="stable")


def _levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask of shared bits, pattern) of the nodes of each level, the fingerprints themselves first."""
    out = [(np.full(len(fps), ~np.uint64(0)), fps)]
    while len(out[-1][0]) > 1:
        mask, pattern = out[-1]
        cut = np.arange(0, len(mask), LEAF)
        ones = np.bitwise_and.reduceat(pattern & mask, cut)
        zeros = np.bitwise_and.reduceat(~pattern & mask, cut)
        out.append((ones | zeros, ones))
    return out


class _Sets:
    """Components of the members of one group, as the smallest index of each."""

    def __init__(self, n: int) -> None:
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.of[a], self.of[b]
            keep = x != y
            a, b, x, y = a[keep], b[keep], x[keep], y[keep]
            if not len(a):
                return
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while True:  # point all at their roots
                up = self.of[self.of]
                if np.array_equal(up, self.of):
                    break
                self.of = up


def group_components(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For distinct fingerprints: the position of each one's component's first member in Gray order.

    Pairs of nodes are expanded from the root down; a slice of pairs at a time,
    so memory stays bounded, and pairs already in one component are skipped.
    """
    levels, sets = _levels(fps), _Sets(len(fps))
    span = [LEAF**k for k in range(len(levels))]
    work = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        k, a, b = work.pop()
        if len(a) > 1 << 16:  # depth first in slices
            half = len(a) // 2
            work += [(k, a[half:], b[half:]), (k, a[:half], b[:half])]
            continue
        mask, pattern = levels[k]
        shared = mask[a] & mask[b]
        apart = np.bitwise_count((pattern[a] ^ pattern[b]) & shared)
        near = apart <= max_bits
        if k == 0:
            sets.join(a[near], b[near])
            continue
        # at most: bits that differ on the shared mask and every bit outside it
        sure = near & (apart + np.bitwise_count(~shared) <= max_bits)
        last = len(fps) - 1
        for x, y in zip(a[sure].tolist(), b[sure].tolist()):
            i = np.arange(x * span[k], min((x + 1) * span[k], last + 1))
            j = np.arange(y * span[k], min((y + 1) * span[k], last + 1))
            sets.join(np.concatenate((i, j)), np.full(len(i) + len(j), i[0]))
        a, b = a[near & ~sure], b[near & ~sure]
        if not len(a):
            continue
        # nodes that lie wholly in one and the same component need no look
        cut = np.arange(0, len(fps), span[k])
        low, high = np.minimum.reduceat(sets.of, cut), np.maximum.reduceat(sets.of, cut)
        todo = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
        a, b = a[todo], b[todo]
        n = len(levels[k - 1][0])
        i = (a[:, None] * LEAF + np.arange(LEAF))[:, :, None]
        j = (b[:, None] * LEAF + np.arange(LEAF))[:, None, :]
        i, j = np.broadcast_arrays(i, j)
        ok = (i < n) & (j < n) & (i <= j) if k > 1 else (i < n) & (j < n) & (i < j)
        same = a == b
        ok &= same[:, None, None] | (i < n)
        far, own = ok & ~same[:, None, None], ok & same[:, None, None]
        # pairs of different nodes after those within a node, which sit close in Gray order
        work.append((k - 1, i[far], j[far]))
        work.append((k - 1, i[own], j[own]))
    return sets.of


def _edges(pdf: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    fps = np.unique(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
    fps = fps[_gray_order(fps)]
    root = group_components(fps, max_bits)
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return pd.DataFrame({"a": fps[linked].view(np.int64), "b": fps[root[linked]].view(np.int64)})


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``(fp)`` distinct -> edges ``(a, b)`` with the components of all links within ``max_bits`` bits."""
    blocks = max_bits + 1
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    keys = F.array(*[
        F.struct(F.lit(i).alias("block"),
                 F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
        for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))])
    dealt = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.block", "k.bits")
    size = dealt.groupBy("block", "bits").count().where("count > 1")
    parts = F.ceil(F.col("count") / GROUP).cast("int")
    dealt = dealt.join(size.withColumn("parts", parts), ["block", "bits"])
    # part p of a split group meets every part: it goes to all (low, high) with p among them
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                       lambda q: F.struct(F.least(q, F.col("own")).alias("low"), F.greatest(q, F.col("own")).alias("high")))
    dealt = dealt.withColumn("own", own).select("fp", "block", "bits", F.explode(each).alias("p"))
    dealt = dealt.select("fp", "block", "bits", "p.low", "p.high")
    keys = ["block", "bits", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []  # rows of the group the last batch ended in
        for pdf in batches:
            key = pdf[keys].to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if rest and len(pdf) and (rest[0][keys].iloc[0].to_numpy() != key[0]).any():
                yield _edges(pd.concat(rest), max_bits)
                rest = []
            ends = [0, *cut.tolist(), len(pdf)]
            for lo, hi in zip(ends, ends[1:]):
                part = pdf.iloc[lo:hi]
                if hi < len(pdf):
                    whole = pd.concat([*rest, part]) if rest else part
                    rest = []
                    if len(whole) > 1:
                        yield _edges(whole, max_bits)
                else:
                    rest.append(part)
        if rest:
            yield _edges(pd.concat(rest), max_bits)

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, *keys).sortWithinPartitions(*keys)
            .mapInPandas(run, "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, text_key, fp, root, component_id)``, one row per input row.

    ``root`` is the component's smallest fingerprint, ``component_id`` its smallest id.
    """
    ship(docs.sparkSession)
    fps = stored(fingerprints(docs, words), "simhash-fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(distinct.select("fp"), max_bits), "simhash")
    rooted = distinct.join(found.select(F.col("a").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return fps.join(classes, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, links at 4 bits or fewer."""
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay when each component keeps one document.

    The document with the component's smallest id stays; of several rows with
    that id, those of the smallest fingerprint and text key, and one of them if
    they repeat id and text.
    """
    found = stored(near_duplicates(docs.select("doc_id", "text"), words, max_bits), "simhash-classes")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "text_key")).alias("m"))
    kept = matching(docs, best.select("m.doc_id", "m.text_key").distinct(), "left_semi")
    twice = found.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates(["doc_id", "text"]) if twice else kept
