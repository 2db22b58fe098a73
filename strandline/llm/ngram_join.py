"""Exact Jaccard self-join of documents' word n-gram sets on a prefix tree.

A document is the set of its distinct ``words``-word shingles, each a 64-bit hash
(texts without words have no set). Two documents link when the Jaccard
similarity of their sets is at least ``percent`` per cent; a component is all that
is reachable by links. Equal sets are one set from the start.

1. **Can a set have a partner at all?** A partner shares all but
   ``n - ceil(percent n / 100)`` of its shingles. The shingles whose hash lies in the lowest
   quarter of all hashes are looked at by every set, so those that only one
   set holds are known exactly from one aggregate; a set with more of them than it may
   miss is out. That ends sets that merely quote a common passage.
2. **Candidates.** Of the sets left, each keeps its prefix in one global order (looked-at
   shingles by rising frequency, then the others by hash). Linked sets share
   a shingle of their prefixes, so the components of "shares one" hold every link.
   These grow together with the input (a chance shingle is enough), so each is narrowed: the hashes are cut into
   one segment more than linked sets of such a size can differ in shingles, and some spare ones; linked sets
   have an equal segment even without each one's spare segments with the fewest
   shingles. Sets are dealt by the components of "shares a segment", each once.
3. **Prefix tree.** Within such a group the shingles are ordered by falling
   frequency and the sets stored in a trie of path-compressed nodes. A set
   probes the whole trie at once, level by level: the overlap counted on a path is
   shared by all sets below it, a subtree is dropped as soon as the overlap so far and
   the lengths that remain on both sides cannot reach the bound, taken whole as
   soon as the overlap alone does, and skipped when all of it is in the probe's component.
   A group of n near copies thus yields n - 1 edges, never its pairs.

Groups of more than ``GROUP`` shingles are split by a salt: parts are joined
first, then one set of each component found, and only if several components are left, the
sets outside the largest one against all parts. No link is lost and no
task holds more than two parts.

Defined cases: a null or empty text, or one without a word, has an empty set, links with
nothing and is its own component; rows with equal ids are separate documents; a null id
takes part but is never the smallest unless its component has no other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.bits import bit_set, has, keep_possible
from strandline.llm.common import ship, stored, table
from strandline.llm.components import components

GROUP = 2_000_000   # shingles that a task holds of one part of a group
CACHED = 300_000    # words of which a Python worker keeps the hash
STEP = 32           # shingles read of a path before its bound is looked at again
SPARE = 8           # segments for each one that is left out
LOOKED_AT = -(1 << 63) + (1 << 62)  # signed hashes below are the lowest quarter

# every byte as a small letter, white space as a blank
_PREPARE = bytes(0x20 if c in b"\t\n\x0b\x0c\r " else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Words(dict):
    """Word (bytes) -> its hash; forgets everything when full and keeps no long words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = h
        return h


_words = _Words()


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles (of the whole sequence if it is shorter than one)."""
    tokens = [t for t in (text or "").encode("utf-8", "surrogatepass").translate(_PREPARE).split(b" ") if t]
    if not tokens:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_words.__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(h))
    with np.errstate(over="ignore"):
        x = np.full(len(h) - size + 1, np.uint64(size))
        for i in range(size):  # the places of a shingle's words count
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return np.unique(x.view(np.int64))


def _least(n, percent: int):
    """Shingles of a set of ``n`` that a partner must share: ``ceil(percent n / 100)``."""
    return (percent * n + 99) // 100


def _list_array(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *parts])))


def shingle_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, rk, sid, n, m, keys)``, one row per input row.

    ``rk`` is a hash of id and text, ``sid`` of the set, ``n`` the set's size; ``keys`` its
    smallest hashes: the ``m`` looked-at ones, and at least a prefix.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                b = whole.slice(lo, 500)
                sets = [shingle_set(t.as_py(), words) for t in b.column(2)]
                m = [int(np.searchsorted(s, LOOKED_AT)) for s in sets]
                keys = [s[:max(k, len(s) - _least(len(s), percent) + 1)] for s, k in zip(sets, m)]
                sid = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(sid), pa.array([len(s) for s in sets], pa.int64()), pa.array(m, pa.int32()), _list_array(keys)],
                    ["doc_id", "rk", "sid", "n", "m", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _keyed(docs).mapInArrow(run, f"doc_id {kind}, rk long, sid long, n long, m int, keys array<long>")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text", F.col("text").isNull()).alias("rk"), "text")


# --- candidates -----------------------------------------------------------------------------


def possible(sets: DataFrame, percent: int) -> DataFrame:
    """``(sid, rk, n, m, keys)`` of the distinct sets that can have a partner."""
    spare = F.col("n") - F.floor((F.col("n") * percent + 99) / 100)
    looked = sets.where("n > 0").select("sid", F.explode(F.slice("keys", 1, F.col("m"))).alias("key"))
    owners = looked.groupBy("key").agg(F.min("sid").alias("sid"), F.max("sid").alias("other"))
    alone = owners.where("sid = other").groupBy("sid").agg(F.count("*").alias("alone"))
    each = sets.where("n > 0").groupBy("sid").agg(F.first("n").alias("n"))
    left = each.join(alone, "sid", "left").where(F.coalesce("alone", F.lit(0)) <= spare).select("sid")
    left = stored(left, "ngram-possible")
    rows = keep_possible(sets.where("n > 0").select("sid", "rk", "n", "m", "keys"), "sid", bit_set(left, "sid"))
    one = rows.groupBy("sid").agg(F.first(F.struct("rk", "n", "m", "keys")).alias("s"))
    return one.join(left, "sid").select("sid", "s.*")


def candidates(sets: DataFrame, percent: int) -> DataFrame:
    """``(sid, n, m, keys)`` distinct sets -> ``(sid, root)`` of those that share a prefix shingle, by component."""
    keys = sets.select("sid", "n", "m", F.posexplode("keys").alias("pos", "key"))
    often = keys.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    each = Window.partitionBy("sid")
    looked = F.col("pos") < F.col("m")
    shared = (keys.join(often, "key")
              .withColumn("c", F.count_if(looked).over(each))
              .withColumn("at", F.row_number().over(each.orderBy(~looked, "df", "key"))))
    prefix = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    kept = stored(shared.where(~looked | (F.col("m") - F.col("c") + F.col("at") <= prefix)).select("sid", "key"), "ngram-prefixes")
    least = kept.groupBy("key").agg(F.min("sid").alias("b"), F.count("*").alias("k")).where("k > 1")
    edges = kept.join(least, "key").where("sid <> b").select(F.col("sid").alias("a"), "b").distinct()
    found = components(edges, "ngram-candidates")
    return stored(found.select(F.col("a").alias("sid"), "root").union(found.select("root", "root").distinct()), "ngram-clusters")


def whole_sets(docs: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """``chosen`` ``(sid, rk, root)`` -> ``(sid, root, n, tokens)`` with the whole sets, taken from the texts again."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_set(chosen, "rk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            whole = whole.filter(pa.array(has(bits.value, whole.column(0).to_numpy())))
            for lo in range(0, whole.num_rows, 500):
                b = whole.slice(lo, 500)
                yield pa.RecordBatch.from_arrays([b.column(0), _list_array([shingle_set(t.as_py(), words) for t in b.column(1)])], ["rk", "tokens"])

    texts = _keyed(docs).select("rk", "text").mapInArrow(run, "rk long, tokens array<long>")
    return texts.join(chosen, "rk").select("sid", "root", F.size("tokens").alias("n"), "tokens")


def size_classes(percent: int, most: int) -> np.ndarray:
    """First sizes of classes up to ``most`` and beyond: linked sets are of one class or of two that follow each other."""
    first = [1, 2]
    while first[-2] <= most:
        first.append(max(first[-1] + 1, 100 * (first[-1] - 1) // percent + 1))
    return np.array(first)


def segments(size: np.ndarray, flat: np.ndarray, group: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets (sizes, sorted hashes one after the other, group of each) -> ``(row, key)``; linked sets of a group have an equal key.

    A set takes part with the sets of its class and the next, and with those of its class and the one before. Of linked sets with
    sizes up to ``u`` and ``100 u / percent``, at most ``differ`` shingles are in only one; so of ``differ + 1 + spare``
    segments ``1 + spare`` are equal at least, and one of them is left when each set leaves out the ``spare`` last ones in one order.
    """
    first = size_classes(percent, int(size.max(initial=1)))
    own = np.searchsorted(first, size, side="right") - 1
    row = np.repeat(np.arange(len(size)), size)
    place = flat.view(np.uint64) ^ np.uint64(1 << 63)  # rises within a set
    place >>= np.uint64(32)
    out = []
    with np.errstate(over="ignore"):
        mixed = flat.view(np.uint64) ^ (flat.view(np.uint64) >> np.uint64(31))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * np.uint64(0x9E3779B97F4A7C15))))
        for low in (own, own - 1):
            u = first[low + 1] - 1
            differ = np.where(low < 0, 0, (u + 100 * u // percent) * (100 - percent) // (100 + percent))
            spare = differ // SPARE + 1
            many = differ + 1 + spare
            start = np.cumsum(many) - many
            cell = start[row] + (place * many[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            count = np.bincount(cell, minlength=many.sum())
            end = np.cumsum(count)
            of = np.repeat(np.arange(len(size)), many)
            key = sums[end] - sums[end - count]
            for x in (np.arange(len(of)) - start[of], low[of], group[of]):
                key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + x.astype(np.int64).view(np.uint64)
            key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            order = np.lexsort((key, -count, of))
            # sets that differ in no shingle are one
            order = order[((np.arange(len(of)) - start[of] <= differ[of]) & (differ[of] > 0))]
            out.append((of[order], key[order].view(np.int64)))
    return np.concatenate([r for r, _ in out]), np.concatenate([k for _, k in out])


def narrowed(sets: DataFrame, percent: int) -> DataFrame:
    """``(sid, root, n, tokens)`` -> ``(sid, root)`` of the sets that share a segment with another of their group, by component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                b = whole.slice(lo, 500)
                size = b.column(2).value_lengths().to_numpy().astype(np.int64)
                row, key = segments(size, b.column(2).flatten().to_numpy(), b.column(1).to_numpy(), percent)
                yield pa.RecordBatch.from_arrays([pa.array(b.column(0).to_numpy()[row]), pa.array(key)], ["sid", "key"])

    keys = stored(sets.select("sid", "root", "tokens").mapInArrow(run, "sid long, key long"), "ngram-segments")
    least = keys.groupBy("key").agg(F.min("sid").alias("b"), F.max("sid").alias("other")).where("b <> other").select("key", "b")
    edges = keys.join(least, "key").where("sid <> b").select(F.col("sid").alias("a"), "b").distinct()
    found = components(edges, "ngram-narrowed")
    return stored(found.select(F.col("a").alias("sid"), "root").union(found.select("root", "root").distinct()), "ngram-groups")


# --- the prefix tree of one group -----------------------------------------------------------


class Trie:
    """Sets as paths over one order of their shingles (most frequent first), paths compressed to nodes.

    Node arrays: ``low`` and ``high`` depth, the sets ``first`` to ``last`` below it, the
    smallest and largest size among them, and ``ends``, the set that ends at it (or -1).
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.size = np.array([len(s) for s in sets])
        row = np.repeat(np.arange(len(sets)), self.size)
        vocabulary, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(vocabulary), np.int64)
        rank[np.lexsort((vocabulary, -counts))] = np.arange(len(vocabulary))
        flat = rank[inverse]
        flat = flat[np.lexsort((flat, row))]
        cut = np.cumsum(self.size)[:-1]
        paths = np.split(flat, cut)
        code = [p.astype(">u4").tobytes() for p in paths]
        self.order = np.array(sorted(range(len(sets)), key=code.__getitem__))  # position in the tree -> input
        self.paths = [paths[i] for i in self.order]
        self.size = self.size[self.order]
        self.flat = np.concatenate(self.paths)
        self.offset = np.cumsum(np.concatenate(([0], self.size[:-1])))
        self.width = len(vocabulary)
        self._build()

    def _common(self) -> list[int]:
        out = [0]
        for a, b in zip(self.paths, self.paths[1:]):
            k = min(len(a), len(b))
            differ = a[:k] != b[:k]
            at = int(differ.argmax()) if k else 0
            out.append(at if k and differ[at] else k)
        return out

    def _build(self) -> None:
        m = len(self.paths)
        depth, first, last, up, ends = [0], [0], [m], [-1], [-1]

        def node(d: int, f: int, e: int) -> int:
            depth.append(d)
            first.append(f)
            last.append(m)
            up.append(0)
            ends.append(e)
            return len(depth) - 1

        stack = [0]
        for i, common in enumerate(self._common()):
            while depth[stack[-1]] > common:
                child = stack.pop()
                last[child] = i
                if depth[stack[-1]] < common:  # the paths part inside an edge
                    stack.append(node(common, first[child], -1))
                up[child] = stack[-1]
            stack.append(node(len(self.paths[i]), i, i))
        while len(stack) > 1:
            child = stack.pop()
            up[child] = stack[-1]
        # long edges in steps, so that a bound is looked at before all of one is read
        low = [0 if u < 0 else depth[u] for u in up]
        for v in range(1, len(depth)):
            while depth[v] - low[v] > STEP:
                w = node(low[v] + STEP, first[v], -1)
                last[w], up[w] = last[v], up[v]
                low.append(low[v])
                up[v], low[v] = w, depth[w]
        self.low, self.high, self.first, self.last, self.ends = (np.array(x) for x in (low, depth, first, last, ends))
        up_of = np.array(up)
        by_parent = np.argsort(up_of, kind="stable")[1:]  # all but the root
        self.children = by_parent
        self.child_cut = np.searchsorted(up_of[by_parent], np.arange(len(depth) + 1))
        spans = np.stack((self.first, self.last), 1).ravel()
        padded = np.append(self.size, self.size[-1])
        self.shortest = np.minimum.reduceat(padded, spans)[::2]
        self.longest = np.maximum.reduceat(padded, spans)[::2]

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of nodes, and for each the place of its parent in ``nodes``."""
        count = self.child_cut[nodes + 1] - self.child_cut[nodes]
        parent = np.repeat(np.arange(len(nodes)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return self.children[self.child_cut[nodes][parent] + at], parent

    def join(self, component: np.ndarray, probes: np.ndarray, percent: int) -> np.ndarray:
        """Components of the sets, by position; given those known and the sets that probe (the others only get probed)."""
        component, place = component.copy(), np.arange(len(self.paths))
        held = np.zeros(self.width, bool)
        enough = lambda overlap, sizes: (100 + percent) * overlap >= percent * sizes
        for r in np.flatnonzero(probes):
            open_ = (component != component[r]) & ((place > r) | ~probes)
            if not open_.any():
                continue
            below = np.concatenate(([0], np.cumsum(open_)))
            path, n = self.paths[r], self.size[r]
            held[path] = True
            nodes, parent = self.below(np.zeros(1, np.int64))
            overlap = np.zeros(len(nodes), np.int64)
            hits: list[np.ndarray] = []
            while len(nodes):
                some = below[self.last[nodes]] > below[self.first[nodes]]
                nodes, overlap = nodes[some], overlap[some]
                if not len(nodes):
                    break
                low, high = self.low[nodes], self.high[nodes]
                count = high - low
                start = np.cumsum(count) - count
                at = np.arange(count.sum()) - np.repeat(start - self.offset[self.first[nodes]] - low, count)
                overlap = overlap + np.add.reduceat(held[self.flat[at]], start, dtype=np.int64)
                rest = n - np.searchsorted(path, self.flat[self.offset[self.first[nodes]] + high - 1], side="right")
                # the size below that does best: as many shingles to come as the probe has
                size = np.clip(high + rest, self.shortest[nodes], self.longest[nodes])
                alive = enough(overlap + np.minimum(rest, size - high), n + size)
                sure = alive & enough(overlap, n + self.longest[nodes])
                for v in nodes[sure]:
                    hits.append(np.flatnonzero(open_[self.first[v]:self.last[v]]) + self.first[v])
                alive &= ~sure
                end = self.ends[nodes]
                done = alive & (end >= 0)
                done[done] = open_[end[done]] & enough(overlap[done], n + self.size[end[done]])
                hits.append(end[done])
                nodes, overlap = nodes[alive], overlap[alive]
                nodes, parent = self.below(nodes)
                overlap = overlap[parent]
            held[path] = False
            found = np.unique(component[np.concatenate(hits)]) if hits else np.empty(0, np.int64)
            if len(found):
                least = min(found[0], component[r])
                component[np.isin(component, found) | (component == component[r])] = least
        return component


def _group_edges(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Edges ``(a, b)`` from the sets of one group to the first of their component."""
    pdf = pdf.drop_duplicates("sid")
    trie = Trie([np.asarray(t, np.int64) for t in pdf["tokens"]])
    sid, label = pdf["sid"].to_numpy()[trie.order], pdf["label"].to_numpy()[trie.order]
    _, known = np.unique(label, return_inverse=True)
    found = trie.join(known, pdf["probe"].to_numpy(bool)[trie.order], percent)
    _, head, component = np.unique(found, return_index=True, return_inverse=True)
    other = sid != sid[head][component]
    return pd.DataFrame({"a": sid[other], "b": sid[head][component][other]})


def group_edges(dealt: DataFrame, percent: int) -> DataFrame:
    """``(root, low, high, sid, label, probe, tokens)`` -> edges within each group ``(root, low, high)``."""
    keys = ["root", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for pdf in batches:
            key = pdf[keys].to_numpy()
            if rest and len(pdf) and (rest[0][keys].iloc[0].to_numpy() != key[0]).any():
                yield _group_edges(pd.concat(rest), percent)
                rest = []
            cut = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()
            for lo, hi in zip([0, *cut], [*cut, len(pdf)]):
                rest.append(pdf.iloc[lo:hi])
                if hi < len(pdf):
                    yield _group_edges(pd.concat(rest), percent)
                    rest = []
        if rest:
            yield _group_edges(pd.concat(rest), percent)

    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = dealt.select(*keys, "sid", "label", "probe", "tokens").repartition(n, *keys).sortWithinPartitions(*keys)
    return rows.mapInPandas(run, "a long, b long")


def _dealt(sets: DataFrame, label, probe, low, high) -> DataFrame:
    return sets.select("root", low.alias("low"), high.alias("high"), "sid", label.alias("label"), probe.alias("probe"), "tokens")


def links(sets: DataFrame, groups: DataFrame, percent: int, group: int = GROUP) -> DataFrame:
    """``(sid, n, tokens)`` and the groups ``(sid, root)`` of sets -> edges whose components are those of all links."""
    yes, none = F.lit(True), F.lit(0)
    sized = groups.join(sets.select("sid", "n").distinct(), "sid")
    weight = sized.groupBy("root").agg(F.sum("n").alias("weight"))
    parts = weight.select("root", F.ceil(F.col("weight") / group).cast("int").alias("parts"))
    to = stored(groups.join(parts, "root"), "ngram-dealt")
    sets = sets.select("sid", "n", "tokens").join(to, "sid")
    part = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    edges = stored(group_edges(_dealt(sets, F.col("sid"), yes, part, none), percent), "ngram-edges")
    if not to.where("parts > 1").limit(1).count():
        return edges
    split = stored(sets.where("parts > 1"), "ngram-split")

    def labelled(edges: DataFrame) -> DataFrame:
        found = components(edges, "ngram-parts").select(F.col("a").alias("sid"), F.col("root").alias("label"))
        return split.join(found, "sid", "left").withColumn("label", F.coalesce("label", "sid"))

    # one set of each component that the parts have, dealt by another salt
    heads = labelled(edges).where("sid = label")
    again = heads.groupBy("root").agg(F.ceil(F.sum("n") / group).cast("int").alias("k"))
    salt = F.pmod(F.xxhash64("sid", F.lit(7)), F.col("k")).cast("int")
    more = group_edges(_dealt(heads.join(again, "root"), F.col("sid"), yes, salt, F.lit(-1)), percent)
    edges = stored(edges.union(more), "ngram-edges")
    # what is still outside its group's largest component meets every part
    known = stored(labelled(edges), "ngram-labels")
    sizes = known.groupBy("root", "label").agg(F.sum("n").alias("w"))
    top = sizes.groupBy("root").agg(F.max_by("label", F.struct("w", "label")).alias("top"), F.sum("w").alias("all"), F.max("w").alias("most"))
    top = top.where("all > most").select("root", "top", F.ceil((F.col("all") - F.col("most")) / group).cast("int").alias("outer"))
    known = known.join(top, "root").withColumn("out", F.col("label") != F.col("top"))
    outer = F.pmod(F.xxhash64("sid", F.lit(11)), F.col("outer")).cast("int")
    count = lambda c: F.explode(F.sequence(none, F.col(c) - 1))
    probing = _dealt(known.where("out").withColumn("own", outer).withColumn("each", count("parts")), F.col("label"), yes, F.col("own"), F.col("each"))
    probed = _dealt(known.withColumn("own", part).withColumn("each", count("outer")), F.col("label"), F.lit(False), F.col("each"), F.col("own"))
    both = probing.union(probed).groupBy("root", "low", "high", "sid").agg(
        F.first("label").alias("label"), F.max("probe").alias("probe"), F.first("tokens").alias("tokens"))
    return edges.union(group_edges(both, percent))


def linked(docs: DataFrame, words: int = 4, percent: int = 85, group: int = GROUP) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, n_shingles, component_id)``, one row per input row."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sets = stored(shingle_sets(docs, words, percent), "ngram-shingles")
    some = stored(possible(sets, percent), "ngram-partners")
    clusters = candidates(some.select("sid", "n", "m", "keys"), percent)
    chosen = stored(some.select("sid", "rk").join(clusters, "sid"), "ngram-chosen")
    whole = stored(whole_sets(docs, chosen, words), "ngram-sets")
    edges = stored(links(whole, narrowed(whole, percent), percent, group), "ngram-links")
    found = components(edges, "ngram").select(F.col("a").alias("sid"), "root")
    each = sets.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    rooted = each.join(found, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    classes = rooted.join(least, "root").select("sid", "least")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return sets.select("doc_id", "sid", "n").join(classes, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of 4-word shingles and its component at a Jaccard similarity of 0.85 or more."""
    return linked(table(spark, sf_dir, "documents", "doc_id", "text"))


#: All links by an equality join on shingles, then what each document reaches.
OP11_SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM tokens),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reached AS (SELECT doc_id, doc_id AS id FROM tokens UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.id)
SELECT r.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(r.id) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id"""
