"""Phrase collocation mining with weighted acyclic automata over word hashes.

Per language, every phrase of two to ``LONGEST`` words that occurs at least ``least``
times is a candidate. Its worst cut into two parts gives its score; a candidate inside a
longer one nearly as frequent is dropped; the best ``top`` of a language are ranked.

Counting goes by phrase length, a pass over the texts for one word, for two, and for three and more. A
phrase cannot be frequent unless all shorter ones in it are, so a pass leaves
out what the passes before rule out, by bit sets of fixed size (:mod:`bits`): they let too much through
when there are more frequent phrases than bits, never too little.

A task counts the phrases of its texts and, sorted by the hashes of their words, builds
a weighted automaton from them layer by layer: an arc reads a word, its weight is the count
of the phrase read so far, and states from which the same continuations with the same
weights leave are one. The automaton is cut by ranges of the first word's hash; the
pieces of a range meet in one task, are united, weights summed, and phrases below ``least`` go. A
task builds a new automaton every ``HELD`` words, so its memory doesn't grow with its
texts; hashes spread first words evenly, and a frequent word's phrases
are already counted when they meet.

The parts of a candidate are frequent too, so their counts are read off the united automata:
part lookups are dealt to the range of their first word and walk its automaton.

Words are 64-bit hashes seeded by language; two frequent words of a language with one hash
are found by an exact check, which moves on to the next seed.

Defined cases: a null or empty text has no words; a null language is ``und``; rows with equal
ids count as often as they stand there; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.bits import bit_set, has
from strandline.llm.common import ship, stored, table

LEAST = 30        # occurrences of a candidate
LONGEST = 4       # words of the longest phrase
TOP = 2000        # phrases of a language
HELD = 2_000_000  # words a task counts in one automaton
SALTS = 64        # first-level parts of the final ranking
RANGES = 4096     # ranges of the first word's hash at most; a third of the shuffle partitions otherwise
_MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

# A-Z small, the separators of pieces full stops, tabs blanks
_PREPARE = bytes(0x2E if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text in turn, with ``.`` between its pieces."""
    flat = (text or "").encode("utf-8", "surrogatepass").translate(_PREPARE).replace(b".", b" . ")
    return flat.split()


def _mixed(h: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its beginning and its next word."""
    with np.errstate(over="ignore"):
        x = (h ^ (h >> np.uint64(29))) * np.uint64(_MIX[0]) + then
        return (x ^ (x >> np.uint64(32))) * np.uint64(_MIX[1])


def phrase_hash(labels: np.ndarray) -> np.ndarray:
    """One hash for each row of word hashes (0: no more words)."""
    out = labels[:, 0].copy()
    for j in range(1, labels.shape[1]):
        out = np.where(labels[:, j] == 0, out, _mixed(out, labels[:, j]))
    return out


# --- automata -------------------------------------------------------------------------------


class Automaton:
    """A weighted acyclic automaton over phrases of word hashes.

    Layer ``d`` holds the arcs read at place ``d``: state ``s`` owns arcs ``cut[d][s]`` to
    ``cut[d][s + 1]`` with rising ``label``, ``weight`` (count of the phrase that ends with the arc, 0 for
    none) and ``to``, the state of the next layer (-1: the phrase goes no further).
    """

    def __init__(self, layers: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        self.layers = layers

    @staticmethod
    def build(labels: np.ndarray, counts: np.ndarray) -> Automaton:
        """From distinct phrases, sorted, as rows of hashes padded with 0, and their counts."""
        places = labels.shape[1]
        fresh, arcs = np.zeros(len(labels), bool), []
        if len(labels):
            fresh[0] = True
        state = np.zeros(len(labels), np.int64)
        for d in range(places):  # prefixes of the phrases, one arc for each
            fresh = fresh.copy()
            fresh[1:] |= labels[1:, d] != labels[:-1, d]
            real = labels[:, d] != 0
            first = np.flatnonzero(fresh & real)
            ends = real & (labels[:, d + 1] == 0 if d + 1 < places else True)
            arc = np.cumsum(fresh & real) - 1
            weight = np.zeros(len(first), np.int64)
            weight[arc[ends]] = counts[ends]
            arcs.append((state[first], labels[first, d], weight))
            state = arc
        # merge equal states from the last layer back
        layers, below = [], np.full(len(arcs[-1][0]), -1, np.int64)
        for d in range(places - 1, -1, -1):
            source, label, weight = arcs[d]
            before = len(arcs[d - 1][0]) if d else 1
            size = np.bincount(source, minlength=before)
            start = np.cumsum(size) - size
            same = _equal_states(size, start, label, weight, below)
            keep = np.flatnonzero((same == np.arange(before)) & (size > 0))
            number = np.full(before, -1, np.int64)
            number[keep] = np.arange(len(keep))
            pick = np.isin(source, keep)
            layers.append((np.concatenate(([0], np.cumsum(size[keep]))), label[pick], weight[pick], below[pick]))
            below = np.where(size > 0, number[same], -1)
        return Automaton(layers[::-1])

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases, as rows of hashes, and their counts."""
        places, out, counts = len(self.layers), [], []
        if not len(self.layers[0][0]) - 1:
            return np.empty((0, places), np.uint64), np.empty(0, np.int64)
        paths, state = np.zeros((1, places), np.uint64), np.zeros(1, np.int64)
        for d, (cut, label, weight, to) in enumerate(self.layers):
            size = cut[state + 1] - cut[state]
            row = np.repeat(np.arange(len(state)), size)
            arc = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + cut[state][row]
            paths = paths[row]
            paths[:, d] = label[arc]
            ends = weight[arc] > 0
            out.append(paths[ends])
            counts.append(weight[arc][ends])
            on = to[arc] >= 0
            paths, state = paths[on], to[arc][on]
        return np.concatenate(out), np.concatenate(counts)

    def weights(self, labels: np.ndarray) -> np.ndarray:
        """Counts of the phrases asked for, 0 where the automaton has none: all walk it together, a place at a time."""
        result, state = np.zeros(len(labels), np.int64), np.zeros(len(labels), np.int64)
        if not len(self.layers[0][0]) - 1:
            return result
        for d in range(labels.shape[1]):
            more = labels[:, d] != 0
            result[more] = 0  # what is asked for is longer than what was read so far
            if d >= len(self.layers):
                continue
            cut, label, weight, to = self.layers[d]
            on = np.flatnonzero((state >= 0) & more)
            lo, end = cut[state[on]], cut[state[on] + 1]
            hi, want = end.copy(), labels[on, d]
            while (lo < hi).any():  # binary search of each state's own arcs
                mid = (lo + hi) // 2
                less = (lo < hi) & (label[np.minimum(mid, len(label) - 1)] < want)
                lo, hi = np.where(less, mid + 1, lo), np.where((lo < hi) & ~less, mid, hi)
            hit = lo < end
            hit[hit] = label[lo[hit]] == want[hit]
            result[on[hit]] = weight[lo[hit]]
            state[on] = -1
            state[on[hit]] = to[lo[hit]]
        return result

    def encode(self) -> bytes:
        head = np.array([len(self.layers), *[n for layer in self.layers for n in (len(layer[0]), len(layer[1]))]], "<i8")
        words_, parts = np.unique(np.concatenate([layer[1] for layer in self.layers])), []
        for cut, label, weight, to in self.layers:
            parts += [np.diff(cut).astype("<u4"), np.searchsorted(words_, label).astype("<u4"), weight.astype("<u8"), to.astype("<i4")]
        parts = [np.ascontiguousarray(p).view(np.uint8).reshape(len(p), p.itemsize).T.tobytes() for p in parts]  # byte planes compress better
        return zlib.compress(np.array([len(words_)], "<i8").tobytes() + head.tobytes() + words_.astype("<u8").tobytes() + b"".join(parts), 1)

    @staticmethod
    def decode(data: bytes) -> Automaton:
        raw = zlib.decompress(data)
        n_words, places = (int(x) for x in np.frombuffer(raw, "<i8", 2))
        sizes = np.frombuffer(raw, "<i8", 2 * places, 16).tolist()
        at = 16 + 16 * places
        vocabulary = np.frombuffer(raw, "<u8", n_words, at)
        at += 8 * n_words
        layers = []

        def plane(n: int, kind: str) -> np.ndarray:
            nonlocal at
            width = np.dtype(kind).itemsize
            out = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel()
            at += n * width
            return out

        for i in range(places):
            cuts, arcs = sizes[2 * i], sizes[2 * i + 1]
            size, label, weight, to = plane(cuts - 1, "<u4"), plane(arcs, "<u4"), plane(arcs, "<u8"), plane(arcs, "<i4")
            layers.append((np.concatenate(([0], np.cumsum(size, dtype=np.int64))), vocabulary[label], weight.astype(np.int64), to.astype(np.int64)))
        return Automaton(layers)


def _equal_states(size: np.ndarray, start: np.ndarray, label: np.ndarray, weight: np.ndarray, to: np.ndarray) -> np.ndarray:
    """For each state the first one with the same arcs: grouped by a hash of the arcs, then compared arc by arc."""
    if not len(label):
        return np.arange(len(size))
    arc = _mixed(_mixed(label, weight.view(np.uint64)), to.view(np.uint64))
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(arc, dtype=np.uint64)))
        signature = _mixed(sums[start + size] - sums[start], size.astype(np.uint64))
    _, first, group = np.unique(signature, return_index=True, return_inverse=True)
    same = first[group]
    row = np.repeat(np.arange(len(size)), size)
    other = start[same][row] + np.arange(len(row)) - start[row]
    fits = size[same] == size
    inside = np.where(fits[row], other, np.arange(len(row)))
    differ = (label[inside] != label) | (weight[inside] != weight) | (to[inside] != to)
    fits &= np.bincount(row, differ, len(size)) == 0
    return np.where(fits, same, np.arange(len(size)))


def united(automata: list[Automaton], least: int = 1) -> Automaton:
    """The union of automata, weights summed, phrases below ``least`` left out."""
    parts = [a.phrases() for a in automata]
    labels, counts = np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])
    labels, counts = _summed(labels, counts)
    return Automaton.build(labels[counts >= least], counts[counts >= least])


def _summed(labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases sorted, each once, with the sum of its counts."""
    if not len(labels):
        return labels, counts
    order = np.lexsort(labels.T[::-1])
    labels, counts = labels[order], counts[order]
    fresh = np.concatenate(([True], (labels[1:] != labels[:-1]).any(axis=1)))
    return labels[fresh], np.add.reduceat(counts, np.flatnonzero(fresh))


def range_of(first: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a first word's hash; ``ranges`` is a power of two."""
    return (first >> np.uint64(64 - ranges.bit_length() + 1)).astype(np.int64) if ranges > 1 else np.zeros(len(first), np.int64)


# --- counting -------------------------------------------------------------------------------


def _seed(lang: str, turn: int) -> int:
    return xxhash.xxh64_intdigest(lang, turn)


class _Numbers(dict):
    """Word -> its number in the order of first sight; the full stop between pieces is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Shard:
    """Counts of the phrases of ``low`` to ``high`` words in one language's texts of a task."""

    def __init__(self, lang: str, low: int, high: int, turn: int, allowed: list[np.ndarray]) -> None:
        self.low, self.high, self.allowed, self.seed = low, high, allowed, _seed(lang, turn)
        self.number, self.row = _Numbers({b".": 0}), []

    def add(self, tokens: list[bytes]) -> None:
        self.row.extend(map(self.number.__getitem__, tokens))
        self.row.append(0)

    def phrases(self) -> tuple[np.ndarray, np.ndarray, int, list[bytes]]:
        """The phrases counted, sorted by their hashes, how often each occurs, the number of words, and the possible words."""
        ids, spelt = np.array(self.row, np.int64), list(self.number)
        words_ = int(np.count_nonzero(ids))
        own = np.array([0, *[xxhash.xxh64_intdigest(w, self.seed) or 1 for w in spelt[1:]]], np.uint64)
        possible = np.flatnonzero(has(self.allowed[0], own) if self.allowed else np.ones(len(own), bool))
        possible = possible[possible > 0]
        possible = possible[np.argsort(own[possible])]
        # numbered anew by hash, so that phrases come out in the order of their hashes; 0: no possible word
        again = np.zeros(len(own), np.int64)
        again[possible] = np.arange(1, len(possible) + 1)
        ids, hashes = again[ids], np.concatenate((np.zeros(1, np.uint64), own[possible]))
        out, counts = [np.empty((0, self.high), np.uint64)], [np.empty(0, np.int64)]
        at, group, h = np.flatnonzero(ids), None, None  # where a phrase starts, its number, its hash
        for k in range(1, self.high + 1):
            if k == 1:
                group, h = ids[at], hashes[ids[at]]
            else:
                before = np.zeros(len(ids) + 1, bool)
                before[at] = True  # the phrase without its last word is possible; without its first word it must be too
                on = np.flatnonzero(before[at + 1])
                at, nxt = at[on], ids[np.minimum(at[on] + k - 1, len(ids) - 1)]
                group, h = group[on] * len(hashes) + nxt, _mixed(h[on], hashes[nxt])
                if k - 1 < len(self.allowed):  # phrases of this length were counted: only frequent ones go on
                    on = has(self.allowed[k - 1], h)
                    at, group, h = at[on], group[on], h[on]
            _, first, group, n = np.unique(group, return_index=True, return_inverse=True, return_counts=True)
            if k >= self.low:
                labels = np.zeros((len(first), self.high), np.uint64)
                for j in range(k):
                    labels[:, j] = hashes[ids[at[first] + j]]
                out.append(labels)
                counts.append(n.astype(np.int64))
        labels, sums = np.concatenate(out), np.concatenate(counts)
        if self.low < self.high:
            order = np.lexsort(labels.T[::-1])
            labels, sums = labels[order], sums[order]
        return labels, sums, words_, [spelt[i] for i in possible.tolist()]


def _count(docs: DataFrame, low: int, high: int, turn: int, allowed: list[np.ndarray], ranges: int) -> DataFrame:
    """``(lang, part, data)``: a task's automata, cut by range.

    When single words are counted, ``data`` of part -1 is their number, as text; when
    pairs are, the parts below hold the possible words of each range, as they are spelt.
    """
    shared = docs.sparkSession.sparkContext.broadcast(allowed)

    def parts(lang: str, shard: _Shard) -> Iterator[pa.RecordBatch]:
        labels, counts, n, spelt = shard.phrases()
        cut = np.searchsorted(range_of(labels[:, 0], ranges), np.arange(ranges + 1))
        found = [(part, Automaton.build(labels[lo:hi], counts[lo:hi]).encode()) for part, (lo, hi) in enumerate(zip(cut, cut[1:])) if hi > lo]
        if low == 1:
            found.append((-1, str(n).encode()))
        if low == 2:  # by their hashes, as the phrases
            own = range_of(np.array([xxhash.xxh64_intdigest(w, shard.seed) or 1 for w in spelt], np.uint64), ranges)
            cut = np.searchsorted(own, np.arange(ranges + 1)).tolist()
            found += [(-2 - part, zlib.compress(b"\n".join(spelt[lo:hi]), 1)) for part, (lo, hi) in enumerate(zip(cut, cut[1:])) if hi > lo]
        yield pa.RecordBatch.from_pydict({"lang": [lang] * len(found), "part": [p for p, _ in found], "data": [d for _, d in found]},
                                         schema=pa.schema([("lang", pa.string()), ("part", pa.int32()), ("data", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}
        held = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                tokens = words(text.as_py())
                if lang not in shards:
                    shards[lang] = _Shard(lang, low, high, turn, shared.value)
                shards[lang].add(tokens)
                held += len(tokens)
                if held >= HELD:
                    while shards:
                        yield from parts(*shards.popitem())
                    held = 0
        while shards:
            yield from parts(*shards.popitem())

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(run, "lang string, part int, data binary")


def _unite(counted: DataFrame, least: int) -> DataFrame:
    """``(lang, part, data)`` -> one row a part: the united automaton of a range, only with phrases of ``least`` or
    more; the sum of the numbers of words; the spellings of a range, each once."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[1] >= 0:
            data = united([Automaton.decode(d) for d in pdf["data"]], least).encode()
        elif key[1] == -1:
            data = str(sum(int(d) for d in pdf["data"])).encode()
        else:
            data = zlib.compress(b"\n".join(sorted(set().union(*[zlib.decompress(d).split(b"\n") for d in pdf["data"]]))), 1)
        return pd.DataFrame({"lang": [key[0]], "part": [key[1]], "data": [data]})

    return counted.groupBy("lang", "part").applyInPandas(run, "lang string, part int, data binary")


def _phrases(automata: DataFrame) -> DataFrame:
    """``(lang, ids, f, h)``: the phrases of automata as arrays of signed word hashes, their counts, and a hash of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, data in zip(b.column(0).to_pylist(), b.column(1)):
                labels, counts = Automaton.decode(data.as_py()).phrases()
                for lo in range(0, len(labels), 50_000):
                    some = labels[lo:lo + 50_000]
                    size = (some != 0).sum(axis=1)
                    ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)),
                                                   pa.array(some[some != 0].view(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some)), ids, pa.array(counts[lo:lo + 50_000]), pa.array(phrase_hash(some).view(np.int64))],
                        ["lang", "ids", "f", "h"])

    return automata.where("part >= 0").select("lang", "data").mapInArrow(run, "lang string, ids array<long>, f long, h long")


def _spellings(counted: DataFrame, frequent: DataFrame, turn: int) -> DataFrame:
    """``(lang, id, word)`` of the frequent words, from the words that were possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, data in zip(b.column(0).to_pylist(), b.column(1)):
                told = [w for w in zlib.decompress(data.as_py()).split(b"\n") if w]
                h = np.array([xxhash.xxh64_intdigest(w, _seed(lang, turn)) or 1 for w in told], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(told), pa.string()), pa.array(h.view(np.int64)),
                                                  pa.array([w.decode("utf-8", "surrogatepass") for w in told], pa.string())], ["lang", "id", "word"])

    told = counted.where("part <= -2").select("lang", "data").mapInArrow(run, "lang string, id long, word string")
    return told.join(frequent.select("lang", F.get("ids", F.lit(0)).alias("id")), ["lang", "id"])


def _weigh(asked: DataFrame, automata: DataFrame, ranges: int) -> DataFrame:
    """``(lang, of, cut, side, ids)`` with ``f``, the count that the automata hold for each phrase asked for."""
    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            first = np.array([i[0] for i in pdf["ids"]], np.int64).view(np.uint64)
            yield pdf.assign(part=range_of(first, ranges).astype(np.int32))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        labels = np.zeros((len(left), LONGEST), np.uint64)
        for row, ids in zip(labels, left["ids"]):
            row[:len(ids)] = np.asarray(ids, np.int64).view(np.uint64)
        f = sum((Automaton.decode(d).weights(labels) for d in right["data"]), np.zeros(len(left), np.int64))
        return left[["lang", "of", "cut", "side"]].assign(f=f)

    schema = "lang string, of long, cut int, side string"
    dealt = asked.mapInPandas(locate, f"{schema}, ids array<long>, part int")
    return dealt.groupBy("lang", "part").cogroup(automata.groupBy("lang", "part")).applyInPandas(run, f"{schema}, f long")


def mined(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``(text, lang)`` -> ``(lang, rank, phrase, a, l, r, n, score)``."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("text", "lang")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 3)
    ranges = min(RANGES, 1 << (tasks - 1).bit_length())
    turn = 0
    while True:
        one = stored(_unite(_count(docs, 1, 1, turn, [], ranges), least), "phrases-1")
        frequent = stored(_phrases(one), "phrases-words")
        bits = [bit_set(frequent, "h")]
        two = stored(_unite(_count(docs, 2, 2, turn, bits, ranges), least), "phrases-2")
        spelt = stored(_spellings(two, frequent, turn), "phrases-spelt")
        if not spelt.groupBy("lang", "id").count().where("count > 1").limit(1).count():
            break
        turn += 1  # two frequent words with one hash
    found = stored(_phrases(two), "phrases-pairs")
    bits.append(bit_set(found, "h"))
    longer = stored(_unite(_count(docs, 3, LONGEST, turn, bits, ranges), least), "phrases-3")
    automata = one.union(two).union(longer).where("part >= 0")
    candidates = stored(found.union(_phrases(longer)), "phrases-candidates")

    # the counts of the parts of every cut
    cut = F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("cut")
    cuts = candidates.select("lang", F.col("h").alias("of"), "ids", cut)
    sides = F.explode(F.create_map(F.lit("l"), F.slice("ids", F.lit(1), F.col("cut")),
                                   F.lit("r"), F.slice("ids", F.col("cut") + 1, F.size("ids") - F.col("cut"))))
    asked = cuts.select("lang", "of", "cut", sides.alias("side", "ids"))
    weighed = _weigh(asked, automata, ranges).groupBy("lang", "of", "cut").agg(
        F.sum(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.sum(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    scored = weighed.join(candidates.select("lang", F.col("h").alias("of"), F.col("f").alias("a")), ["lang", "of"])
    scored = scored.withColumn("score", F.expr("CAST((CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + r) AS BIGINT)"))
    worst = scored.groupBy("lang", "of").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("s"))

    # inside a longer candidate nearly as frequent
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1),
                                  lambda k: F.transform(F.sequence(F.lit(1), F.size("ids") - k + 1), lambda i: F.slice("ids", i, k))))
    inside = candidates.where(F.size("ids") > 2).select("lang", F.explode(inner).alias("ids"), "f")
    around = inside.groupBy("lang", "ids").agg(F.max("f").alias("around"))
    around = around.join(candidates.select("lang", "ids", F.col("h").alias("of")), ["lang", "ids"]).select("lang", "of", "around")
    left = worst.join(around, ["lang", "of"], "left").where("around IS NULL OR CAST(around AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * 80")

    # their words
    places = candidates.select("lang", F.col("h").alias("of"), F.posexplode("ids").alias("at", "id"))
    spoken = left.join(places, ["lang", "of"]).join(spelt, ["lang", "id"]).groupBy("lang", "of").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    total = one.where("part = -1").select("lang", F.col("data").cast("string").cast("long").alias("n"))
    rows = left.join(spoken, ["lang", "of"]).join(total, "lang").select(
        "lang", "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "n", F.col("s.score").alias("score"))
    rows = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):  # the best of each part, then of those
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language of ``documents``."""
    return mined(table(spark, sf_dir, "documents", "text", "lang"))


#: Every phrase of one to four words, counted as strings.
OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
tokens AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM tokens GROUP BY 1),
counted AS (
  SELECT lang, phrase, k, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM tokens, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY 1, 2, 3 HAVING count(*) >= 30),
candidates AS (SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w FROM counted WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, cut, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * c.f) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, inner_, max(f) AS around FROM (
    SELECT lang, f, array_to_string(w[i:i + size - 1], ' ') AS inner_
    FROM candidates, (SELECT unnest([2, 3]) AS size), LATERAL (SELECT unnest(range(1, k - size + 2)) AS i) WHERE size < k) GROUP BY 1, 2),
kept AS (
  SELECT w.* FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.inner_ = w.phrase
  WHERE i.around IS NULL OR 100 * i.around < 80 * w.a)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM (
  SELECT k.*, t.n, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept k JOIN totals t USING (lang))
WHERE rank <= 2000"""
