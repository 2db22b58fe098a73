"""Packing documents into sequences: dominance reduction, then best fit.

Sizes are whole numbers up to the capacity, so the bin-packing instance is its
histogram: at most ``capacity`` counts, whatever the number of documents. The
plan is made on that histogram (Martello and Toth, 1990): going down from the
largest size, a set of at most three documents that provably dominates every
other way to fill its sequence is fixed for good and the instance shrinks; what
is left is packed best fit, largest first. Sequences are handled as runs of
equal ones, so the plan takes a number of steps that depends on the capacity
alone. Spark does the rest: tokens are counted in one pass over the texts, pieces
are ranked within their size by a range partitioning (no window over a hot
size), and rank looks its place up in the plan.

Defined cases: a null or empty text is one token, the closing id; a text longer
than the capacity is cut into full pieces and a remainder; rows with equal ids
are separate documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from sys import getsizeof

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import ship, stored, table, text_key

CAPACITY = 4096
END = 1
CACHED = 128 << 20  # bytes of words and their ids that a Python worker keeps
SLOT = 110          # bytes of an entry in a dictionary beside its key and value
_LETTERS = "a-zªµºß-öø-ÿ"  # small letters below U+0100
_PIECES = re.compile(f"[{_LETTERS}]+|[^{_LETTERS}]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_BYTES = _byte_letters()


# --- tokens ---------------------------------------------------------------------------------

_tokenizers: dict[str, _Ids] = {}


class _Ids(dict):
    """Word -> its ids as little-endian bytes; forgets everything when full.

    The tokenizer drops white space and never joins text across it, so the ids
    of a text are those of its words in turn. In a word of characters below
    U+0100 without apostrophe (contractions) or ``<`` (control strings), a run
    of letters stands alone too and goes straight to the BPE model.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain: dict[str, bytes] = {}
        self.held = 0  # bytes of both dictionaries

    def _hold(self, into: dict, word: str, ids: bytes) -> None:
        """Keep the ids of a word; both dictionaries are emptied first when they are full."""
        size = getsizeof(word) + getsizeof(ids) + SLOT
        if self.held + size > CACHED:
            self.clear()
            self.plain.clear()
            self.held = 0
        into[word] = ids
        self.held += size

    def encode(self, s: str) -> bytes:
        return np.array(self.tokenizer.encode(s, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _letters(self, s: str) -> bytes:
        if not s.isascii():
            s = "".join(map(_BYTES.__getitem__, s.encode()))
        return np.array([t.id for t in self.tokenizer.model.tokenize(s)], dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        low = word.lower() if max(word) < "\u0100" and "'" not in word and "<" not in word else ""
        if low:
            plain, out = self.plain, []
            for p in _PIECES.findall(low):
                ids = plain.get(p)
                if ids is None:
                    ids = self._letters(p) if p.isalpha() else self.encode(p)
                    if len(p) <= 40:
                        self._hold(plain, p, ids)
                out.append(ids)
            ids = b"".join(out)
        else:
            ids = self.encode(word)
        if len(word) <= 40:
            self._hold(self, word, ids)
        return ids


def token_bytes(text: str | None, path: str) -> bytes:
    """The ids of a text, then ``END``, as little-endian unsigned 32-bit numbers."""
    ids = _tokenizers.get(path)
    if ids is None:
        ids = _tokenizers[path] = _Ids(path)
    text = text or ""
    end = END.to_bytes(4, "little")
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to str.split but not to the tokenizer
        return ids.encode(text) + end
    return b"".join(map(ids.__getitem__, text.split())) + end


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, text_key, piece, start, length, ids_crc32)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, piece, start, length, crc = [], [], [], [], []
            texts = b.column(2)
            for i in range(len(texts)):
                ids = token_bytes(texts[i].as_py(), path)
                for k, lo in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[lo:lo + 4 * capacity]
                    at.append(i)
                    piece.append(k)
                    start.append(lo // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                ["doc_id", "text_key", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").mapInArrow(
        run, f"doc_id {kind}, text_key long, piece int, start long, length long, ids_crc32 long")


# --- the plan -------------------------------------------------------------------------------


class Plan:
    """Places for the documents of a histogram ``{size: count}``.

    ``slots[size]`` lists runs ``(count, first sequence, offset)``: the next
    ``count`` documents of that size go to consecutive sequences, at ``offset``.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        self.capacity, self.sequences = capacity, 0
        self.left = {s: n for s, n in counts.items() if n}
        self.slots: dict[int, list[tuple[int, int, int]]] = {s: [] for s in self.left}
        self.fixed = 0  # sequences settled by dominance
        self._reduce()
        self._best_fit()

    def _place(self, sizes: list[int], n: int) -> None:
        """``n`` new sequences that each hold ``sizes``."""
        offset = 0
        for s in sizes:
            self.slots[s].append((n, self.sequences, offset))
            self.left[s] -= n
            offset += s
        self.sequences += n
        self.fixed += n

    def _reduce(self) -> None:
        """Fix dominating sets, largest document first."""
        sizes = np.array(sorted(self.left), dtype=np.int64)
        low = 0  # sizes below this index are used up

        def fitting(room: int, taken: dict[int, int]) -> int:
            """Index of the largest size up to ``room`` with a document left beside ``taken``; -1 if none."""
            i = int(np.searchsorted(sizes, room, side="right")) - 1
            while i >= low and self.left[int(sizes[i])] - taken.get(int(sizes[i]), 0) < 1:
                i -= 1
            return i if i >= low else -1

        for at in range(len(sizes) - 1, -1, -1):
            s = int(sizes[at])
            while self.left[s]:
                while self.left[int(sizes[low])] == 0 and low < at:
                    low += 1
                room, taken = self.capacity - s, {s: 1}
                small: list[int] = []  # the smallest documents, up to three, beside this one
                i = low
                while i < len(sizes) and len(small) < 3:
                    z = int(sizes[i])
                    small += [z] * min(3 - len(small), self.left[z] - taken.get(z, 0))
                    i += 1
                most = 0
                while most < len(small) and sum(small[:most + 1]) <= room:
                    most += 1
                if most == 0:
                    self._place([s], self.left[s])  # nothing fits beside any of this size
                    break
                j = fitting(room, taken)
                best = int(sizes[j])
                n = self.left[s] // 2 if best == s else min(self.left[s], self.left[best])
                if s + best == self.capacity:
                    self._place([s, best], max(n, 1))
                    continue
                if most == 1:
                    # while the smallest two stay as they are or grow, the same holds for the next pair
                    self._place([s, best], max(n, 1))
                    continue
                if most == 2:
                    pair = self._best_pair(sizes, low, room, taken)
                    if best >= sum(pair):
                        self._place([s, best], 1)
                        continue
                    if pair[0] == best and self._tight(sizes, low, room, taken, pair):
                        self._place([s, *pair], 1)
                        continue
                break  # no set of this size's documents dominates

    def _best_pair(self, sizes: np.ndarray, low: int, room: int, taken: dict[int, int]) -> tuple[int, int]:
        """Two documents left with the largest sum that fits, larger first."""
        free = [(int(z), self.left[int(z)] - taken.get(int(z), 0)) for z in sizes[low:] if z < room]
        free = [(z, n) for z, n in free if n > 0]
        best, i, j = (0, 0), 0, len(free) - 1
        while i <= j:
            if i == j and free[i][1] < 2:
                break
            total = free[i][0] + free[j][0]
            if total <= room:
                if total > sum(best) or total == sum(best) and free[j][0] > best[0]:
                    best = (free[j][0], free[i][0])
                i += 1
            else:
                j -= 1
        return best

    def _tight(self, sizes: np.ndarray, low: int, room: int, taken: dict[int, int], pair: tuple[int, int]) -> bool:
        """No two documents that lie between the pair's members fit together in its place."""
        hold = dict(taken)
        for z in pair:
            hold[z] = hold.get(z, 0) + 1
        between = [int(z) for z in sizes[low:] if pair[1] <= z <= pair[0] and self.left[int(z)] - hold.get(int(z), 0) > 0]
        two = [z for z in between for _ in range(min(2, self.left[z] - hold.get(z, 0)))][:2]
        return len(two) < 2 or sum(two) > room

    def _best_fit(self) -> None:
        """Largest size first into the fullest sequence that has room; runs of equal sequences at once."""
        open_: dict[int, list[list[int]]] = {}  # room -> runs [first sequence, count]
        for s in sorted((s for s, n in self.left.items() if n), reverse=True):
            n = self.left[s]
            rooms = sorted(r for r in open_ if r >= s)
            while n and rooms:
                r = rooms[0]
                first, count = open_[r].pop()
                if not open_[r]:
                    del open_[r]
                    rooms.pop(0)
                k = min(n, count)
                if count > k:
                    if r not in open_:
                        rooms.insert(0, r)
                    open_.setdefault(r, []).append([first + k, count - k])
                self.slots[s].append((k, first, self.capacity - r))
                n -= k
                self._reopen(open_, rooms, r - s, first, k, s)
            each = self.capacity // s
            while n:
                k, full = (n // each, each) if n >= each else (1, n)
                for t in range(full):
                    self.slots[s].append((k, self.sequences, t * s))
                self._reopen(open_, None, self.capacity - full * s, self.sequences, k, s)
                self.sequences += k
                n -= k * full
            self.left[s] = 0

    @staticmethod
    def _reopen(open_: dict, rooms: list[int] | None, room: int, first: int, count: int, size: int) -> None:
        if room <= 0:
            return
        if rooms is not None and room >= size and room not in open_:
            rooms.insert(0, room)  # smaller than every room still listed
            rooms.sort()
        runs = open_.setdefault(room, [])
        runs.append([first, count])


# --- the packing ----------------------------------------------------------------------------


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, text)`` -> pieces with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    ship(spark)
    cut = stored(pieces(docs, path, capacity), "pack-pieces")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for pdf in batches:
            size = pdf["length"].to_numpy()
            rank = pdf.groupby("length").cumcount().to_numpy() + np.array([seen.get(s, 0) for s in size.tolist()], dtype=np.int64)
            for s, k in zip(*np.unique(size, return_counts=True)):
                seen[int(s)] = seen.get(int(s), 0) + int(k)
            yield pdf.assign(part=np.int32(part), rank=rank)

    # by range, so a size with a third of all pieces still spreads over many tasks
    order = ["length", "doc_id", "piece", "ids_crc32"]
    dealt = cut.repartitionByRange(n, *order).mapInPandas(ranked, cut.schema.simpleString()[7:-1].replace(":", " ") + ", part int, rank long")
    dealt = stored(dealt, "pack-ranked")
    # a size lies in consecutive parts: capacity + n rows at most
    counts = dealt.groupBy("length", "part").count().collect()
    before, total = {}, {}
    for s, p, k in sorted(map(tuple, counts)):
        before[s, p] = total.get(s, 0)
        total[s] = total.get(s, 0) + k
    plan = Plan(total, capacity)
    starts = spark.sparkContext.broadcast(before)
    runs = spark.sparkContext.broadcast({
        s: (np.cumsum([0] + [k for k, _, _ in r[:-1]]), np.array([f for _, f, _ in r]), np.array([o for _, _, o in r]))
        for s, r in plan.slots.items()})

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for (s, p), g in pdf.groupby(["length", "part"]).indices.items():
                rank = pdf["rank"].to_numpy()[g] + starts.value[s, p]
                first_rank, first, at = runs.value[s]
                i = np.searchsorted(first_rank, rank, side="right") - 1
                sequence[g], offset[g] = first[i] + rank - first_rank[i], at[i]
            yield pdf.drop(columns=["part", "rank"]).assign(sequence_id=sequence, offset=offset)

    return dealt.mapInPandas(placed, cut.schema.simpleString()[7:-1].replace(":", " ") + ", sequence_id long, offset long")


def word_bpe() -> str:
    """The tokenizer file of the query."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"), word_bpe()).drop("text_key")
