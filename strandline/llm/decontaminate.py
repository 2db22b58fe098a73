"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into pieces of at most ``PIECE`` words. Passages are
TF-IDF vectors over the words the pieces use (other words cannot meet one),
with document frequencies counted over all documents. A distributed randomised
SVD of all passages of all documents (64 words each) and of the pieces, which
together weigh like all passages together, gives a latent space of ``RANK``
dimensions: tasks multiply their rows and return partial products by block of
terms, which are summed by block in two levels; only terms x rank numbers reach
the driver. Texts are turned into term numbers once and stored; counts, products
and search read those.

Every document is then searched whole. Pairs of a text and a piece that the check
below cannot accept, because no stretch of the text holds enough of the piece's
words in the piece's order, are left out first (``reachable``, lossless). Overlapping windows of 32 and 64 words
are projected, counted from each document's first word, and a window whose cosine
with a piece reaches ``COSINE`` is a candidate; so is every place where a piece of
three words or more stands word for word, whatever is around it. A candidate counts as a leak when the longest common subsequence of
words with the piece covers ``COVER`` of it, and so does that with the piece's
answer, its last sentence; pieces under eight words must be covered wholly.
There is no limit on candidates. Items are taken in blocks of ``ITEMS``, a pass
over the documents each, so what is broadcast is bounded.

Defined cases: a null or empty text or item leaks nothing and is found nowhere;
items with equal ids are searched each; repeated rows give repeated results; an
empty benchmark gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import matching, ship, stored, table, text_key

PIECE = 48
ITEMS = 5000
PASSAGE = 64             # words of a corpus passage
RANK, EXTRA, ROUNDS = 128, 16, 2
COSINE = 0.5
COVER = 0.5
STEP = 8                 # words of a block; windows are 4 and 8 blocks and start at every block
TERMS = 64               # terms of a block of the products
PARTS = 64               # groups in which tasks' blocks are summed first
CHUNK = 2048             # passages multiplied together
DENSE = 512              # most frequent terms, in a matrix of a chunk
BATCH = 400_000          # words searched together, unless one text is longer
NUMBERED = 1 << 17       # characters whose words are numbered together, unless one text is longer
ALIGNED = 2048           # stretches compared with their pieces at a time
TOGETHER = 8192          # words projected together, unless one text is longer
STRETCHES = 2_000_000    # numbers held while a batch's texts are sorted out, unless one stretch takes more
# letters and digits stay, other ASCII characters separate words; text is lower-cased before
_SPLIT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def places(terms: list[int]) -> dict[int, int]:
    """Term -> bits of its places."""
    at: dict[int, int] = {}
    for i, x in enumerate(terms):
        at[x] = at.get(x, 0) | 1 << i
    return at


@dataclass
class Piece:
    """Part of a benchmark item, as term numbers from 1 on."""

    item: int | None
    terms: list[int]
    answer: list[int]

    def __post_init__(self) -> None:
        self.at, self.answer_at = places(self.terms), places(self.answer)
        self.run = np.array(self.terms, np.int32)


def pieces_of(items: list[tuple[int, str | None]]) -> tuple[list[Piece], dict[bytes, int]]:
    vocabulary: dict[bytes, int] = {}
    out = []
    for item, text in items:
        number = lambda t: [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(t)]
        terms = number(text)
        parts = max(1, -(-len(terms) // PIECE))
        cut = [len(terms) * i // parts for i in range(parts + 1)]
        last = [a for a in map(number, re.split(r"[.!?\n]+", text or "")) if len(a) > 1][-1:]
        for lo, hi in zip(cut, cut[1:]):
            if hi > lo:
                out.append(Piece(item, terms[lo:hi], last[0] if last and hi == len(terms) and len(last[0]) <= hi - lo else terms[lo:hi]))
    return out, vocabulary


def common(n: int, at: dict[int, int], b: list[int]) -> int:
    """Longest common subsequence of ``n`` terms at the places ``at`` with ``b``, a bit per term."""
    v = full = (1 << n) - 1
    for x in b:
        if (m := at.get(x)) and (y := m & v):
            v = ((v + y) | (v - y)) & full
    return n - v.bit_count()


def leaks(piece: Piece, region: list[int]) -> float:
    """Covered part of the piece if ``region`` holds it, else 0; long regions in overlapping parts."""
    n = len(piece.terms)
    need = COVER if n >= 8 else 1.0
    best, size = 0.0, 2 * n + 2 * STEP
    for lo in range(0, max(1, len(region) - size + n), n):
        part = region[lo:lo + size]
        if sum(map(piece.at.__contains__, part)) < need * n:
            continue  # too few of its words for a subsequence that long
        got = common(n, piece.at, part) / n
        if got >= need and got > best and common(len(piece.answer), piece.answer_at, part) >= need * len(piece.answer):
            best = got
    return best


# --- statistics and latent space ------------------------------------------------------------


class Numbers:
    """Numbers of the words of many texts at once: a trie of eight bytes a step, its steps in a hash table."""

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        steps: dict[tuple[int, bytes], int] = {}  # (step before, bytes) -> step
        last = {}
        for w, x in vocabulary.items():
            at = 0
            for i in range(0, len(w), 8):
                at = steps.setdefault((at, w[i:i + 8]), len(steps) + 1)
            last[at] = x
        self.number = np.array([last.get(i, 0) for i in range(len(steps) + 1)], np.int32)
        before = np.array([b for b, _ in steps], np.uint64)
        spelled = np.frombuffer(b"".join(x.ljust(8, b"\0") for _, x in steps), "<u8")
        self.bits = (8 * len(steps)).bit_length()
        slot = self.slots(before, spelled)
        order = np.argsort(slot, kind="stable")
        self.begin = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.before, self.spelled, self.step = before[order], spelled[order], order + 1

    def slots(self, before: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        mixed = (spelled ^ before * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def next(self, before: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """The step that each of these bytes makes; 0 for none."""
        out = np.zeros(len(spelled), np.int64)
        slot = self.slots(before, spelled)
        at, end = self.begin[slot], self.begin[slot + 1]
        todo = np.flatnonzero(at < end)
        while len(todo):
            k = at[todo]
            same = (self.spelled[k] == spelled[todo]) & (self.before[k] == before[todo])
            out[todo[same]] = self.step[k[same]]
            todo = todo[~same]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
        return out

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the ``words`` of the texts behind each other, 0 for other words; and how many words each text has."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        texts = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
        edge = np.cumsum([0] + [len(t) + 1 for t in texts])
        data = b" %b%b" % (b" ".join(texts).translate(_SPLIT), b" " * (16 + -int(edge[-1]) % 8))
        inside = np.frombuffer(data, np.uint8) != 32
        turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        at, left = turns[::2], turns[1::2] - turns[::2]
        sizes = np.diff(np.searchsorted(at, edge + 1))
        eight = np.frombuffer(data, "<u8")
        step = np.zeros(len(at), np.int64)
        todo = np.arange(len(at))
        while len(todo):
            k, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
            spelled = eight[k] >> shift | eight[k + 1] << np.uint64(1) << np.uint64(63) - shift
            spelled &= np.uint64(2 ** 64 - 1) >> ((8 - np.minimum(left, 8)) << 3).astype(np.uint64)
            step[todo] = found = self.next(step[todo].astype(np.uint64), spelled)
            on = np.flatnonzero((found > 0) & (left > 8))
            todo, at, left = todo[on], at[on] + 8, left[on] - 8
        return self.number[step], sizes


def encoded(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, text_key, terms)``: every whole text as term numbers of 4 bytes, 0 for words of no piece. Written once, read by all passes."""
    shared = docs.sparkSession.sparkContext.broadcast(Numbers(vocabulary))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        for b in batches:
            out, texts, size = [], [], 0
            for t in b.column(2):
                texts.append(t.as_py())
                size += len(texts[-1] or "")
                if size >= NUMBERED:
                    out.append(numbers.of(texts))
                    texts, size = [], 0
            out.append(numbers.of(texts))
            ids, sizes = (np.concatenate(x) for x in zip(*out))
            ends = pa.array(np.concatenate(([0], np.cumsum(4 * sizes))), pa.int32())
            terms = pa.Array.from_buffers(pa.binary(), len(sizes), [None, ends.buffers()[1], pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), terms], ["doc_id", "text_key", "terms"])

    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return stored(rows.mapInArrow(run, f"doc_id {kind}, text_key long, terms binary"), "leaks-terms")


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The term numbers of lists, or of their 4 bytes each, behind each other, and where each list begins (one more for the end)."""
    if pa.types.is_list(lists.type):
        cut, ids = lists.offsets.to_numpy(), lists.flatten().to_numpy(zero_copy_only=False)
    else:
        _, ends, data = lists.buffers()
        cut = np.frombuffer(ends, np.int32)[lists.offset:lists.offset + len(lists) + 1] // 4
        ids = np.frombuffer(data or b"", np.int32)[cut[0]:cut[-1]]
    return ids, (cut - cut[0]).astype(np.int64)


def document_frequencies(texts: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Documents that hold each of ``size`` terms, over all documents, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size + 1, np.int64)
        for b in batches:
            ids, cut = flat(b.column(0))
            key = np.repeat(np.arange(len(cut) - 1), np.diff(cut)) * (size + 1) + ids
            n += np.bincount(distinct(key[ids > 0]) % (size + 1), minlength=size + 1)
            n[0] += len(cut) - 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], ["term", "n"])

    out = np.zeros(size + 1, np.int64)
    for r in texts.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]  # one row per term of the block at most
    return out[1:], int(out[0])


def sums(w: np.ndarray, x: np.ndarray, row: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of ``w * x[row]`` over the runs that begin at ``begin``, all runs of a length in one product."""
    size = np.diff(begin, append=len(row))
    order = np.argsort(size, kind="stable")
    out = np.empty((len(begin), x.shape[1]), x.dtype)
    for runs in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(runs):
            at = begin[runs, None] + np.arange(size[runs[0]])
            out[runs] = np.matmul(w[at][:, None], x[row[at]])[:, 0]
    return out


def products(ids: np.ndarray, cut: np.ndarray, idf: np.ndarray, q: np.ndarray, dense: int = DENSE) -> tuple[np.ndarray, int]:
    """``A' A q`` for the texts' passages as rows of ``A``, TF-IDF of length 1; and how many rows aren't zero.

    The ``dense`` terms of least idf, most of the words, go through a matrix, the others one by one.
    """
    sizes, v = np.diff(cut), len(idf)
    first = np.concatenate(([0], np.cumsum(-(-sizes // PASSAGE))))
    passage = np.repeat(first[:-1], sizes) + (np.arange(len(ids)) - np.repeat(cut[:-1], sizes)) // PASSAGE
    known = ids > 0
    passage, terms = passage[known], ids[known].astype(np.int64) - 1
    often = np.argsort(idf, kind="stable")[:dense]
    column = np.full(v, -1)
    column[often] = np.arange(len(often))
    z, n, q_often = np.zeros(q.shape), 0, q[often]
    edges = np.searchsorted(passage, np.arange(0, first[-1] + CHUNK, CHUNK))
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        key, count = np.unique((passage[lo:hi] - k * CHUNK) * v + terms[lo:hi], return_counts=True)
        row, t = np.divmod(key, v)
        w = count * idf[t]
        norm = np.sqrt(np.bincount(row, w * w, minlength=CHUNK))
        n += np.count_nonzero(norm)
        w = (w / norm[row]).astype(np.float32)
        in_matrix = column[t] >= 0
        a = np.zeros((CHUNK, len(often)), np.float32)
        a[row[in_matrix], column[t[in_matrix]]] = w[in_matrix]
        y = a @ q_often
        row, t, w = row[~in_matrix], t[~in_matrix], w[~in_matrix]
        begin = np.flatnonzero(np.diff(row, prepend=-1))
        y[row[begin]] += sums(w, q, t, begin)
        z[often] += a.T @ y
        by_term = np.argsort(t, kind="stable")
        row, t, w = row[by_term], t[by_term], w[by_term]
        begin = np.flatnonzero(np.diff(t, prepend=-1))
        z[t[begin]] += sums(w, y, row, begin)
    return z, n


def _times(texts: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``A' A q`` divided by the number of rows, over the passages of all texts, summed by blocks of terms."""
    shared = texts.sparkSession.sparkContext.broadcast((idf, q.astype(np.float32)))
    schema = "at int, part int, z binary, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, q = shared.value
        z, n, part = np.zeros(q.shape), 0, TaskContext.get().partitionId() % PARTS
        for b in batches:
            more, rows = products(*flat(b.column(0)), idf, q)
            z += more
            n += rows
        at = list(range(0, len(z), TERMS)) if n else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array([part] * len(at), pa.int32()),
             pa.array([z[lo:lo + TERMS].astype(np.float32).tobytes() for lo in at], pa.binary()), pa.array([n] * len(at), pa.int64())],
            ["at", "part", "z", "n"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        z = sum(np.frombuffer(x, np.float32).astype(float) for x in pdf["z"])
        return pd.DataFrame({"at": pdf["at"].iloc[:1], "part": pdf["part"].iloc[:1], "z": [z.astype(np.float32).tobytes()], "n": [pdf["n"].sum()]})

    sums = texts.select("terms").mapInArrow(run, schema).groupBy("at", "part").applyInPandas(total, schema)
    out = np.zeros(q.shape)
    for r in sums.groupBy("at").applyInPandas(total, schema).collect():
        out[r["at"]:r["at"] + TERMS] = np.frombuffer(bytes(r["z"]), np.float32).reshape(-1, q.shape[1]) / r["n"]
    return out


def latent_space(texts: DataFrame, idf: np.ndarray, rank: int = RANK, own: list[list[int]] = ()) -> np.ndarray:
    """Term vectors of a randomised SVD of the passages of all texts: terms x rank, scaled by idf.

    The runs ``own`` (the pieces) together weigh like all passages of the texts together.
    """
    width = min(rank + EXTRA, len(idf))
    ids = np.array([x for r in own for x in r], np.int32)
    cut = np.concatenate(([0], np.cumsum([len(r) for r in own], dtype=np.int64)))

    def times(q: np.ndarray) -> np.ndarray:
        z, n = products(ids, cut, idf, q.astype(np.float32))
        return _times(texts, idf, q) + z / max(n, 1)

    q = np.linalg.qr(np.random.default_rng(0).standard_normal((len(idf), width)))[0]
    for _ in range(ROUNDS):
        q = np.linalg.qr(times(q))[0]
    value, vector = np.linalg.eigh(q.T @ times(q))
    best = np.argsort(-value)[:rank]
    return (q @ vector[:, best]) * idf[:, None]


# --- search ---------------------------------------------------------------------------------


def verbatim(ids: np.ndarray, pieces: list[Piece], terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of three words or more that stand word for word in ``ids``, and where they begin."""
    count = np.bincount(ids, minlength=terms)
    by_term: dict[int, list[tuple[int, int]]] = {}  # a piece is looked for at its rarest term
    for j, p in enumerate(pieces):
        if len(p.run) >= 3 and count[p.run].min():
            o = int(count[p.run].argmin())
            by_term.setdefault(p.terms[o], []).append((j, o))
    wanted = np.zeros(len(count), bool)
    wanted[list(by_term)] = True
    at = np.flatnonzero(wanted[ids])
    at = at[np.argsort(ids[at], kind="stable")]
    cut = np.concatenate(([0], np.cumsum(count * wanted)))
    for t, users in by_term.items():
        for j, o in users:
            begin = at[cut[t]:cut[t + 1]] - o
            begin = begin[(begin >= 0) & (begin + len(pieces[j].run) <= len(ids))]
            for k, x in enumerate(pieces[j].terms):
                if not len(begin):
                    break
                begin = begin[ids[begin + k] == x]
            if len(begin):
                yield j, begin


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct numbers; by sorting, which costs less here than the hash table of ``np.unique``."""
    x = np.sort(x)
    return x[np.diff(x, prepend=-1) != 0] if len(x) else x


def reachable(ids: np.ndarray, cut: np.ndarray, pieces: list[Piece], terms: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text, piece)`` pairs, sorted, of the texts ``ids[cut[i]:cut[i + 1]]`` that can hold a leak; no other text or pair can.

    ``leaks`` looks at no more than twice the piece and two blocks at a time, and wants ``need`` of the piece's
    places matched there, so the terms found in some stretch of that length must fill as many places. A text's pairs
    are left out if none of them has the terms in order, too.
    """
    half = 2 * (max(len(p.terms) for p in pieces) + STEP)  # two neighbours hold any stretch ``leaks`` looks at
    sizes = np.diff(cut)
    count = -(-sizes // half)
    first = np.concatenate(([0], np.cumsum(count)))
    text_of = np.repeat(np.arange(len(sizes)), count)
    known = np.flatnonzero(ids > 0)
    text = np.repeat(np.arange(len(sizes)), sizes)[known]
    key = distinct((first[text] + (known - cut[text]) // half) * terms + ids[known])
    at, term = np.divmod(key, terms)
    before = at > first[text_of[at]] if len(at) else np.zeros(0, bool)  # a half ends the stretch before, too
    at, term = np.divmod(distinct(np.concatenate((key, key[before] - terms))), terms)
    users = sorted((t, j, x) for j, p in enumerate(pieces) for t, x in Counter(p.terms).items())
    user_term, user, times = (np.array(c, np.int64) for c in zip(*users))
    begin = np.searchsorted(user_term, np.arange(terms + 1))
    many = begin[term + 1] - begin[term]
    need = np.array([len(p.terms) * (COVER if len(p.terms) >= 8 else 1.0) for p in pieces]) - 1e-6
    # some stretches at a time, by the numbers they take
    work = np.cumsum(np.bincount(at, many, minlength=len(text_of)) + len(pieces))
    out, can, lo = [np.zeros(0, np.int64)], np.zeros(len(sizes), bool), 0
    while lo < len(text_of):
        hi = max(lo + 1, int(np.searchsorted(work, (work[lo - 1] if lo else 0) + STRETCHES)))
        a, b = np.searchsorted(at, (lo, hi))
        n = many[a:b]
        i = np.arange(n.sum()) + np.repeat(begin[term[a:b]] - np.cumsum(n) + n, n)
        filled = np.bincount(np.repeat(at[a:b] - lo, n) * len(pieces) + user[i], times[i], minlength=(hi - lo) * len(pieces))
        row, j = np.nonzero(filled.reshape(hi - lo, -1) >= need)
        by_piece = np.argsort(j, kind="stable")
        row, j = lo + row[by_piece], j[by_piece]
        out.append(text_of[row] * len(pieces) + j)
        start = cut[text_of[row]] + (row - first[text_of[row]]) * half
        end = np.minimum(start + 2 * half, cut[text_of[row] + 1])
        fits = in_order(ids, start, end, j, pieces, terms) >= need[j]
        row, j, start, end = row[fits], j[fits], start[fits], end[fits]
        own = 2 * np.array([len(p.terms) + STEP for p in pieces])[j]  # so do two neighbours of the piece's own length
        count = np.maximum(1, -(-(end - start) // own) - 1)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        row, j, own = np.repeat(row, count), np.repeat(j, count), np.repeat(own, count)
        start = np.repeat(start, count) + nth * own
        fits = in_order(ids, start, np.minimum(start + 2 * own, np.repeat(end, count)), j, pieces, terms) >= need[j]
        can[text_of[row[fits]]] = True
        lo = hi
    text, j = np.divmod(distinct(np.concatenate(out)), len(pieces))
    return text[can[text]], j[can[text]]


def in_order(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, js: np.ndarray, pieces: list[Piece], terms: int) -> np.ndarray:
    """``common`` of each stretch ``ids[begin:end]`` with its piece, the pieces ascending; the size of pieces too long for a number's bits."""
    out = np.array([len(p.terms) for p in pieces], np.int64)[js]
    short = np.flatnonzero(out < 64)
    if not len(short):
        return out
    width = int((end - begin)[short].max())
    stretches = np.lib.stride_tricks.sliding_window_view(np.concatenate((ids, np.zeros(width, ids.dtype))), width)
    bits = np.zeros(terms, np.uint64)
    for part in np.split(short, range(ALIGNED, len(short), ALIGNED)):
        seen = stretches[begin[part]]
        at = np.empty(seen.shape, np.uint64)  # bits of a word's places in the piece
        edge = np.flatnonzero(np.diff(js[part], prepend=-1, append=-1))
        for lo, hi in zip(edge.tolist(), edge[1:].tolist()):
            p = pieces[js[part[lo]]]
            bits[list(p.at)] = list(p.at.values())
            at[lo:hi] = bits.take(seen[lo:hi])
            bits[p.run] = 0
        row, column = np.divmod(np.flatnonzero(at), width)
        inside = column < (end - begin)[part[row]]
        row, column = row[inside], column[inside]
        nth = np.arange(len(row)) - np.searchsorted(row, np.arange(len(part)))[row]
        met = np.zeros((nth.max(initial=-1) + 1, len(part)), np.uint64)
        met[nth, row] = at[row, column]
        full = (np.uint64(1) << out[part].astype(np.uint64)) - np.uint64(1)
        v = full.copy()
        for m in met:
            y = m & v
            v = v + y | v - y  # sums carry upwards only
        out[part] -= np.bitwise_count(v & full)
    return out


def _search(texts: list[list[int] | np.ndarray], vectors: np.ndarray, queries: np.ndarray, pieces: list[Piece], cosine: float) -> list[tuple]:
    """``(text, piece, covered, cosine, first word, last word)`` of the leaks in some texts of term numbers."""
    cut = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    pair_text, pair_piece = reachable(np.concatenate([np.asarray(t, np.int32) for t in texts]), cut, pieces, len(vectors))
    wanted, edge = np.unique(pair_text, return_index=True)  # only these are projected, and compared with their pieces
    if not len(wanted):
        return []
    own_pieces = np.split(pair_piece, edge[1:])
    group = np.cumsum(np.diff(cut)[wanted]) // TOGETHER  # small enough for a core's cache, unless one text is longer
    out = []
    for lo, hi in zip(*(e.tolist() for e in (np.searchsorted(group, np.unique(group), side) for side in ("left", "right")))):
        found = _compare([texts[i] for i in wanted[lo:hi]], own_pieces[lo:hi], vectors, queries, pieces, cosine)
        out += [(int(wanted[lo + d]), *r) for d, *r in found]
    return out


def _compare(texts: list, own_pieces: list[np.ndarray], vectors: np.ndarray, queries: np.ndarray, pieces: list[Piece], cosine: float) -> list[tuple]:
    """``_search`` for some texts, each compared with its own pieces only."""
    sizes = [-(-len(t) // STEP) + 8 for t in texts]  # blocks, with room for a window past the end
    begin = np.concatenate(([0], np.cumsum(sizes)))
    text_of = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(text_of)) - begin[text_of]  # of a block in its text
    ids = np.zeros(int(begin[-1]) * STEP, np.int32)
    for t, b in zip(texts, begin):
        ids[b * STEP:b * STEP + len(t)] = t
    blocks = vectors[ids].reshape(-1, STEP, vectors.shape[1]).sum(axis=1)
    half = blocks[:-3] + blocks[1:-2] + blocks[2:-1] + blocks[3:]
    whole = half[:-4] + half[4:]
    hits: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
    for w, width in ((half, 4), (whole, 8)):
        norm = np.sqrt(np.einsum("ij,ij->i", w, w))
        unit = w / np.where(norm > 1e-6, norm, np.inf).astype(np.float32)[:, None]
        for d, js in enumerate(own_pieces):
            near = unit[begin[d]:begin[d + 1] - 8] @ queries[js].T
            i, j = np.divmod(np.flatnonzero(near >= cosine), len(js))
            for at, j, c in zip(i.tolist(), js[j].tolist(), near[i, j].tolist()):
                hits.setdefault((d, j), []).append((at, width, c))
    tried = distinct(np.concatenate(own_pieces))
    for k, first in verbatim(ids, [pieces[j] for j in tried], len(vectors)):
        j = int(tried[k])
        at = np.unique(first // STEP)
        near = whole[at] @ queries[j] / np.maximum(np.linalg.norm(whole[at], axis=1), 1e-6)
        for d, *window in zip(text_of[at].tolist(), place[at].tolist(), near.tolist()):
            hits.setdefault((d, j), []).append((window[0], 8, window[1]))
    out = []
    for (d, j), found in hits.items():
        found.sort()
        runs: list[list] = []  # neighbouring windows are looked at together
        for at, width, c in found:
            if runs and at <= runs[-1][1]:
                runs[-1] = [runs[-1][0], max(runs[-1][1], at + width), max(runs[-1][2], c)]
            else:
                runs.append([at, at + width, c])
        best = (0.0, 0.0, 0, 0)
        for lo, hi, c in runs:
            lo, hi = max(0, lo * STEP - 2 * STEP), min(len(texts[d]), hi * STEP + 2 * STEP)
            got = leaks(pieces[j], ids[begin[d] * STEP + lo:begin[d] * STEP + hi].tolist())
            best = max(best, (got, c, lo, hi))
        if best[0]:
            out.append((d, j, *best))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(doc_id, text)`` and ``(item_id, text)`` -> ``(doc_id, text_key, item_id, covered, cosine, first_word, last_word)``."""
    ship(docs.sparkSession)
    docs, found = docs.select("doc_id", "text"), None
    block: list[tuple[int, str | None]] = []
    rows = benchmark.select("item_id", "text").where("text IS NOT NULL").orderBy("item_id", "text").toLocalIterator()
    for r in rows:
        block.append((r["item_id"], r["text"]))
        if len(block) == ITEMS:
            more, block = _block_leaks(docs, block, cosine), []
            found = more if found is None else found.union(more)
    if block or found is None:
        more = _block_leaks(docs, block, cosine)
        found = more if found is None else found.union(more)
    return found


def _block_leaks(docs: DataFrame, items: list[tuple[int, str | None]], cosine: float) -> DataFrame:
    spark = docs.sparkSession
    pieces, vocabulary = pieces_of(items)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key long, item_id long, covered double, cosine double, first_word int, last_word int"
    if not pieces:
        return spark.createDataFrame([], schema)
    texts = encoded(docs, vocabulary)
    df, n = document_frequencies(texts, len(vocabulary))
    idf = np.log((n + 1) / (df + 1)) + 0.1
    terms = latent_space(texts, idf, own=[p.terms for p in pieces])
    vectors = np.concatenate((np.zeros((1, terms.shape[1])), terms)).astype(np.float32)
    queries = np.stack([vectors[p.terms].sum(axis=0) for p in pieces])
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    model = spark.sparkContext.broadcast((vectors, queries, pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, queries, pieces = model.value
        for b in batches:
            out: list[tuple] = []
            texts: list[np.ndarray] = []
            first, size = 0, 0
            ids, cut = flat(b.column(2))
            for i, (lo, hi) in enumerate(zip(cut, cut[1:])):
                texts.append(ids[lo:hi])
                size += len(texts[-1])
                if size >= BATCH or i == b.num_rows - 1:
                    out += [(first + d, *r) for d, *r in _search(texts, vectors, queries, pieces, cosine)]
                    first, size, texts = i + 1, 0, []
            best: dict[tuple[int, int | None], tuple] = {}
            for d, j, *r in out:  # one row per document and item: its best covered piece
                key = (d, pieces[j].item)
                best[key] = max(best.get(key, (0.0,)), tuple(r))
            at = pa.array([d for d, _ in best], pa.int32())
            v = list(best.values())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array([i for _, i in best], pa.int64()),
                 *[pa.array([x[k] for x in v], kind) for k, kind in ((0, pa.float64()), (1, pa.float64()), (2, pa.int32()), (3, pa.int32()))]],
                ["doc_id", "text_key", "item_id", "covered", "cosine", "first_word", "last_word"])

    return texts.mapInArrow(run, schema)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) leak."""
    found = find_leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "item_id", "covered", "cosine", "first_word", "last_word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no benchmark item was found."""
    return matching(docs, stored(find_leaks(docs, benchmark).select("doc_id", "text_key").distinct(), "leaks-found"), "left_anti")
