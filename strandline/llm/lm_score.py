"""Masked pseudo-likelihood scores of documents by a bidirectional window network.

Every token is predicted from the two tokens on each side of it; a document's
score is the sum of the log probabilities of all its tokens. The network: one
embedding table per place around the token, their sum through ``tanh``, and a
softmax in two levels, first the token's class, then the token in its class.

Vocabulary: word counts over all documents give the ``KNOWN`` most frequent
words; the others share ``OTHER`` buckets, dealt by their first two bytes. Within its
bucket a word is predicted by its spelling: a chain over its bytes, counted over the
other words of all documents (``BYTES`` x ``BYTES`` numbers, whatever the corpus), so
every word has a probability of its own. The chain's mass in a bucket is known exactly,
the first two bytes being its first two steps, so a chain divided by the mass that the
known words leave of its bucket is a distribution over the bucket: all words in a
context add up to 1. Words are split at ASCII white space. Training: every task starts from
the same weights and goes once over its documents, learning from every token.
The tasks' weight changes are averaged, each row weighted by how
often it was used, in blocks of rows and in two levels, so no group grows with
the number of tasks beyond its square root; the driver sees one model. Scoring
covers every token of every whole text.

Defined cases: a null or empty text has no tokens, sum 0 and a null mean;
repeated rows give repeated results; an empty table gives no rows; other
columns are ignored. The weights depend on how documents fall into partitions,
not on their order of arrival.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import ship, stored, table, words_of

KNOWN, OTHER = 1984, 64
TOKENS = KNOWN + OTHER
CLASSES = 32
EACH = TOKENS // CLASSES
PAD = TOKENS
PLACES = (-2, -1, 1, 2)
WIDTH = 32               # the last one is constant 1 and carries the biases
STEP = 4096              # tokens learned from together
SCORED = 1 << 12         # tokens scored together
ROWS = 128               # rows of the weights in a block
FAN = 256                # tasks summed in a group of the first level
CACHED = 400_000
BYTES = 256
_IN = len(PLACES) * (TOKENS + 1)


def split(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased, as UTF-8; ``bytes.split`` cuts where ``WORD`` does."""
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def bucket(w: bytes) -> int:
    """Bucket of a spelling (a word and a line feed) by its first two bytes."""
    return zlib.crc32(w[:2]) % OTHER


#: Bucket of each pair of first bytes.
_OWN = np.array([[bucket(bytes((a, b))) for b in range(BYTES)] for a in range(BYTES)], np.int32)


class Words(dict):
    """Known word -> token; other words go to a bucket."""

    def __init__(self, known: list[str]) -> None:
        super().__init__((w.encode("utf-8", "surrogatepass"), i) for i, w in enumerate(known))

    def tokens(self, words: list[bytes], x: np.ndarray | None = None) -> np.ndarray:
        """Token of each word; ``x`` is ``spelled(words)``, if at hand."""
        x = spelled(words) if x is None else x
        out = np.fromiter(map(self.get, words, repeat(-1)), np.int32, len(words))
        other = np.flatnonzero(out < 0)
        first = np.flatnonzero(x == 10)[other] + 1
        out[other] = KNOWN + _OWN[x[first], x[first + 1]]
        return out


class Spelling(dict):
    """Word -> log probability of the word in its bucket; 0 for known words."""

    def __init__(self, known: list[str], pairs: np.ndarray) -> None:
        self.known = [w.encode("utf-8", "surrogatepass") for w in known]
        n = pairs + 0.1  # every spelling is possible
        p = n / n.sum(axis=1, keepdims=True)
        self.log = np.log(p)
        two = p[10][:, None] * p  # first two bytes; an empty word belongs to no bucket
        two[10] = 0
        mass = np.bincount(_OWN.ravel(), two.ravel(), minlength=OTHER)
        taken = np.bincount([bucket(w + b"\n") for w in self.known], np.exp(self.chains(self.known)), minlength=OTHER)
        self.mass = np.log(np.maximum(mass - taken, 1e-9 * mass))
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.update((w, 0.0) for w in self.known)

    def chains(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each spelling among all."""
        return self._chains(spelled(words)) if words else np.zeros(0)

    def _chains(self, x: np.ndarray) -> np.ndarray:
        pair = x[:-1].astype(np.intp) * BYTES + x[1:]
        return np.add.reduceat(self.log.ravel().take(pair), np.flatnonzero(x[:-1] == 10))

    def of(self, tokens: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Log probability in its bucket of each of the words ``x`` (by ``spelled``) with these tokens."""
        if not len(tokens):
            return np.zeros(0)
        own = tokens - KNOWN
        return np.where(own < 0, 0.0, np.minimum(self._chains(x) - self.mass[np.maximum(own, 0)], 0.0))

    def add(self, words: set[bytes]) -> None:
        """Make all of ``words`` known to the lookup, which keeps ``CACHED`` of them and those of one call."""
        if len(self) > len(self.known) + CACHED:
            self.forget()
        new = list(words.difference(self))
        own = np.array([bucket(w + b"\n") for w in new], dtype=np.int64)
        self.update(zip(new, np.minimum(self.chains(new) - self.mass[own], 0.0).tolist()))

    def sum(self, words: list[bytes]) -> float:
        return sum(map(self.__getitem__, words))


def spelled(words: list[bytes]) -> np.ndarray:
    """Bytes of words with line feeds between them and at either end."""
    return np.frombuffer(b"\n%b\n" % b"\n".join(words), np.uint8)


class Network:
    """All weights as rows of one matrix: input tables, class rows, token rows."""

    def __init__(self, weights: np.ndarray) -> None:
        self.w = weights

    @staticmethod
    def start() -> np.ndarray:
        rng = np.random.default_rng(0)
        w = rng.normal(0, 0.1, (_IN + CLASSES + TOKENS, WIDTH)).astype(np.float32)
        w[_IN:] = 0
        return w

    @staticmethod
    def contexts(flat: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Rows of the input tables for the tokens at the places ``at`` of a padded run of tokens."""
        return [k * (TOKENS + 1) + flat[at + p] for k, p in enumerate(PLACES)]

    def hidden(self, rows: list[np.ndarray]) -> np.ndarray:
        h = self.w.take(rows[0], axis=0)
        for r in rows[1:]:
            h += self.w.take(r, axis=0)
        np.tanh(h, out=h)
        h[:, -1] = 1
        return h

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    @staticmethod
    def _picked(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log softmax at one column of each row."""
        high = z.max(axis=1)
        picked = z[np.arange(len(z)), at] - high
        z -= high[:, None]
        return picked - np.log(np.exp(z, out=z).sum(axis=1))

    def log_prob(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of each token given the two on either side."""
        out = np.empty(len(at), np.float64)
        for lo in range(0, len(at), SCORED):
            part = at[lo:lo + SCORED]
            target = flat[part]
            group = target // EACH
            h = self.hidden(self.contexts(flat, part))
            p = self._picked(h @ self.w[_IN:_IN + CLASSES].T, group).astype(np.float64)
            order = np.argsort(group.astype(np.int8), kind="stable")
            cut = np.searchsorted(group[order], np.arange(CLASSES + 1)).tolist()
            near, z = h.take(order, axis=0), np.empty((len(part), EACH), h.dtype)
            for c, (b, e) in enumerate(zip(cut, cut[1:])):
                if b < e:
                    first = _IN + CLASSES + c * EACH
                    np.matmul(near[b:e], self.w[first:first + EACH].T, out=z[b:e])
            p[order] += self._picked(z, target[order] % EACH)
            out[lo:lo + SCORED] = p
        return out

    def learn(self, flat: np.ndarray, at: np.ndarray, squares: np.ndarray, used: np.ndarray, rate: float = 0.1) -> None:
        """One step of Adagrad (a square sum per row) on the tokens at ``at``."""
        target = flat[at]
        group = target // EACH
        rows = self.contexts(flat, at)
        h = self.hidden(rows)
        n = np.arange(len(at))
        d = self._softmax(h @ self.w[_IN:_IN + CLASSES].T)
        d[n, group] -= 1
        back = d @ self.w[_IN:_IN + CLASSES]
        steps = [(slice(_IN, _IN + CLASSES), d.T @ h, np.bincount(group, minlength=CLASSES))]
        order = np.argsort(group.astype(np.int8), kind="stable")
        cut = np.searchsorted(group[order], np.arange(CLASSES + 1)).tolist()
        near, column, more = h.take(order, axis=0), target[order] % EACH, np.empty_like(back)  # tokens by class
        seen = [(slice(cut[c], cut[c + 1]), slice(c * EACH, (c + 1) * EACH)) for c in range(CLASSES) if cut[c] < cut[c + 1]]
        rows_of, e = self.w[_IN + CLASSES:], np.empty((len(at), EACH), h.dtype)
        for i, own in seen:
            np.matmul(near[i], rows_of[own].T, out=e[i])
        e = self._softmax(e)
        e[n, column] -= 1
        g = np.zeros((TOKENS, WIDTH), h.dtype)  # classes without a token change nothing
        for i, own in seen:
            np.matmul(e[i], rows_of[own], out=more[i])
            np.matmul(e[i].T, near[i], out=g[own])
        steps.append((slice(_IN + CLASSES, None), g, np.repeat(np.diff(cut) / EACH, EACH)))
        back[order] += more
        back *= 1 - h * h
        back[:, -1] = 0
        r = np.concatenate(rows)
        order = np.argsort(r.astype(np.int16), kind="stable")
        r = r[order]
        first = np.flatnonzero(np.diff(r, prepend=-1))
        steps.append((r[first], added(back, order % len(at), first), np.diff(first, append=len(r))))
        for where, g, times in steps:
            squares[where] += (g * g).mean(axis=1)
            used[where] += times
            self.w[where] -= rate * g / np.sqrt(squares[where] + 1e-8)[:, None]


def added(x: np.ndarray, row: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``x[row]`` over the runs that begin at ``first``, all runs of a length together."""
    size = np.diff(first, append=len(row))
    order = np.argsort(size, kind="stable")
    out = np.empty((len(first), x.shape[1]), x.dtype)
    for runs in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(runs):
            out[runs] = x.take(row[first[runs, None] + np.arange(size[runs[0]])], axis=0).sum(axis=1)
    return out


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token runs one after another with two pads around each; places of the tokens; first place per text."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    begin = 2 + np.concatenate(([0], np.cumsum(size + 2)[:-1]))
    flat = np.full(int(size.sum() + 2 * len(texts) + 2), PAD, np.int32)
    for b, t in zip(begin, texts):
        flat[b:b + len(t)] = t
    return flat, np.flatnonzero(flat != PAD), begin


def numbered(texts: list[list[bytes]], words: Words) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Tokens of each text; of all texts one after another; all words as by ``spelled``."""
    flat = list(chain.from_iterable(texts))
    x = spelled(flat)
    tokens = words.tokens(flat, x)
    end = np.cumsum([len(t) for t in texts])
    return [tokens[e - len(t):e] for e, t in zip(end.tolist(), texts)], tokens, x


def _runs(column: pa.Array, most: int) -> Iterator[list[list[bytes]]]:
    """Texts as words, about ``most`` words at a time."""
    texts: list[list[bytes]] = []
    size = 0
    for t in column:
        texts.append(split(t.as_py()))
        size += len(texts[-1])
        if size >= most:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def counted(docs: DataFrame) -> DataFrame:
    """``(w, n)``: how often each word is in all documents."""
    return docs.select(F.explode(words_of(F.lower("text"))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))


def vocabulary(docs: DataFrame, said: DataFrame | None = None) -> list[str]:
    """The most frequent words of all documents; ties by the word itself. ``said`` as by ``counted``."""
    said = counted(docs) if said is None else said
    return [r["w"] for r in said.orderBy(F.desc("n"), "w").limit(KNOWN).collect()]


def spelling(docs: DataFrame, known: list[str], said: DataFrame | None = None) -> np.ndarray:
    """How often each byte follows each in the words of all documents that aren't known."""
    said = counted(docs) if said is None else said
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = {w.encode("utf-8", "surrogatepass") for w in shared.value}, np.zeros(BYTES * BYTES, np.int64)
        for b in batches:
            other = [(w.as_py().encode("utf-8", "surrogatepass"), k.as_py()) for w, k in zip(b.column(0), b.column(1))]
            other = [(w, k) for w, k in other if w not in known]
            if other:
                x = spelled([w for w, _ in other]).astype(np.int64)
                times = np.repeat([k for _, k in other], [len(w) + 1 for w, _ in other])
                np.add.at(n, x[:-1] * BYTES + x[1:], times)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], ["pair", "n"])

    out = np.zeros(BYTES * BYTES)
    for r in said.select("w", "n").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]  # one row per pair of bytes at most
    return out.reshape(BYTES, BYTES)


def train(docs: DataFrame, known: list[str]) -> np.ndarray:
    """Weights averaged over all tasks' passes over their documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, net = Words(shared.value), Network(Network.start())
        begin = net.w.copy()
        squares, used = np.zeros(len(net.w), np.float32), np.zeros(len(net.w), np.float32)
        for b in batches:
            for texts in _runs(b.column(0), 8 * STEP):
                flat, at, _ = laid_out(numbered(texts, words)[0])
                for lo in range(0, len(at), STEP):
                    net.learn(flat, at[lo:lo + STEP], squares, used)
        if used.any():
            change = (net.w - begin) * used[:, None]
            part = TaskContext.get().partitionId() // FAN
            at = range(0, len(used), ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // ROWS for i in at], pa.int32()), pa.array([part] * len(at), pa.int32()),
                 pa.array([change[i:i + ROWS].tobytes() for i in at]), pa.array([used[i:i + ROWS].tobytes() for i in at])],
                ["block", "part", "change", "used"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        one = lambda c: sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pdf[c]).astype(np.float32).tobytes()
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "part": [0], "change": [one("change")], "used": [one("used")]})

    kind = "block int, part int, change binary, used binary"
    parts = docs.select("text").mapInArrow(run, kind)
    sums = parts.groupBy("block", "part").applyInPandas(total, kind).groupBy("block").applyInPandas(total, kind)
    weights = Network.start()
    for r in sums.collect():  # one model
        own = slice(r["block"] * ROWS, r["block"] * ROWS + ROWS)
        used = np.frombuffer(bytes(r["used"]), np.float32)[:, None]
        weights[own] += np.frombuffer(bytes(r["change"]), np.float32).reshape(-1, WIDTH) / np.maximum(used, 1e-6)
    return weights


def score(docs: DataFrame, known: list[str], weights: np.ndarray, pairs: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, n_tokens, log_prob, mean_log_prob)``; ``pairs`` as by ``spelling``."""
    pairs = np.zeros((BYTES, BYTES)) if pairs is None else pairs
    shared = docs.sparkSession.sparkContext.broadcast((known, weights, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, pairs = shared.value
        words, net, letters = Words(known), Network(weights), Spelling(known, pairs)
        for b in batches:
            sums, sizes = [], []
            for texts in _runs(b.column(1), 32 * SCORED):
                each, tokens, x = numbered(texts, words)
                flat, at, _ = laid_out(each)
                p = np.concatenate(([0.0], np.cumsum(net.log_prob(flat, at) + letters.of(tokens, x))))
                size = np.array([len(t) for t in texts])
                end = np.cumsum(size)
                sums += (p[end] - p[end - size]).tolist()
                sizes += size.tolist()
            sums, sizes = np.array(sums), np.array(sizes, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes), pa.array(sums, pa.float64()),
                 pa.array(sums / np.maximum(sizes, 1), pa.float64(), mask=sizes == 0)],
                ["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, log_prob double, mean_log_prob double")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document."""
    ship(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    said = stored(counted(docs), "lm-words")
    known = vocabulary(docs, said)
    return score(docs, known, train(docs, known), spelling(docs, known, said))
