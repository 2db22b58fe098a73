"""Language identification with interpolated Kneser-Ney character models.

One model per language over the characters of its words (a start and an end
mark around each), orders up to five. A model is a few sorted arrays: n-gram
hashes with the log probability of their last character, and context hashes
with the log weight of backing off; a lookup is a binary search. A text gets
the language of the lowest cross-entropy per character. Two numbers are
calibrated on documents kept out of the counts: the sharpness that turns
cross-entropies into a probability (``score``), and per language the
cross-entropy above which a prediction is marked ``rejected``.

Models are fitted on a bounded sample: of each language the ``per_language``
training documents of lowest hash, a quarter of them for calibration. Every
text is then predicted whole. Texts are read in Arrow batches; each distinct
word and n-gram of a batch is looked up once.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
with no training document at all every text is ``und``; ties go to the first
language by name; rows with equal ids are predicted each by its own text; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import ship, stored, table

ORDER = 5
START, STOP = 2, 3  # marks around a word; control characters are never letters
UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(ORDER)]
SALTS = 256  # parts of a language while its sample is chosen
BATCH = 8_000_000  # characters looked up together, unless one text is longer


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def letters(text: str) -> list[str]:
    """Lower-case words of letters; none if the text has no letter."""
    words = _WORD.findall(text.lower())
    return words if words and any(c.isalpha() for c in text) else []


class Grams:
    """Hashes of the n-grams that end at each predicted character of some words."""

    def __init__(self, words: list[str]) -> None:
        flat = "".join([chr(START) + w + chr(STOP) for w in words])
        code = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        first = np.flatnonzero(code == START)
        self.sizes = np.diff(np.append(first, len(code))) - 1  # predicted characters per word
        self.at = np.flatnonzero(code != START)                # their places
        depth = np.arange(len(code)) - np.repeat(first, self.sizes + 1)
        self.depth = depth[self.at]                            # characters before each in its word
        # full[k]: hash of the k characters that end at each place of the flat text; 1 for none
        self.full, run = [np.ones(len(code), np.uint64)], np.zeros(len(code), np.uint64)
        for k in range(1, ORDER + 1):
            if k <= len(code):
                run[k - 1:] += (code[: len(code) - k + 1] + np.uint64(1)) * _POWERS[k - 1]
            self.full.append(((run ^ (run >> np.uint64(29))) * _MIX) ^ np.uint64(k))

    def grams(self, k: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """k-gram that ends at each place; valid where the word has that many characters before it."""
        return self.full[k][self.at[at]]

    def contexts(self, k: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The ``k - 1`` characters before each place; valid where a k-gram is."""
        return self.full[k - 1][self.at[at] - 1]


def fit(words: list[str], counts: np.ndarray, alphabet: int) -> pd.DataFrame:
    """Kneser-Ney model of word counts: rows ``(kind, key, value)``; kind 0 n-grams, 1 contexts."""
    g = Grams(words)
    n = np.repeat(counts, g.sizes).astype(float)
    out, lower = [], {}
    tables = {}
    for k in range(1, ORDER + 1):
        ok = g.depth >= k - 1
        key, ctx, low = g.grams(k, ok), g.contexts(k, ok), g.grams(k - 1, ok)
        u, first, inv = np.unique(key, return_index=True, return_inverse=True)
        raw = np.bincount(inv, n[ok], len(u))
        # an n-gram that begins with the start mark has nothing to its left: it keeps its own count
        opens = (g.depth[ok] == k - 1)[first]
        tables[k] = (u, ctx[first], low[first], raw, opens)
    for k in range(1, ORDER + 1):
        u, ctx, low, raw, opens = tables[k]
        if k < ORDER:  # distinct left neighbours, counted on the n-grams one longer
            ends, times = np.unique(tables[k + 1][2], return_counts=True)
            i = np.searchsorted(ends, u)
            left = np.where((i < len(ends)) & (ends[np.minimum(i, len(ends) - 1)] == u), times[np.minimum(i, len(ends) - 1)], 0)
            a = np.where(opens, raw, np.maximum(left, 1)).astype(float)
        else:
            a = raw
        n1, n2 = max((a == 1).sum(), 1), (a == 2).sum()
        d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9)
        c, inv = np.unique(ctx, return_inverse=True)
        total, kinds = np.bincount(inv, a, len(c)), np.bincount(inv, None, len(c))
        back = d * kinds / total
        if k == 1:
            base = np.full(len(u), 1.0 / alphabet)
        else:
            keys, probs = lower[k - 1]
            base = probs[np.searchsorted(keys, low)]
        p = np.maximum(a - d, 0) / total[inv] + back[inv] * base
        lower[k] = (u, p)
        out.append(pd.DataFrame({"kind": 0, "key": u.view(np.int64), "value": np.log(p)}))
        out.append(pd.DataFrame({"kind": 1, "key": c.view(np.int64), "value": np.log(back)}))
    return pd.concat(out)


class Models:
    """The languages' sorted hash arrays, and the calibration."""

    def __init__(self, rows: pd.DataFrame, alphabet: int) -> None:
        self.langs, self.floor = sorted(rows["lang"].unique()), -np.log(alphabet)
        self.arrays = []
        for lang in self.langs:
            mine = rows[rows["lang"] == lang]
            both = []
            for kind in (0, 1):
                part = mine[mine["kind"] == kind]
                key = part["key"].to_numpy(np.int64).view(np.uint64)
                order = np.argsort(key)
                both.append((key[order], part["value"].to_numpy()[order].astype(np.float32)))
            self.arrays.append(both)
        self.sharpness, self.limit = 1.0, np.full(len(self.langs), np.inf)

    @staticmethod
    def _find(pair: tuple[np.ndarray, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.minimum(np.searchsorted(pair[0], key), len(pair[0]) - 1)
        return pair[0][i] == key, pair[1][i]

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each word under each language, and predicted characters per word."""
        g = Grams(words)
        # places with the same characters before them get the same result: look each up once
        longest = np.zeros(len(g.at), np.uint64)
        for k in range(1, ORDER + 1):
            longest = np.where(g.depth >= k - 1, g.grams(k), longest)
        _, first, inv = np.unique(longest, return_index=True, return_inverse=True)
        depth = g.depth[first]
        h = [g.grams(k, first) for k in range(ORDER + 1)]
        ctx = [None] + [g.contexts(k, first) for k in range(1, ORDER + 1)]
        out = np.zeros((len(words), len(self.langs)))
        starts = np.concatenate(([0], np.cumsum(g.sizes)[:-1]))
        for j, (grams, backs) in enumerate(self.arrays):
            score, todo = np.zeros(len(first)), np.arange(len(first))
            for k in range(ORDER, 0, -1):
                fits = depth[todo] >= k - 1
                at = todo[fits]
                seen, value = self._find(grams, h[k][at])
                score[at[seen]] += value[seen]
                miss = at[~seen]
                known, back = self._find(backs, ctx[k][miss])
                score[miss[known]] += back[known]
                todo = np.concatenate((todo[~fits], miss))
            score[todo] += self.floor
            out[:, j] = np.add.reduceat(score[inv], starts)
        return out, g.sizes

    def entropies(self, texts: list[str | None]) -> np.ndarray:
        """Cross-entropy per character of each text under each language; NaN without a letter."""
        index: dict[str, int] = {}
        ids, ends = [], []
        for t in texts:
            if t:
                ids += [index.setdefault(w, len(index)) for w in letters(t)]
            ends.append(len(ids))
        out = np.full((len(texts), len(self.langs)), np.nan)
        if not index or not self.langs:
            return out
        score, sizes = self.word_scores(list(index))
        ids = np.array(ids)
        begin = np.array([0, *ends[:-1]])
        full = np.flatnonzero(np.array(ends) > begin)
        chars = np.add.reduceat(sizes[ids], begin[full])
        for j in range(len(self.langs)):
            out[full, j] = -np.add.reduceat(score[:, j][ids], begin[full]) / chars
        return out

    def probability(self, h: np.ndarray) -> np.ndarray:
        e = np.exp(-self.sharpness * (h - h.min(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)

    def calibrate(self, langs: list[str], h: np.ndarray) -> None:
        """Sharpness of most likelihood, and each language's cross-entropy at the 99.5 % quantile and a tenth more."""
        true = np.array([self.langs.index(x) for x in langs])
        best = -np.inf
        for s in np.geomspace(0.5, 100, 60):
            self_s, self.sharpness = self.sharpness, s
            like = np.log(np.maximum(self.probability(h)[np.arange(len(true)), true], 1e-9)).sum()
            if like > best:
                best = like
            else:
                self.sharpness = self_s
        for j in range(len(self.langs)):
            own = h[true == j, j]
            if len(own):
                self.limit[j] = 1.1 * np.quantile(own, 0.995)


def train(docs: DataFrame, per_language: int = 800) -> Models:
    """Fit on ``(doc_id, text, lang)`` rows outside the held-out fifth; a bounded sample per language."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text", "lang")
    # the lowest of each language are among the lowest of its parts: no task reads more than a part of a language
    part, whole = (Window.partitionBy("lang", *more).orderBy("r", "doc_id") for more in ([F.pmod("r", F.lit(SALTS))], []))
    ids = (docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
           .select("doc_id", "lang", F.xxhash64("doc_id").alias("r"))
           .withColumn("n", F.row_number().over(part)).where(F.col("n") <= per_language)
           .withColumn("n", F.row_number().over(whole)).where(F.col("n") <= per_language)
           .select("doc_id", F.col("lang").alias("label"), (F.col("n") % 4 == 0).alias("calibrate")))
    ids = stored(ids, "langid-sample").dropDuplicates(["doc_id", "label"])  # small: Spark broadcasts it by its size
    sample = stored(docs.join(ids, (docs["doc_id"] == ids["doc_id"]) & (docs["lang"] == ids["label"]), "inner")
                    .select("label", "text", "calibrate"), "langid-texts")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, part in pdf.groupby("label"):
                n = Counter(x for t in part["text"] if t for x in letters(t))
                if n:
                    yield pd.DataFrame({"lang": lang, "word": list(n), "n": list(n.values())})

    counts = stored(sample.where("NOT calibrate").mapInPandas(count, "lang string, word string, n long")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    letters_seen = counts.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().count()
    alphabet = letters_seen + 2  # the end mark, and one for all unseen

    def model(pdf: pd.DataFrame) -> pd.DataFrame:
        return fit(list(pdf["word"]), pdf["n"].to_numpy(), alphabet).assign(lang=pdf["lang"].iloc[0])

    rows = counts.groupBy("lang").applyInPandas(model, "kind int, key long, value double, lang string")
    models = Models(rows.toPandas(), alphabet)  # bounded by the sample
    if models.langs:
        check = sample.where("calibrate").toPandas()
        h = models.entropies(list(check["text"]))
        ok = ~np.isnan(h).any(axis=1) & check["label"].isin(models.langs).to_numpy()
        if ok.any():
            models.calibrate(list(check["label"][ok]), h[ok])
    return models


def _slices(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about :data:`BATCH` characters each."""
    size = np.array([len(t.as_buffer()) if (t := x).is_valid else 0 for x in whole.column(1)], dtype=np.int64)
    part = np.cumsum(size) // BATCH
    cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows]
    for lo, hi in zip(cut, cut[1:]):
        yield whole.slice(lo, hi - lo)


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, lang_pred, score, cross_entropy, rejected)``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for b in _slices(whole):
                h = m.entropies(b.column(1).to_pylist())
                known = ~np.isnan(h).any(axis=1) if h.shape[1] else np.zeros(len(h), bool)
                lang = np.full(len(h), UNDETERMINED, object)
                score, low, reject = np.zeros(len(h)), np.full(len(h), np.nan), np.ones(len(h), bool)
                if known.any():
                    best = h[known].argmin(axis=1)
                    lang[known] = np.array(m.langs, object)[best]
                    score[known] = m.probability(h[known])[np.arange(len(best)), best]
                    low[known] = h[known][np.arange(len(best)), best]
                    reject[known] = low[known] > m.limit[best]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(low, mask=~known), pa.array(reject)],
                    ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
