"""Toxicity: subword-bag embeddings, averaged over a passage, into a linear softmax of two classes.

A word (cut at blanks, lower-cased) is the bag of its character n-grams of 3 to
6 code points, the blanks on both sides included; each n-gram has a vector in a
hashed table, a word is the mean of its n-grams' vectors, and a passage the mean
of its words.  So a misspelt or newly compounded word shares most of its vector
with words that were seen.  A text's score is that of its most toxic passage of
``WINDOW`` consecutive words (a shorter text is one passage), so that an insult in
a long text isn't averaged away.

Vectors and softmax are trained together in numpy, by Adam: first on whole-text
averages of ``WARM_TEXTS`` random texts a step, then on each text's highest
passage, chosen anew every ``CHOOSE`` steps, with ``DROPOUT`` of the n-grams
left out at random in every step, which spreads a word's weight over all of its
n-grams.  Training takes a bounded sample: of each label at most ``MAX_LABELLED``
documents of at most ``MAX_CHARS`` characters, by the smallest hashes of doc_id.
Every whole text is scored.  After the fit an n-gram only matters by its
vector's product with the softmax's weights, so tasks get one number per bucket.

Defined cases: a null, empty or blank text has no passage and gets the score of
the bias alone; null labels and labels without doc_id are not used, of several
labels of a document any 1 counts; rows that share a doc_id are scored each by
their own text; a null doc_id isn't held out; without labels of both kinds there
is no model and the score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 4_000
MAX_CHARS = 20_000
THRESHOLD = 0.3
WINDOW = 8
GRAMS = (3, 4, 5, 6)
BUCKET_BITS = 17
DIMENSIONS = 8
DROPOUT = 0.5
WARM_STEPS, WARM_TEXTS, STEPS, CHOOSE, RATE = 20, 500, 80, 4, 0.1
CHUNK_CHARS = 1 << 20
_TO_BLANK = dict.fromkeys(range(0x09, 0x0E), " ")


# ------------------------------------------------------------------- subwords

@dataclass
class Words:
    """The words of some texts: code points (all blanks 0x20, one before, between and after texts), bounds, first word of each text."""
    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer(f" {' '.join(lowered)} ".encode("utf-32-le"), "<u4").copy()
    blank = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    points[blank] = 0x20
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    begin = np.cumsum([1, *(len(t) + 1 for t in lowered)])
    return Words(points, starts, ends, np.searchsorted(starts, begin))


def grams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the buckets of the n-grams at all places, and which of them lie in one word with its blanks."""
    blanks = np.zeros(len(points) + 1, np.uint32)
    np.cumsum(points == 0x20, dtype=np.uint32, out=blanks[1:])
    rolling = points.copy()
    for n in range(2, max(GRAMS) + 1):
        rolling = rolling[:-1] * np.uint32(0x01000193) + points[n - 1:]
        if n in GRAMS:
            h = (rolling + np.uint32(n)) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA77)
            yield h >> np.uint32(32 - BUCKET_BITS), blanks[n - 1:-1] == blanks[1:max(0, len(points) - n + 2)]


def n_grams(length: np.ndarray) -> np.ndarray:
    """How many n-grams a word of so many code points has."""
    return sum(np.maximum(0, length + 3 - n) for n in GRAMS)


def word_margins(words: Words, table: np.ndarray) -> np.ndarray:
    """Each word's mean over its n-grams of the table's numbers."""
    if not len(words.starts):
        return np.zeros(0)
    total = np.zeros(len(words.points), np.float32)
    for bucket, inside in grams(words.points):
        total[:len(bucket)] += np.where(inside, table[bucket], np.float32(0))
    return np.add.reduceat(total, words.starts - 1, dtype=np.float64) / n_grams(words.ends - words.starts)


def passages(margins: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text with words: its index, its highest passage's mean, and that passage's words [start, end)."""
    texts = np.flatnonzero(np.diff(first))
    if not len(texts):
        return texts, np.zeros(0), texts, texts
    begin, stop = first[texts], first[texts + 1]
    total = np.concatenate([[0.0], np.cumsum(margins)])
    at = np.arange(begin[0], stop[-1])
    last = np.repeat(stop, stop - begin)
    end = np.minimum(at + WINDOW, last)
    mean = (total[end] - total[at]) / (end - at)
    mean[(at + WINDOW > last) & (at != np.repeat(begin, stop - begin))] = -np.inf
    best = np.maximum.reduceat(mean, begin - begin[0])
    where = np.flatnonzero(mean == np.repeat(best, stop - begin))
    start = at[where[np.searchsorted(where, begin - begin[0])]]
    return texts, best, start, np.minimum(start + WINDOW, stop)


# ---------------------------------------------------------------------- model

@dataclass
class Model:
    table: np.ndarray  # per bucket, its vector's product with the difference of the softmax's weights
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        words = words_of(texts)
        texts_with, best, _, _ = passages(word_margins(words, self.table), words.first)
        margin = np.full(len(texts), self.bias)
        margin[texts_with] += best
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


@dataclass
class Bags:
    """The sample's words as places in a vocabulary, first word of each text, and the n-grams of the vocabulary, word by word."""
    of: np.ndarray
    first: np.ndarray
    word: np.ndarray
    bucket: np.ndarray
    size: np.ndarray  # n-grams of each vocabulary word

    @classmethod
    def of_texts(cls, texts: list[str | None]) -> Bags:
        places: dict[str, int] = {}
        of, first = [], [0]
        for text in texts:
            words = [w for w in (text or "").lower().translate(_TO_BLANK).split(" ") if w]
            of.append(np.array([places.setdefault(w, len(places)) for w in words], np.int32))
            first.append(first[-1] + len(words))
        words = words_of([" ".join(places)])
        owner = (np.cumsum(np.bincount(words.starts - 1, minlength=len(words.points))) - 1).astype(np.int32)
        found = [(owner[:len(bucket)][inside], bucket[inside].astype(np.int32)) for bucket, inside in grams(words.points)]
        word, bucket = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(word, kind="stable")
        return cls(np.concatenate(of), np.array(first), word[order], bucket[order], n_grams(words.ends - words.starts).astype(np.float32))

    def means(self, flat: np.ndarray) -> np.ndarray:
        """Per word of the texts, the mean of its n-grams' numbers."""
        begin = np.cumsum(self.size).astype(np.int64) - self.size.astype(np.int64)
        return (np.add.reduceat(flat[self.bucket], begin) / self.size)[self.of]


def _sums(index: np.ndarray, rows: np.ndarray, table: np.ndarray, scale: np.ndarray, size: int) -> np.ndarray:
    """The table's rows, each times its scale, summed by index."""
    out = np.empty((size, table.shape[1]), np.float32)
    for k in range(table.shape[1]):
        out[:, k] = np.bincount(index, table[rows, k] * scale, size)
    return out


def fit(texts: list[str | None], toxic: np.ndarray, seed: int = 5) -> Model | None:
    """Vectors, weights and biases by Adam on the mean cross-entropy; None unless both labels have texts with words."""
    bags = Bags.of_texts(texts) if any((t or "").translate(_TO_BLANK).strip(" ") for t in texts) else None
    if bags is None or len(np.unique(toxic[np.diff(bags.first) > 0])) < 2:
        return None
    rng = np.random.default_rng(seed)
    n, buckets = len(bags.size), 1 << BUCKET_BITS
    parts = [np.zeros((buckets, DIMENSIONS), np.float32), rng.normal(0, 1, (2, DIMENSIONS)).astype(np.float32), np.zeros(2, np.float32)]
    momenta = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    whole = np.flatnonzero(np.diff(bags.first))
    for step in range(1, WARM_STEPS + STEPS + 1):
        vectors, weights, bias = parts
        if step <= WARM_STEPS:
            at = rng.permutation(whole)[:WARM_TEXTS]
            start, end = bags.first[at], bags.first[at + 1]
        elif (step - WARM_STEPS) % CHOOSE == 1:
            at, _, start, end = passages(bags.means(vectors @ (weights[1] - weights[0])), bags.first)
        length = end - start
        text = np.repeat(np.arange(len(at)), length)
        word = bags.of[np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)]

        used = np.zeros(n, bool)
        used[word] = True
        pairs = np.flatnonzero(used[bags.word])
        by_word, by_bucket = bags.word[pairs], bags.bucket[pairs]
        left_in = ((rng.random(buckets) >= DROPOUT) / np.float32(1 - DROPOUT))[by_bucket] / bags.size[by_word]
        share = (1 / length)[text]
        word_vectors = _sums(by_word, by_bucket, vectors, left_in, n)
        means = _sums(text, word, word_vectors, share, len(at))

        logits = means @ weights.T + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(at)), toxic[at].astype(int)] -= 1
        p /= len(at)
        to_words = _sums(word, text, p @ weights, share, n)
        gradients = [_sums(by_bucket, by_word, to_words, left_in, buckets), p.T @ means, p.sum(axis=0)]
        for part, gradient, (m, v) in zip(parts, gradients, momenta):
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient**2 - v)
            part -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    vectors, weights, bias = parts
    return Model((vectors @ (weights[1] - weights[0])).astype(np.float32), float(bias[1] - bias[0]))


# ---------------------------------------------------------------------- Spark

def held_out(doc_id: Column) -> Column:
    """The documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``max_labelled`` documents of each label, in order of a hash of doc_id."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("tx_doc")).agg(F.max(F.col("toxic") == 1).alias("tx_label")))
    order = F.xxhash64("tx_doc"), F.col("tx_doc")
    chosen = known.where("tx_label").orderBy(*order).limit(max_labelled).unionAll(
        known.where("NOT tx_label").orderBy(*order).limit(max_labelled))
    # a number and a flag for each of 2 * max_labelled rows at most
    some = (docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("tx_doc")).where(F.length("text") <= MAX_CHARS)
            .select("tx_doc", "text", "tx_label").orderBy(*order, "text").limit(2 * max_labelled).toPandas())
    return some["text"].to_list(), some["tx_label"].to_numpy(np.float64)


def scored(docs: DataFrame, model: Model | None, default: float = 0.0) -> DataFrame:
    """doc_id and score of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):
                end, room = at, CHUNK_CHARS
                while end < len(texts) and (end == at or room >= len(texts[end] or "")):
                    room -= len(texts[end] or "")
                    end += 1
                score = model.scores(texts[at:end]) if model else np.full(end - at, default)
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:end], pa.array(score, pa.float64())], names=["doc_id", "score"])
                at = end

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    texts, toxic = labelled_sample(docs, labels)
    model = fit(texts, toxic) if len(texts) else None
    out = scored(docs, model, float(toxic.mean()) if len(toxic) else 0.0)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
