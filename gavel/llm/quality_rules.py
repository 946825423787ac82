"""Quality rules: base word rules, then gradient-boosted trees over document statistics.

Statistics are computed on the whole text, one flat byte buffer per chunk of
documents (see ``common``).  The trees are fitted with logistic loss on a
bounded sample of labelled documents (``MAX_LABELLED`` rows, the smallest
hashes of doc_id), with monotonic constraints on the features in
``CONSTRAINTS``, and flattened into numpy arrays: every tree is a complete
binary tree of ``DEPTH`` levels, so scoring walks all documents down one level
of one tree at a time.

Defined cases: a null or empty text has no words, all statistics 0, and fails
the base rules; null labels are not used; labels of unknown documents are not
used; rows that share a doc_id are scored each by their own text.  Where the
labels hold fewer than two classes there is no model, and the base rules alone
decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import SpanHash, chunks, mix, sums, utf8, word_spans

MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of words in repeated windows
WINDOW = 8

MAX_LABELLED = 20_000
TREES, DEPTH, RATE, BINS, L2, MIN_CHILD = 80, 3, 0.2, 64, 1.0, 5.0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "chars_per_word", "symbols_per_word", "symbol_only_words", "dup_lines", "repeat_words",
            "upper", "digits", "punctuation", "marks", "non_ascii", "words_per_line", "distinct_words"]
#: -1: a larger value never raises the score; +1: never lowers it.
CONSTRAINTS = {"symbols_per_word": -1, "symbol_only_words": -1, "dup_lines": -1, "repeat_words": -1}


def _table(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


_SYMBOL = _table("#*$%&|<>")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_PUNCTUATION = _table(".,;:'\"()-")
_MARK = _table("!?")


# -------------------------------------------------------------- statistics

def _same_before(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries in order: equal to an earlier entry of the same owner; equal to any other entry of it."""
    key = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    later, other = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = equal
    other[order[1:]] = equal
    other[order[:-1]] |= equal
    return later, other


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (documents x COUNTS) and features (documents x FEATURES) of one chunk of texts."""
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    n_words = np.diff(first)
    span = SpanHash.of_bytes(data)
    character = (data & 0xC0) != 0x80

    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends[ends < len(data)]] -= 1  # a word may begin where another text's last word ends
    inside = np.cumsum(inside[:-1]) > 0
    word_chars = sums(character & inside, offsets)
    n_symbols = sums(_SYMBOL[data], offsets)

    # lines: a text has one more than its line feeds
    feeds = np.flatnonzero(data == 10)
    line_start = np.concatenate([offsets[:-1], feeds + 1])
    owner = np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, "right") - 1])
    order = np.lexsort((line_start, owner))
    owner, line_start = owner[order], line_start[order]
    line_end = np.append(line_start[1:] - 1, 0)
    last = np.append(owner[1:] != owner[:-1], True)
    line_end[last] = offsets[1:]
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    earlier, _ = _same_before(owner, span(line_start, line_end))
    dup = np.bincount(owner[earlier & has_word], minlength=n)
    n_lines = np.bincount(owner[has_word], minlength=n)

    # windows of eight words found twice or more in their text
    word_hash = span(starts, ends)
    doc_of_word = np.repeat(np.arange(n), n_words)
    repeated = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= WINDOW:
        at = np.flatnonzero(doc_of_word[:-WINDOW + 1] == doc_of_word[WINDOW - 1:])
        _, twice = _same_before(doc_of_word[at], SpanHash(word_hash)(at, at + WINDOW))
        np.add.at(repeated, at[twice], 1)
        np.add.at(repeated, at[twice] + WINDOW, -1)
    n_repeat = sums(np.cumsum(repeated[:-1]) > 0, first)

    counts = np.stack([n_words, word_chars, n_symbols, dup, n_repeat], axis=1)
    _, known = _same_before(doc_of_word, word_hash)
    letters = np.add.reduceat(np.append((~(_LOWER | _UPPER | _DIGIT)[data] & (data < 128)).astype(np.int64), 0),
                              starts) if len(starts) else np.zeros(0)
    width = ends - starts
    symbol_only = sums((letters >= width) if len(starts) else np.zeros(0, bool), first)
    chars = np.maximum(word_chars, 1)
    per_word = np.maximum(n_words, 1)
    features = np.stack([
        np.log1p(n_words), word_chars / per_word, n_symbols / per_word, symbol_only / per_word,
        dup / np.maximum(n_lines, 1), n_repeat / per_word, sums(_UPPER[data], offsets) / chars,
        sums(_DIGIT[data], offsets) / chars, sums(_PUNCTUATION[data], offsets) / per_word,
        sums(_MARK[data], offsets) / per_word, sums(data >= 0xC0, offsets) / chars,
        n_words / np.maximum(n_lines, 1), sums(~known, first) / per_word], axis=1)
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * words)


# -------------------------------------------------------------------- model

@dataclass
class Trees:
    """Complete binary trees: inner nodes 0..2**DEPTH-2 in breadth order, then the leaves."""

    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; a value above it goes right
    leaf: np.ndarray       # trees x leaves
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        row = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            total += leaf[node - (leaf.size - 1)]
        return total


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees with logistic loss; ``signs`` holds -1, 0 or 1 for each feature.

    Monotonic: a split on a constrained feature is taken only if its two
    weights are in order, and the weights below it stay on their sides of the
    middle between them.
    """
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    out = Trees(np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), np.inf),
                np.zeros((trees, 2**depth)), float(np.log(share / (1 - share))))
    margin = np.full(len(y), out.bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        limits = {0: (-np.inf, np.inf)}
        for k in range(2**depth - 1):
            here = np.flatnonzero(node == k)
            low, high = limits[k]
            found = _best_split(bins, edges, grad, hess, here, signs, low, high)
            middle = None
            if found is not None:
                f, b, left, right = found
                out.feature[t, k], out.threshold[t, k] = f, edges[f][b]
                node[here] = 2 * k + 1 + (bins[here, f] > b)
                middle = (left + right) / 2 if signs[f] else None
            else:
                node[here] = 2 * k + 1
            limits[2 * k + 1], limits[2 * k + 2] = (low, high), (low, high)
            if middle is not None and signs[f] > 0:
                limits[2 * k + 1], limits[2 * k + 2] = (low, middle), (middle, high)
            elif middle is not None:
                limits[2 * k + 1], limits[2 * k + 2] = (middle, high), (low, middle)
        for k in range(2**depth):
            here = node == k + 2**depth - 1
            weight = np.clip(grad[here].sum() / (hess[here].sum() + L2), *limits[k + 2**depth - 1])
            out.leaf[t, k] = RATE * weight
        margin += out.leaf[t][node - (2**depth - 1)]
    return out


def _best_split(bins, edges, grad, hess, here, signs, low, high):
    """(feature, bin, weight left, weight right) of the largest gain, or None."""
    best, found = 1e-6, None
    g_all, h_all = grad[here].sum(), hess[here].sum()
    for f, edge in enumerate(edges):
        if not len(edge):
            continue
        g = np.cumsum(np.bincount(bins[here, f], grad[here], len(edge) + 1))[:-1]
        h = np.cumsum(np.bincount(bins[here, f], hess[here], len(edge) + 1))[:-1]
        left = np.clip(g / (h + L2), low, high)
        right = np.clip((g_all - g) / (h_all - h + L2), low, high)
        gain = (2 * g * left - (h + L2) * left**2 + 2 * (g_all - g) * right - (h_all - h + L2) * right**2)
        whole = np.clip(g_all / (h_all + L2), low, high)
        gain -= 2 * g_all * whole - (h_all + L2) * whole**2
        allowed = (h >= MIN_CHILD / 4) & (h_all - h >= MIN_CHILD / 4) & (signs[f] * (right - left) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        b = int(np.argmax(gain))
        if gain[b] > best:
            best, found = gain[b], (f, b, left[b], right[b])
    return found


def signs() -> np.ndarray:
    return np.array([CONSTRAINTS.get(f, 0) for f in FEATURES])


# -------------------------------------------------------------------- Spark

_STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, features array<double>"


def with_statistics(docs: DataFrame, model: Trees | None = None, features: bool = False) -> DataFrame:
    """doc_id, the counts, base_failed, score (margin; null without a model) and, if asked for, the features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in chunks(offsets):
                part = offsets[i:j + 1]
                counts, x = statistics(data[part[0]:part[-1]], part - part[0])
                score = pa.array(model.margin(x)) if model else pa.nulls(j - i, pa.float64())
                rows = pa.array(list(x)) if features else pa.nulls(j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j].cast(pa.int64()), *(pa.array(c) for c in counts.T.copy()),
                     pa.array(base_failed(counts)), score, rows.cast(pa.list_(pa.float64()))],
                    names=["doc_id", *COUNTS, "base_failed", "score", "features"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _STATS)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_labelled`` documents, in order of a hash of doc_id."""
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("qr_doc")).agg(F.max("quality").alias("qr_label"))
              .orderBy(F.xxhash64("qr_doc"), "qr_doc").limit(max_labelled))
    # two numbers for each of max_labelled rows at most
    some = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("qr_doc")).select("doc_id", "text")
    got = (with_statistics(some, features=True).join(F.broadcast(chosen), F.col("doc_id") == F.col("qr_doc"))
           .select("doc_id", "features", "qr_label").orderBy(F.xxhash64("doc_id"), "doc_id", "features")
           .limit(max_labelled).toPandas())
    if not len(got):
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    return np.stack(got["features"].to_list()), got["qr_label"].to_numpy(np.float64)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Trees | None:
    x, y = labelled_sample(docs, labels, max_labelled)
    return fit(x, y, signs()) if len(np.unique(y)) == 2 else None


def scored(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """with_statistics plus ``kept``."""
    model = train(docs, labels, max_labelled)
    good = F.coalesce(F.col("score") >= 0, F.lit(True))
    return with_statistics(docs, model).withColumn("kept", ~F.col("base_failed") & good)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels).select("doc_id", *COUNTS, "base_failed", "kept", "score")


def stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they are."""
    model = train(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            for i, j in chunks(offsets):
                part = offsets[i:j + 1]
                counts, x = statistics(data[part[0]:part[-1]], part - part[0])
                good = ~base_failed(counts)
                if model is not None:
                    good &= model.margin(x) >= 0
                yield batch.slice(i, j - i).filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
