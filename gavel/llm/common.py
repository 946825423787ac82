"""Shared helpers: columns and tables, and byte-level numpy views of Arrow text columns.

The numpy helpers work on a whole run of documents at once (one flat byte
buffer plus offsets), in chunks of a bounded number of bytes, so that the
memory of a task follows the chunk and the longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.sources.scratch import Scratch  # noqa: F401  (all operators take it from here)

CHUNK_BYTES = 1 << 21
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


# ------------------------------------------------------------------ tables

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_key(text="text"):
    """64-bit hash of a text (null: of no text); with the id it tells apart rows that share an id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def shielded(docs: DataFrame, *used: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that an operator doesn't use renamed, so that no name clashes, and how to undo it."""
    names = {c: f"extra_{k}" for k, c in enumerate(docs.columns) if c not in used}
    return docs.withColumnsRenamed(names), {v: k for k, v in names.items()}


# ------------------------------------------------------------ numpy on bytes

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LOWERED = _LETTER.copy()
_LOWERED[65:91] = _LETTER[97:123]
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse, grown as needed."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _POWERS = []
        for base in (_MULT, _INV):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
    return _POWERS


class SpanHash:
    """Hashes of any spans of a sequence from one prefix sum (wrapping 64-bit polynomial, then mixed)."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        power, self.inverse = _powers(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n], dtype=np.uint64, out=self.prefix[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray, lowered: bool = False) -> SpanHash:
        return cls((_LOWERED if lowered else _LETTER)[data])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and per document the index of its first word."""
    inside = ~_BLANK[data]
    first = np.empty(len(data) + 1, bool)
    first[0], first[1:] = True, True
    if len(data):
        first[1:-1] = ~inside[:-1]
    first[offsets] = True  # no word runs from one document into the next
    starts = np.flatnonzero(inside & first[:-1])
    ends = np.flatnonzero(inside & np.concatenate([first[1:-1] | ~inside[1:], [True]])) + 1 if len(data) else starts
    return starts, ends, np.searchsorted(starts, offsets)


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per range [offsets[i], offsets[i+1]) the sum of the flags."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
