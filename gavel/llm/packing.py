"""Packing along a space-filling curve.

Each document becomes a hashed, length-normalised vector of its token counts,
projected to ``DIMENSIONS`` numbers by fixed random directions.  The numbers'
place on a Hilbert curve is the document's key; a range sort by key puts like
documents side by side, and each sorted partition's token streams are laid end
to end and cut every ``LENGTH`` tokens.  What is left at a partition's end is
cut into lengths that are powers of two, which need no padding; only a rest that
began in an earlier batch of rows and fills no sequence is padded.

Tokens are written once to the shared scratch folder, as 16-bit ids, because a
range sort reads its input twice (splitters, then rows).

Defined cases: a null or empty text is the end token alone; rows that share a
doc_id (and a null doc_id) are packed each for itself, ordered by key, doc_id
and text; rows equal in all of these are alike.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import Scratch
from gavel.llm.tokens import pieces

PARTITION_TOKENS = 1 << 24  # of a range of the curve, 32 MB of ids
LENGTH = 1024
END = 0
BUCKETS = 256
DIMENSIONS = 4
BITS = 12
SEED = 20_250_101

_TOKENS = "doc_id long, pk_ids binary, pk_tokens long, pk_key long, pk_crc long"
_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, hilbert_key long")


def directions(buckets: int = BUCKETS, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((buckets, dimensions))


def project(ids: np.ndarray, along: np.ndarray) -> np.ndarray:
    """Hashed vector of token counts, of unit length, along each direction; spread over 0..1 by a logistic curve."""
    bucket = (ids.astype(np.uint32) * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(len(along))
    counts = np.bincount(bucket, minlength=len(along)).astype(np.float64)
    norm = np.sqrt(counts @ counts)
    return 1 / (1 + np.exp(-1.7 * (counts @ along) / (norm or 1)))


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate.

    Gray-code form: coordinates are turned and exchanged bit by bit from the
    top, then Gray-decoded across coordinates, and their bits interleaved.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap if i else 0
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def tokenised(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids (16-bit, with the end token), their number, the curve key, and a checksum to break ties."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, along = pieces(vocabulary), directions()
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [i + end for i in table.encode_all(part.column(1).to_pylist())]
                at01 = np.stack([project(np.frombuffer(i, "<u2"), along) for i in ids])
                key = hilbert(np.minimum((at01 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(ids, pa.binary()), pa.array([len(i) // 2 for i in ids], pa.int64()),
                     pa.array(key), pa.array([zlib.crc32(i) for i in ids], pa.int64())],
                    names=["doc_id", "pk_ids", "pk_tokens", "pk_key", "pk_crc"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _TOKENS)


def cuts(total: int, length: int = LENGTH) -> np.ndarray:
    """Ends of the sequences that hold ``total`` tokens: whole ones, then powers of two."""
    ends = list(range(length, total + 1, length))
    rest, at = total % length, total - total % length
    for power in (1 << b for b in range(length.bit_length() - 1, -1, -1)):
        if rest & power:
            at += power
            ends.append(at)
    return np.array(ends, np.int64)


def pack_partition(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """Lay a sorted partition's documents end to end; each batch is held back until it is known whether it is the last."""
    sequence = TaskContext.get().partitionId() << 40
    filled, held = 0, None  # tokens in the open sequence
    for batch in batches:
        if held is not None:
            rows, sequence, filled = _pack(held, sequence, filled, length, False)
            yield rows
        held = batch
    if held is not None:
        yield _pack(held, sequence, filled, length, True)[0]


def _pack(batch: pa.RecordBatch, sequence: int, filled: int, length: int, last: bool):
    size = np.array(batch.column("pk_tokens"))
    ends = filled + np.cumsum(size)
    total = int(ends[-1]) if len(ends) else filled
    if not last:
        cut = np.arange(length, total + 1, length)
    elif filled and total < length:  # pieces of the open sequence are out already, so it is padded
        cut = np.array([total])
    else:
        cut = cuts(total, length)
    out = []
    key, ids, doc = batch.column("pk_key"), batch.column("pk_ids"), batch.column("doc_id")
    for i in range(len(size)):
        begin, end = int(ends[i] - size[i]), int(ends[i])
        tokens = np.frombuffer(ids[i].as_py(), "<u2").astype("<u4")
        at = begin
        k = int(np.searchsorted(cut, begin, "right"))
        while at < end:
            stop = min(end, int(cut[k]) if k < len(cut) else end)
            base = int(cut[k - 1]) if k else 0
            piece = tokens[at - begin:stop - begin]
            out.append((doc[i].as_py(), at - begin, stop - at, zlib.crc32(piece.tobytes()), end - begin,
                        sequence + k, at - base, key[i].as_py()))
            at, k = stop, k + 1
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "hilbert_key"]
    columns = list(zip(*out)) if out else [[]] * len(names)
    rows = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
    return rows, sequence + total // length, total % length


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, hilbert_key."""
    tokens = Scratch(docs.sparkSession, "packing").keep(tokenised(docs, vocabulary), "tokens")
    total = tokens.agg(F.sum("pk_tokens")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_TOKENS))
    ordered = tokens.repartitionByRange(parts, "pk_key", "doc_id", "pk_crc").sortWithinPartitions("pk_key", "doc_id", "pk_crc")
    return ordered.select("doc_id", "pk_ids", "pk_tokens", "pk_key").mapInArrow(
        lambda batches: pack_partition(batches, length), _PIECES)


def query(docs: DataFrame) -> DataFrame:
    return pack(docs)


def stage(docs: DataFrame) -> DataFrame:
    return pack(docs)
