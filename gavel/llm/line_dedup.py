"""Line dedup over levelled sorted runs of line hashes.

A line is a ``\\n``-split piece of a text; its key has blanks ``[\\x20\\x09-\\x0D]``
stripped at both ends and A-Z lower-cased.  ``LineIndex`` is a log-structured
set of 128-bit key hashes, each with the first document that holds it: a batch
of documents merge-anti-joins every run, and the keys that no run has become a
new sorted run on level 0.  When a level holds ``fanout`` runs they are merged
into one run of the next level.  Batches must come in ascending doc_id, so the
owner kept for a key is its smallest doc_id.

Defined cases: a null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped; rows that share a doc_id are one
document (none of them loses a line to another); a null doc_id comes after all
others, owns nothing, and loses the lines that any other document owns.
Other columns are carried through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from gavel.llm.common import Scratch, shielded

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2

_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
_PER_CHAR = 4  # bytes of a code point at most
_KEY_SCHEMA = T.StructType([T.StructField("ld_doc", T.LongType()), T.StructField("ld_hi", T.LongType()),
                            T.StructField("ld_lo", T.LongType())])
_OUT = "n_lines long, n_dropped long, text string"


def line_key(line: bytes) -> bytes:
    """Key of a line in UTF-8 (``bytes.lower`` changes A-Z alone)."""
    return line.strip(_BLANKS).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= _PER_CHAR * min_chars or len(key.decode()) >= min_chars)


def long_keys(text: str | None, min_chars: int) -> set[bytes]:
    """Hashes of the distinct long keys of a text."""
    lines = {line.strip(_BLANKS) for line in (text or "").encode().lower().split(b"\n")}
    return {xxh3_128_digest(key) for key in lines if long_enough(key, min_chars)}


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document and distinct long line key: ld_doc, ld_hi, ld_lo."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out_ids, digests = batch.column(0).to_pylist(), [], []
            for i, text in enumerate(batch.column(1)):
                keys = long_keys(text.as_py(), min_chars)
                digests += keys
                out_ids += [ids[i]] * len(keys)
                if len(out_ids) > 200_000:
                    yield _pack(out_ids, digests)
                    out_ids, digests = [], []
            yield _pack(out_ids, digests)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _KEY_SCHEMA)


def _pack(ids: list, digests: list[bytes]) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(halves[:, 0].copy()),
                                       pa.array(halves[:, 1].copy())], names=_KEY_SCHEMA.names)


class LineIndex:
    """Levelled sorted runs ``(ld_hi, ld_lo) -> ld_owner`` below one folder of the shared checkpoint directory."""

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, fanout: int = FANOUT):
        self.spark, self.min_chars, self.fanout = spark, min_chars, fanout
        self.scratch = Scratch(spark, "lines")
        self.levels: list[list[DataFrame]] = [[]]
        self.written = 0

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        ordered = rows.repartition("ld_hi", "ld_lo").sortWithinPartitions("ld_hi", "ld_lo")
        self.levels[level].append(self.scratch.keep(ordered, f"level={level}/run={self.written}"))
        self.written += 1

    def add(self, batch: DataFrame) -> None:
        """Add a batch of documents, all with larger doc_ids than those added before."""
        new = line_keys(batch, self.min_chars).groupBy("ld_hi", "ld_lo").agg(F.min("ld_doc").alias("ld_owner"))
        for run in self.runs():
            new = new.join(run.hint("merge"), ["ld_hi", "ld_lo"], "left_anti")
        self._write(new, 0)
        self._compact()

    def _compact(self) -> None:
        """Merge full levels downwards; runs hold disjoint keys, so merging is a sorted union."""
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                merged = reduce(DataFrame.unionByName, self.levels[level])
                self._write(merged, level + 1)
                self.levels[level] = []
                return self._compact()

    def owners(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.runs())

    def dropped(self, docs: DataFrame) -> DataFrame:
        """ld_doc and the array of key hashes that the document loses."""
        keys = line_keys(docs, self.min_chars)
        lost = keys.join(self.owners().hint("merge"), ["ld_hi", "ld_lo"]).where(
            F.col("ld_owner").isNotNull() & ~F.col("ld_owner").eqNullSafe(F.col("ld_doc")))
        return lost.groupBy("ld_doc").agg(F.collect_set(F.struct("ld_hi", "ld_lo")).alias("ld_lost"))


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Doc_id cut points of about equal batches (any cut points give the same result)."""
    shares = [i / batches for i in range(1, batches)]
    if not shares:
        return []
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 1000)).first()[0]
    return sorted(set(cuts or []))


def build_index(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> LineIndex:
    index = LineIndex(docs.sparkSession, min_chars, fanout)
    bounds = batch_bounds(docs, batches)
    doc = F.col("doc_id").cast("long")
    for low, high in zip([None, *bounds], [*bounds, None]):
        inside = F.lit(True) if low is None else doc > low
        inside = inside & (doc <= high) if high is not None else inside | doc.isNull()
        index.add(docs.where(inside))
    return index


def _rebuild(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, losts in frames:
        out = []
        for text, lost in zip(texts, losts):
            lines = (text or "").split("\n")
            if lost is None or not len(lost):
                out.append((len(lines), 0, text))
                continue
            gone = {np.array([p["ld_hi"], p["ld_lo"]], "<i8").tobytes() for p in lost}
            kept = [x for x in lines if xxh3_128_digest(line_key(x.encode())) not in gone]
            out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
        yield pd.DataFrame(out, columns=["n_lines", "n_dropped", "text"])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                fanout: int = FANOUT) -> DataFrame:
    """All columns of ``docs`` plus the struct ``ld_out`` (n_lines, n_dropped, text)."""
    docs, names = shielded(docs, "doc_id", "text")
    index = build_index(docs, min_chars, batches, fanout)
    rebuild = F.pandas_udf(_rebuild, _OUT)
    lost = index.dropped(docs)
    doc = F.col("doc_id").cast("long")
    joined = docs.withColumn("ld_key", doc).join(lost, F.col("ld_key").eqNullSafe(F.col("ld_doc")), "left")
    return joined.withColumn("ld_out", rebuild("text", "ld_lost")).drop("ld_key", "ld_doc", "ld_lost").withColumnsRenamed(names)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "ld_out.n_lines", "ld_out.n_dropped",
        F.sha2(F.coalesce("ld_out.text", F.lit("")), 256).alias("kept_sha256"))


def stage(docs: DataFrame) -> DataFrame:
    """``docs`` with duplicate lines removed; n_chars follows a text that changed."""
    columns = docs.columns
    docs, names = shielded(docs, "doc_id", "text", "n_chars")
    out = dedup_lines(docs).withColumn("text", F.col("ld_out.text"))
    if "n_chars" in columns:
        changed = F.col("ld_out.n_dropped") > 0
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop("ld_out").withColumnsRenamed(names).select(*columns)


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
owned AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.doc_id, k.pos, k.line, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN owned o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
