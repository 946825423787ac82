"""Token-count rollups maintained by signed deltas.

A batch is a table of signed rows (source, lang, tokenizer, d_docs, d_tokens):
an insert adds a document and its tokens, a delete takes both away, and a
revised count adds the difference.  A committed batch is summed to one row per
key, written to a folder of its own, and entered in the ledger's commit log;
only then does it count.  A batch id that the log already has is not applied
again, and totals read one folder per id, so a replayed or half-written batch
changes nothing.  Totals are the sums of all committed deltas; ``compact``
folds them into one snapshot batch, entered together with the ids of all that it
folds, which can then neither be applied again nor read by name.

Defined cases: a null or empty text has no tokens; null source or lang is a key
of its own; rows that share a doc_id all count; other columns are ignored.
Keys whose documents have all been deleted leave no row.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.llm.common import Scratch, chunks, utf8, word_spans
from gavel.llm.tokens import pieces

WORDS, BPE = "words_v1", "byte_bpe_50k"
KEYS = ["source", "lang", "tokenizer"]
BYTES_PER_TOKEN = 4  # of the provisional count

_DELTA = "source string, lang string, tokenizer string, d_docs long, d_tokens long"


class Ledger:
    """Committed delta batches below one folder of the shared checkpoint directory."""

    def __init__(self, spark: SparkSession):
        self.spark, self.scratch = spark, Scratch(spark, "ledger")
        self.log, self.tries = f"{self.scratch.root}/log", 0
        self._enter(("", ""))  # so that the log can be read

    def _enter(self, *entries: tuple[str, str]) -> None:
        self.spark.createDataFrame(entries, "batch string, path string").coalesce(1).write.mode("append").parquet(self.log)

    def committed(self) -> dict[str, str]:
        """Folder of each committed batch ("": folded into another): the first in order, if a batch was entered twice."""
        rows = self.spark.read.parquet(self.log).where("batch != ''").groupBy("batch").agg(F.min("path").alias("path"))
        return {r["batch"]: r["path"] for r in rows.collect()}  # one row per batch

    def commit(self, batch: str, rows: DataFrame, folds: Iterable[str] = ()) -> bool:
        """Apply a batch of signed rows once; False if it was committed before.  The ids in ``folds`` count as applied with it."""
        if batch in self.committed():
            return False
        self.tries += 1
        path = f"{self.scratch.root}/batch={batch}/try={self.tries}"
        deltas = rows.groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        deltas.write.parquet(path)
        self._enter((batch, path), *((b, "") for b in folds))
        return True

    def deltas(self, *batches: str) -> DataFrame:
        """Rows of the committed batches, or of those named."""
        paths = sorted(p for b, p in self.committed().items() if p and (not batches or b in batches))
        reader = self.spark.read.schema(_DELTA)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], _DELTA)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens."""
        return self.deltas().groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")).where(
            "n_docs != 0 OR n_tokens != 0")

    def compact(self) -> Ledger:
        """A new ledger whose only batch is the sum of this one's; its log has all their ids, so none can be applied again."""
        new, folded = Ledger(self.spark), sorted(self.committed())
        digest = hashlib.md5(json.dumps(folded).encode()).hexdigest()
        new.commit(f"snapshot-{digest}", self.deltas(), folded)
        return new


def signed(counts: DataFrame, tokenizer: str, tokens, sign: int = 1, docs: int | None = None) -> DataFrame:
    """Signed rows of a table of documents; ``docs`` 0 for a revised count."""
    return counts.select("source", "lang", F.lit(tokenizer).alias("tokenizer"),
                         F.lit(sign if docs is None else docs).cast("long").alias("d_docs"),
                         (F.lit(sign) * tokens).cast("long").alias("d_tokens"))


def counted(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, source, lang, text hash, bytes, words and BPE tokens of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(vocabulary)
        for batch in batches:
            text = batch.column(4)
            data, offsets = utf8(text)
            words = np.concatenate([np.diff(word_spans(data[(p := offsets[i:j + 1])[0]:p[-1]], p - p[0])[2])
                                    for i, j in chunks(offsets)] or [np.zeros(0, np.int64)])
            tokens = [len(i) // 2 for at in range(0, len(text), 256) for i in table.encode_all(text[at:at + 256].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(4)), pa.array(np.diff(offsets)), pa.array(words.astype(np.int64)),
                 pa.array(tokens, pa.int64())], names=["doc_id", "source", "lang", "tc_text", "n_bytes", "n_words", "n_bpe"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"),
                       F.md5(F.encode("text", "UTF-8")).alias("tc_text"), "text").mapInArrow(
        run, "doc_id long, source string, lang string, tc_text string, n_bytes long, n_words long, n_bpe long")


def copies(counts: DataFrame) -> DataFrame:
    """The rows whose text an earlier row has: all but the least doc_id of equal texts.

    Rows equal in text and doc_id are kept or deleted together; null texts are no copies.
    """
    first = counts.groupBy("tc_text").agg(F.min("doc_id").alias("tc_first"))
    return counts.join(first, "tc_text").where(F.coalesce(F.col("doc_id") != F.col("tc_first"), F.col("tc_first").isNotNull()))


def maintained(docs: DataFrame) -> Ledger:
    """The ledger of a corpus that is loaded, counted exactly, and then freed of exact copies.

    insert: every document, with its words and a provisional BPE count of a
    token per ``BYTES_PER_TOKEN`` bytes.  revise: the exact BPE count in place
    of the provisional one.  delete: the exact copies, under both tokenizers.
    """
    ledger = Ledger(docs.sparkSession)
    counts = ledger.scratch.keep(counted(docs), "counts")
    provisional = F.ceil(F.col("n_bytes") / BYTES_PER_TOKEN)
    ledger.commit("insert", signed(counts, WORDS, F.col("n_words")).union(signed(counts, BPE, provisional)))
    ledger.commit("revise", signed(counts, BPE, F.col("n_bpe") - provisional, docs=0))
    gone = copies(counts)
    ledger.commit("delete", signed(gone, WORDS, F.col("n_words"), -1).union(signed(gone, BPE, F.col("n_bpe"), -1)))
    return ledger


def query(docs: DataFrame) -> DataFrame:
    """source, lang, tokenizer, and documents and tokens: of all rows, of exact copies, and n_docs, n_tokens of the distinct texts.

    The copies are what the delete batch took off; a key of copies only keeps its row.
    """
    ledger, none = maintained(docs), F.lit(0).cast("long")
    loaded, gone = ledger.deltas("insert", "revise"), ledger.deltas("delete")
    rows = loaded.select(*KEYS, F.col("d_docs").alias("all_docs"), F.col("d_tokens").alias("all_tokens"),
                         none.alias("copy_docs"), none.alias("copy_tokens"))
    rows = rows.union(gone.select(*KEYS, none, none, -F.col("d_docs"), -F.col("d_tokens")))
    sums = ["all_docs", "all_tokens", "copy_docs", "copy_tokens"]
    return rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in sums)).select(
        *KEYS, (F.col("all_docs") - F.col("copy_docs")).alias("n_docs"), (F.col("all_tokens") - F.col("copy_tokens")).alias("n_tokens"), *sums)
