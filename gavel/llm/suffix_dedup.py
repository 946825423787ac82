"""Removal of repeated byte strings by a sorted table of suffixes.

A byte is removed if some ``LENGTH``-byte string that covers it also starts
anywhere else, in the same document too.  Only suffixes that can take part in a
repeat are sorted:

1. Every window of ``LENGTH`` bytes has an anchor, its smallest ``GRAM``-byte
   hash (the leftmost, in a tie).  Consecutive windows with one anchor form a
   range; equal windows have equal anchor strings, so a range whose anchor
   string is found in no other range holds no repeat.
2. The bytes a range covers are its context.  Where all ranges of an anchor
   string have the same context, all their windows repeat.
3. Contexts that differ are cut, one of each, into parts of ``PART`` windows
   aligned to the anchor.  The bytes common to a part's windows are its core:
   a part whose core is found nowhere else holds no repeat, and where all parts
   with one core are the same, all their windows repeat.
4. In the parts that are left, those with an end of a repeat in them, one
   suffix for each window is written as ``TOKENS`` hashed tokens that make up
   its first ``LENGTH`` bytes.  The suffixes are range-partitioned by their tokens with sampled
   splitters; each bucket is sorted by multikey quicksort (only ties on one
   token are sorted by the next), neighbours are compared, and the first and
   last suffixes of the buckets are compared across the boundaries, as a
   splitter may fall among equal suffixes.

Anchors and contexts are aggregated before they move, and the ranges of a hot
one are joined with its row by several tasks (``spread_join``).  The parts of
one core, one of each context, are joined by one task.

Defined cases: a null or empty text has no bytes; texts shorter than
``LENGTH`` bytes lose nothing; rows that share a doc_id are documents of their
own unless their texts are equal too, and then each repeats the other; a null
doc_id is a document like any other.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import Scratch, SpanHash, chunks, mix, text_key, utf8

LENGTH = 400
GRAM = 128
PART = 16
TOKENS = 2
BUCKET_ROWS = 4_000_000
SPREAD = 4  # shares of a shuffle partition, of which a hot key's rows fill several
PLACE_BITS = 24  # of a window's key; the others are its hash
SLICE = 1 << PLACE_BITS

_KEY = ["sx_doc", "sx_text"]
_NO_ID = -(1 << 63)


# ------------------------------------------------------------------- numpy

def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values (block-wise prefix and suffix minima)."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(values)] = values
    blocks = blocks.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1:width - 1 + n])


def ranges(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Document, first window, number of windows, anchor (from the first window), its hash and the context hash of
    every range of a chunk.

    A text of more than ``SLICE`` bytes, which is a chunk of its own, is cut into slices with disjoint windows, so
    that anchors are chosen alike in texts of any size; a range that is cut there is two ranges.
    """
    n = len(data)
    if n > SLICE and len(offsets) == 2:
        slices = []
        for s in range(0, n - length + 1, SLICE - length + 1):
            piece = data[s:s + SLICE]
            doc, at, *rest = ranges(piece, np.array([0, len(piece)]), length, gram)
            slices.append((doc, at + s, *rest))
        return tuple(np.concatenate(column) for column in zip(*slices))
    if n < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    span = SpanHash.of_bytes(data)
    at = np.arange(n - gram + 1)
    bits = np.uint64(PLACE_BITS)
    place = np.uint64(1) << bits
    hashes = span(at, at + gram)
    key = hashes >> bits << bits | at.astype(np.uint64)
    anchor = (sliding_min(key, length - gram + 1) & (place - np.uint64(1))).astype(np.int64)
    doc = np.searchsorted(offsets, np.arange(len(anchor)), "right") - 1
    good = np.arange(len(anchor)) + length <= offsets[doc + 1]
    first = good.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~good[:-1] | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(first)
    closes = np.append(good[:-1] & (first[1:] | ~good[1:]), good[-1:])
    count = np.flatnonzero(closes) - begin + 1
    context = span(begin, begin + count - 1 + length)
    return doc[begin], begin - offsets[doc[begin]], count, anchor[begin] - begin, hashes[anchor[begin]], context


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order of rows by several keys: sorted by the first; only ties are sorted by the next."""
    order = np.argsort(keys[0], kind="stable")
    tied = np.ones(len(order), bool)  # rows equal to a neighbour in all keys so far
    group = np.zeros(len(order), np.int64)
    for depth, key in enumerate(keys):
        if depth:
            at = np.flatnonzero(tied)
            rows = order[at]
            order[at] = rows[np.lexsort((key[rows], group[at]))]
        sorted_key = key[order]
        new = np.append(True, (sorted_key[1:] != sorted_key[:-1]) | (group[1:] != group[:-1]))[:len(order)]
        group = np.cumsum(new)
        tied = ~new | np.append(~new[1:], False)[:len(order)]
    return order


def covered(n: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    runs: list[list[int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], min(end, n))
        else:
            runs.append([start, min(end, n)])
    return [tuple(r) for r in runs]


# ------------------------------------------------------------------- Spark

def range_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """sx_doc, sx_text, sx_at (first window), sx_n (windows), sx_anchor, sx_gram and sx_context of every range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, j in chunks(offsets):
                part = offsets[i:j + 1]
                doc, at, n, anchor, hashes, context = ranges(data[part[0]:part[-1]], part - part[0], length, gram)
                rows = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(anchor.astype(np.int32)), pa.array(hashes.view(np.int64)), pa.array(context.view(np.int64))],
                    names=[*_KEY, "sx_at", "sx_n", "sx_anchor", "sx_gram", "sx_context"])

    return docs.select(*_KEY, "text").mapInArrow(
        run, "sx_doc long, sx_text long, sx_at int, sx_n int, sx_anchor int, sx_gram long, sx_context long")


def part_rows(texts: DataFrame, length: int) -> DataFrame:
    """sx_core, sx_part (hash of the part), sx_context, and the part's first window, windows and copies of every part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for span, wanted in _held(batches):
            at, n, anchor = (np.array([w[k] for w in wanted]) for k in ("sx_at", "sx_n", "sx_anchor"))
            low = (anchor - n + 1) // PART
            parts = anchor // PART - low + 1
            row = np.repeat(np.arange(len(wanted)), parts)
            part = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            most = np.minimum(anchor[row], part * PART + PART - 1)  # from the part's first window to the anchor
            least = np.maximum(anchor[row] - n[row] + 1, part * PART)
            place = at[row] + anchor[row]
            core = span(place - part * PART, place - part * PART - (PART - 1) + length)
            whole = mix(span(place - most, place - least + length) + (most * 4096 + least).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            column = lambda k, kind: pa.array(np.array([w[k] for w in wanted], np.int64)[row].astype(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), column("sx_context", np.int64),
                 pa.array((anchor[row] - most).astype(np.int32)), pa.array((most - least + 1).astype(np.int32)), column("sx_copies", np.int64)],
                names=["sx_core", "sx_part", "sx_context", "sx_first", "sx_windows", "sx_copies"])

    return texts.select("text", "sx_wanted").mapInArrow(
        run, "sx_core long, sx_part long, sx_context long, sx_first int, sx_windows int, sx_copies long")


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[SpanHash, list[dict]]]:
    """Hashes of each text, with its list of contexts or parts, some hundred at a time."""
    for batch in batches:
        for row in range(batch.num_rows):
            span = SpanHash.of_bytes(utf8(batch.column(0)[row:row + 1])[0])
            wanted = batch.column(1)[row].as_py()
            for k in range(0, len(wanted), 512):
                yield span, wanted[k:k + 512]


def suffix_rows(texts: DataFrame, length: int) -> DataFrame:
    """One row per window of each part: its tokens, sx_context and sx_place (offset, and whether the context repeats)."""
    width = length // TOKENS
    names = [f"sx_t{k}" for k in range(TOKENS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for span, wanted in _held(batches):
            n = np.array([w["sx_windows"] for w in wanted])
            row = np.repeat(np.arange(len(wanted)), n)
            offset = np.array([w["sx_first"] for w in wanted])[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = np.array([w["sx_at"] for w in wanted])[row] + offset
            cut = [at + t * width for t in range(TOKENS)] + [at + length]
            tokens = [span(a, b).view(np.int64) for a, b in zip(cut[:-1], cut[1:])]
            context = np.array([w["sx_context"] for w in wanted], np.int64)[row]
            many = np.array([w["sx_copies"] > 1 for w in wanted])[row]
            yield pa.RecordBatch.from_arrays([*map(pa.array, tokens), pa.array(context), pa.array(offset * 2 + many)],
                                             names=[*names, "sx_context", "sx_place"])

    return texts.select("text", "sx_wanted").mapInArrow(
        run, "".join(f"{x} long, " for x in names) + "sx_context long, sx_place long")


def compared(buckets: DataFrame) -> DataFrame:
    """Of each bucket: repeated windows of single contexts (kind 0), windows of single contexts that stand alone at
    either end (kind 1), and the first and last suffix with their number of occurrences, 2 at most (kind 2)."""
    names = [f"sx_t{k}" for k in range(TOKENS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches) or [], schema=schema)
        if not rows.num_rows:
            return
        tokens = [rows.column(x).to_numpy() for x in names]
        context, place = rows.column("sx_context").to_numpy(), rows.column("sx_place").to_numpy()
        order = multikey_order(tokens)
        tokens, context, place = [t[order] for t in tokens], context[order], place[order]
        new = np.append(True, np.any([t[1:] != t[:-1] for t in tokens], axis=0))
        begin = np.flatnonzero(new)
        weight = np.add.reduceat(1 + (place & 1), begin)
        group = np.cumsum(new) - 1
        single = (place & 1) == 0
        repeated = single & (weight[group] > 1)
        ends = np.unique([0, len(begin) - 1])
        alone = single & (weight[group] == 1) & np.isin(group, ends)
        for kind, at in ((0, np.flatnonzero(repeated)), (1, np.flatnonzero(alone)), (2, begin[ends])):
            w = np.minimum(weight[group[at]], 2)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(t[at]) for t in tokens), pa.array(context[at]), pa.array(place[at] >> 1), pa.array(w), pa.array(np.full(len(at), kind))],
                names=[*names, "sx_context", "sx_offset", "sx_weight", "sx_kind"])

    schema = pa.schema([(x, pa.int64()) for x in [*names, "sx_context", "sx_place"]])
    return buckets.mapInArrow(run, "".join(f"{x} long, " for x in names) + "sx_context long, sx_offset long, sx_weight long, sx_kind long")


def spread_join(rows: DataFrame, marks: DataFrame, key: str, *row: str) -> DataFrame:
    """``rows`` joined with ``marks``, a kept table of one row for each ``key`` and the number ``n`` of its rows.

    Where a key has more than a task's share of them, they are dealt to several tasks by the hash of ``row``.
    """
    tasks = SPREAD * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = math.ceil(marks.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0] / tasks)
    marks = marks.withColumn("sx_salts", F.ceil(F.col("n") / share).cast("int")).drop("n")
    hot = marks.where("sx_salts > 1").select(key, "sx_salts")  # fewer than ``tasks``
    salt = F.coalesce(F.pmod(F.xxhash64(*row), F.col("sx_salts")), F.lit(0)).cast("int")
    rows = rows.join(F.broadcast(hot), key, "left").withColumn("sx_salt", salt).drop("sx_salts")
    marks = marks.withColumn("sx_salt", F.explode(F.sequence(F.lit(0), F.col("sx_salts") - 1))).drop("sx_salts")
    return rows.join(marks, [key, "sx_salt"]).drop("sx_salt")


def _wanted(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*_KEY).agg(F.collect_list(F.struct(*columns)).alias("sx_wanted"))


def repeated_windows(texts: DataFrame, contexts: DataFrame, length: int, buckets: int) -> DataFrame:
    """sx_context and runs (sx_first, sx_windows) of its repeated windows, for the contexts that occur once."""
    names = [f"sx_t{k}" for k in range(TOKENS)]
    parts = part_rows(texts.join(_wanted(contexts, "sx_at", "sx_n", "sx_anchor", "sx_context", "sx_copies"), _KEY), length)
    cores = parts.groupBy("sx_core").agg(F.sum("sx_copies").alias("n"), F.min("sx_part").alias("low"), F.max("sx_part").alias("high"))
    cores = cores.where("n > 1").select("sx_core", (F.col("low") == F.col("high")).alias("sx_same"))
    parts = parts.join(cores, "sx_core").select("sx_context", "sx_first", "sx_windows", "sx_copies", "sx_same")
    run = ["sx_context", "sx_first", "sx_windows"]
    whole = parts.where("sx_same AND sx_copies = 1").select(*run)

    mixed = parts.where("NOT sx_same").join(contexts.select(*_KEY, "sx_at", "sx_context"), "sx_context")
    suffixes = suffix_rows(texts.join(_wanted(mixed, "sx_at", "sx_context", "sx_first", "sx_windows", "sx_copies"), _KEY), length)
    found = compared(suffixes.repartitionByRange(buckets, *names, "sx_context", "sx_place"))
    # two rows a bucket at most
    ends = found.where("sx_kind = 2").groupBy(*names).agg(F.sum("sx_weight").alias("sx_sum")).where("sx_sum > 1")
    window = ["sx_context", F.col("sx_offset").cast("int").alias("sx_first"), F.lit(1).alias("sx_windows")]
    inside = found.where("sx_kind = 0").select(*window)
    across = found.where("sx_kind = 1").join(ends, names, "left_semi").select(*window)
    return whole.union(inside).union(across).groupBy("sx_context").agg(
        F.collect_list(F.struct("sx_first", "sx_windows")).alias("sx_runs"))


def removed_spans(keyed: DataFrame, texts: DataFrame, scratch: Scratch, length: int, gram: int) -> DataFrame:
    """sx_doc, sx_text and the list sx_found (sx_at, sx_n, sx_runs) of ranges with repeated windows (null runs: all)."""
    rows = range_rows(keyed.where(F.octet_length("text") >= length), length, gram)
    anchors = rows.groupBy("sx_gram").agg(F.count("*").alias("n"), F.min("sx_context").alias("low"), F.max("sx_context").alias("high"))
    anchors = scratch.keep(anchors.where("n > 1").select("sx_gram", "n", (F.col("low") == F.col("high")).alias("sx_same")), "anchors")
    shared = scratch.keep(spread_join(rows, anchors, "sx_gram", *_KEY, "sx_at").drop("sx_gram"), "shared")

    mixed = shared.where(~F.col("sx_same"))
    contexts = scratch.keep(mixed.groupBy("sx_context").agg(
        F.min(F.struct(*_KEY, "sx_at", "sx_n", "sx_anchor")).alias("one"), F.count("*").alias("sx_copies")).select("one.*", "sx_context", "sx_copies"), "contexts")
    windows = contexts.agg(F.coalesce(F.sum("sx_n"), F.lit(0))).first()[0]
    least = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = repeated_windows(texts, contexts, length, max(least, math.ceil(windows / BUCKET_ROWS)))

    place = [*_KEY, "sx_at", "sx_n"]
    whole = F.lit(None).cast("array<struct<sx_first:int,sx_windows:int>>").alias("sx_runs")
    copies = contexts.where("sx_copies > 1").select("sx_context", F.col("sx_copies").alias("n"))
    copied = spread_join(mixed, copies, "sx_context", *_KEY, "sx_at")
    some = contexts.where("sx_copies = 1").join(runs, "sx_context").select(*place, "sx_runs")
    spans = shared.where("sx_same").select(*place, whole).union(copied.select(*place, whole)).union(some)
    return spans.groupBy(*_KEY).agg(F.collect_list(F.struct("sx_at", "sx_n", "sx_runs")).alias("sx_found"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, the bytes kept, these as text (without bytes of cut characters), their number before, and the removed
    runs (start, end) of every row."""
    spark = docs.sparkSession
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("sx_doc"),
                        text_key().alias("sx_text"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = keyed.repartition(parts, *_KEY)  # moved once: all joins below read the same exchange
    found = removed_spans(keyed, texts, Scratch(spark, "suffixes"), length, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                kept, shown, sizes, runs = [], [], [], []
                for text, some in zip(part.column(1), part.column(2)):
                    data = (text.as_py() or "").encode()
                    spans = []
                    for r in some.as_py() or ():
                        for w in [{"sx_first": 0, "sx_windows": r["sx_n"]}] if r["sx_runs"] is None else r["sx_runs"]:
                            begin = r["sx_at"] + w["sx_first"]
                            spans.append((begin, begin + w["sx_windows"] - 1 + length))
                    gone = covered(len(data), spans)
                    edges = [0, *(x for g in gone for x in g), len(data)]
                    kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])))
                    shown.append(kept[-1].decode("utf-8", "ignore"))
                    sizes.append(len(data))
                    runs.append([{"start": x, "end": y} for x, y in gone])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()), pa.array(shown, pa.string()), pa.array(sizes, pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=["doc_id", "kept", "text", "n_bytes", "removed"])

    return texts.join(found, _KEY, "left").select(F.nullif("sx_doc", F.lit(_NO_ID)), "text", "sx_found").mapInArrow(
        run, "doc_id long, kept binary, text string, n_bytes long, removed array<struct<start:long,end:long>>")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, the text that is kept, and whether any was removed."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return remove_repeats(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                                       F.sha2("kept", 256).alias("kept_sha256"), "text", (F.size("removed") > 0).alias("has_repeats"))
