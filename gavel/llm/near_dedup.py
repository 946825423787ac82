"""Near-dedup by Order MinHash with alignment of the candidates.

A text is the sequence of its five-word shingles (words cut at blanks, A-Z
lower-cased), each labelled with its occurrence number, so that all are
different.  A sketch takes, for each of ``BANDS`` hash functions, the ``PICKS``
smallest labelled shingles in the order they have in the text; texts with an
equal pick are candidates.  Candidates are verified by aligning their shingle
sequences inside a band: with L aligned shingles of n and m, the similarity is
``L / (n + m - L)``, the Jaccard similarity of the sequences when order counts.
Texts linked at ``THRESHOLD`` or more, directly or through others, form a class.

Recall: with U shingles in two texts together and L in common, a band agrees with
probability C(L, 4) / C(U, 4).  At similarity 0.8 all 24 bands miss a pair with
probability 3e-6 for long texts, 1e-5 for U = 20 and 6e-5 for U = 10.  For U of 9
or less, 0.8 means that one text has exactly one shingle more than the other;
such texts (``SHORT`` shingles at most) also meet on their whole sequence and on
all sequences with one shingle left out, so none of these pairs is missed.

Candidates that can't have a partner go first: a text with more than a share
1 - ``THRESHOLD`` of shingles that no other candidate has is in no pair.  This
takes away most of what only shares a passage.

No bucket is expanded into pairs.  It is settled with a pivot, its member with
the most candidates; buckets with one pivot are one.  The members of a pivot with
at most ``MANY`` of them and ``MANY_SHINGLES`` shingles (``FEW`` members, if they
are long) are settled by one task at once: their common shingles are counted, and
those in different classes that have enough are aligned.  A larger group is
settled with the pivot's cover: its shingles and those of
``COMPANIONS`` more such members.  Every member is aligned with all of these; the members are dealt by (pivot, salt) and
stream past the cover, which is sent once for each salt.  For any two members in
different classes, either they share a shingle outside the cover, or all that
they share lies in the cover.  In the first case they share one of the rarest
shingles that each has outside the cover, as many as may be missing from a
partner; its holders make up a new, smaller bucket (the pivot is not in it).
In the other case the smaller of their two counts of shingles in the cover
bounds their similarity, and only pairs that reach the threshold by this bound
are aligned.  Buckets whose members are in one class are done.

Defined cases: equal texts are one class whatever their length; a text of fewer
than five words is one shingle; texts without words are copies of equal texts
only; a null text is alone in its class; rows that share a doc_id are classed
each by their own text; a class without any doc_id has a null class_id.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.common import Scratch, SpanHash, chunks, mix, shielded, utf8, word_spans
from gavel.llm.components import merged

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
PICKS = 4
COMPANIONS = 2
SHORT = 9
_SLACK = 1e-9  # for products with the threshold that are whole numbers but for rounding
FEW = 32
MANY = 1024
MANY_SHINGLES = 1 << 20
_BITMAP = 1 << 15  # bits of one of Spark's bitmaps
SALT_ROWS = 500  # members that stream past one copy of a cover
_SEED = np.random.default_rng(77)
_XOR = _SEED.integers(0, 2**64, BANDS, np.uint64)
_TIMES = _SEED.integers(0, 2**64, BANDS, np.uint64) | np.uint64(1)
_TOP = np.uint64(2**64 - 1)


# ------------------------------------------------------------------- numpy

def labelled_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-labelled shingles of a chunk of texts, and where each text's begin."""
    starts, ends, first = word_spans(data, offsets)
    words = SpanHash.of_bytes(data, lowered=True)(starts, ends)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    at, stop = np.arange(len(words)), first[1:][doc]
    whole = (at + SHINGLE <= stop) | ((n[doc] < SHINGLE) & (at == first[:-1][doc]))
    at, doc = at[whole], doc[whole]
    hashes = SpanHash(words)(at, np.minimum(at + SHINGLE, first[1:][doc]))
    key = mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])[:len(order)]
    run = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = np.arange(len(order)) - run
    labelled = mix(hashes + occurrence * np.uint64(0xD6E8FEB86659FD93))
    return labelled, np.searchsorted(doc, np.arange(len(n) + 1))


def sketch(labelled: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Texts x BANDS keys of the smallest shingles in text order; only for texts that have shingles."""
    size = np.diff(begin)
    begin, size = begin[:-1][size > 0], size[size > 0]
    keys = np.empty((len(size), BANDS), np.uint64)
    if not len(size):
        return keys
    for band in range(BANDS):
        h = (labelled ^ _XOR[band]) * _TIMES[band]
        h ^= h >> np.uint64(32)
        picks = []
        for _ in range(PICKS):  # a text with fewer shingles picks its last one again
            where = np.flatnonzero(h == np.repeat(np.minimum.reduceat(h, begin), size))
            picks.append(where[np.searchsorted(where, begin)])
            h[picks[-1]] = _TOP
        key = np.full(len(size), band, np.uint64)
        for pick in np.sort(picks, axis=0):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) + labelled[pick])
        keys[:, band] = key
    return keys


def short_keys(labelled: np.ndarray) -> np.ndarray:
    """Keys by which a short text meets every text that has one shingle more or less: its sequence, and all with one left out."""
    def key(shingles):
        h = np.full(1, BANDS, np.uint64)
        for x in shingles:
            h = mix(h * np.uint64(0x9FB21C651E98DF25) + x)
        return h
    n = len(labelled)
    if not 4 <= n <= SHORT:
        return np.zeros(0, np.uint64)
    return np.concatenate([key(labelled)] + [key(np.delete(labelled, k)) for k in range(n) if n > 4])


class Aligner:
    """One sequence without repeats, sorted once, to be aligned with many others."""

    def __init__(self, sequence: np.ndarray):
        self.order = np.argsort(sequence, kind="stable")
        self.sorted = sequence[self.order]

    def similarity(self, other: np.ndarray, least: float) -> float:
        """Aligned Jaccard similarity; 0 if it is below ``least``.

        As no value repeats, the longest common subsequence is the longest
        increasing run of matched places; a similarity of ``least`` bounds the
        insertions and deletions, and so the band around the diagonal.
        """
        n, m = len(self.sorted), len(other)
        if not n or not m or min(n, m) < least * max(n, m) - _SLACK:
            return 0.0
        at = np.minimum(np.searchsorted(self.sorted, other), n - 1)
        i = np.flatnonzero(self.sorted[at] == other)
        j = self.order[at[i]]
        j = j[np.abs(i - j) <= (n + m) * (1 - least) / (1 + least) + _SLACK]
        aligned = len(j)
        if aligned < least * (n + m - aligned) - _SLACK:
            return 0.0
        if aligned and not (np.diff(j) > 0).all():
            tails: list[int] = []
            for x in j.tolist():
                k = bisect_left(tails, x)
                tails[k:k + 1] = [x]
            aligned = len(tails)
        found = aligned / (n + m - aligned)
        return found if found >= least else 0.0


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    return Aligner(a).similarity(b, least)


def common_counts(texts: list[np.ndarray]) -> np.ndarray:
    """How many values any two of some sequences without repeats have in common: values that a share of the sequences
    hold by products of matrices, rarer ones by their pairs of holders.  Only counts off the diagonal are meant."""
    n = len(texts)
    column = np.unique(np.concatenate(texts), return_inverse=True)[1]
    row = np.repeat(np.arange(n), [len(t) for t in texts])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    holders = np.bincount(column)
    first = np.cumsum(holders) - holders
    found = np.zeros((n, n))
    often = holders * FEW > n
    number = np.cumsum(often & (holders > 1)) - 1
    at = np.flatnonzero((often & (holders > 1))[column])
    edges = np.searchsorted(number[column[at]], np.arange(0, number[-1] + 1 + MANY, MANY) if len(at) else [0])
    for k, (x, y) in enumerate(zip(edges[:-1], edges[1:])):
        block = np.zeros((n, MANY), np.float32)
        block[row[at[x:y]], number[column[at[x:y]]] - k * MANY] = 1
        found += block @ block.T
    at = np.flatnonzero((~often & (holders > 1))[column])
    for part in np.split(at, range(1 << 15, len(at), 1 << 15)):
        many = holders[column[part]]
        other = np.arange(many.sum()) + np.repeat(first[column[part]] - np.cumsum(many) + many, many)
        found += np.bincount(np.repeat(row[part], many) * n + row[other], minlength=n * n).reshape(n, n)
    return found


# ------------------------------------------------------------------- Spark

def _node(text="text"):
    """128-bit hash of a text; null for a null text."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def sketches(texts: DataFrame) -> DataFrame:
    """node and its keys (one per band, and those of short texts) of each text with words; ``texts`` has node and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in chunks(offsets):
                part = offsets[i:j + 1]
                labelled, begin = labelled_shingles(data[part[0]:part[-1]], part - part[0])
                size = np.diff(begin)
                keys = list(sketch(labelled, begin).view(np.int64))
                for row, k in enumerate(np.flatnonzero(size)):
                    if size[k] <= SHORT:
                        keys[row] = np.concatenate([keys[row], short_keys(labelled[begin[k]:begin[k + 1]]).view(np.int64)])
                nodes = batch.column(0)[i:j].filter(pa.array(size > 0))
                yield pa.RecordBatch.from_arrays([nodes, pa.array(keys, pa.list_(pa.int64()))], names=["node", "keys"])

    return texts.select("node", "text").mapInArrow(run, "node binary, keys array<long>")


def sequences(texts: DataFrame) -> DataFrame:
    """node and its labelled shingles as little-endian 64-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in chunks(offsets):
                part = offsets[i:j + 1]
                labelled, begin = labelled_shingles(data[part[0]:part[-1]], part - part[0])
                seqs = [labelled[x:y].astype("<u8").tobytes() for x, y in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(seqs, pa.binary())], names=["node", "seq"])

    return texts.select("node", "text").mapInArrow(run, "node binary, seq binary")


def aligned(pairs: DataFrame, seqs: DataFrame, least: float) -> DataFrame:
    """pivot, node and their similarity (0: below ``least``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [similarity(np.frombuffer(a.as_py(), "<u8"), np.frombuffer(b.as_py(), "<u8"), least)
                     for a, b in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())],
                                             names=["pivot", "node", "sim"])

    theirs = seqs.select(F.col("node").alias("pivot"), F.col("seq").alias("pivot_seq"))
    return (pairs.join(seqs, "node").join(theirs, "pivot").select("pivot", "node", "pivot_seq", "seq")
            .mapInArrow(run, "pivot binary, node binary, sim double"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, comp) of every text that is linked to a different text; other texts are classes of their own."""
    scratch = Scratch(docs.sparkSession, "near")
    texts = docs.where(F.col("text").isNotNull()).select(_node().alias("node"), "text")
    banded = scratch.keep(sketches(texts), "sketches").select("node", F.explode("keys").alias("bid"))
    some = F.xxhash64("node")
    shared = banded.groupBy("bid").agg(F.min(some).alias("low"), F.max(some).alias("high")).where("low != high").select("bid")
    shared = scratch.keep(shared, "shared")  # a side read anew is dealt anew, so a hot bucket's rows can be split
    buckets = scratch.keep(banded.join(shared, "bid", "left_semi").distinct(), "candidates")
    nodes = scratch.keep(buckets.select("node").distinct(), "nodes")
    seqs = scratch.keep(sequences(texts.join(nodes.hint("merge"), "node", "left_semi")).groupBy("node").agg(F.first("seq").alias("seq")), "all")
    alone = scratch.keep(_without_partner(seqs, threshold), "alone")
    buckets = scratch.keep(buckets.join(alone, "node", "left_anti"), "buckets")
    nodes = nodes.join(alone, "node", "left_anti")
    seqs = scratch.keep(seqs.join(alone, "node", "left_anti"), "seqs")
    for name in ("sketches", "shared", "candidates", "all"):
        scratch.clear(name)

    sizes = buckets.groupBy("bid").agg(F.count("*").alias("n"))
    weights = buckets.join(sizes, "bid").groupBy("node").agg(F.sum("n").alias("weight"))
    weights = scratch.keep(weights.join(seqs.select("node", (F.octet_length("seq") / 8).cast("long").alias("size")), "node"), "weights")
    comps, step = nodes.select("node", F.col("node").alias("comp")), 0
    while True:
        mixed = (buckets.join(comps, "node").groupBy("bid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
                 .where("low != high").select("bid"))
        member = scratch.keep(buckets.join(mixed, "bid", "left_semi"), f"{step}/members")
        if member.isEmpty():
            return comps
        pairs = scratch.keep(_pivoted(member, weights), f"{step}/pairs")
        few = (F.col("n") <= FEW) | (F.col("n") <= MANY) & (F.col("size") <= MANY_SHINGLES)
        pivots = pairs.join(weights, "node").groupBy("pivot").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        pivots = scratch.keep(pivots.select("pivot", "n", few.alias("few")), f"{step}/pivots")
        small, large = pivots.where("few"), pivots.where("NOT few")
        links, done = _among_few(pairs.join(small, "pivot", "left_semi").join(comps, "node"), seqs, threshold), large.isEmpty()
        if not done:
            against = scratch.keep(_against_cover(pairs.join(large, "pivot", "left_semi"), large, weights, seqs, threshold, scratch, step),
                                   f"{step}/against")
            links = links.union(against.select(F.explode("links").alias("a"), F.col("node").alias("b")))
        comps = merged(comps, links, scratch, f"linked{step}")
        if not done:
            held = scratch.keep(against.select("pivot", "node", "covered", "size", "rest").join(comps, "node"), f"{step}/held")
            open_pivots = held.groupBy("pivot").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
            held = held.join(scratch.keep(open_pivots.select("pivot"), f"{step}/open"), "pivot", "left_semi")
            close = aligned(_close_in_cover(held, threshold), seqs, threshold).where(F.col("sim") >= threshold)
            comps = merged(comps, close.select(F.col("pivot").alias("a"), F.col("node").alias("b")), scratch, f"close{step}")
            buckets = scratch.keep(_sharing_outside(held, threshold, scratch, step), f"buckets{step}")
        scratch.clear(str(step))  # all that later rounds read is written elsewhere
        if done:
            return comps
        step += 1


def _without_partner(seqs: DataFrame, threshold: float) -> DataFrame:
    """The nodes of which more than a share 1 - ``threshold`` of the shingles is in no other node's sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = [np.frombuffer(x.as_py(), "<i8") for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, pa.list_(pa.int64()))], names=["node", "shingles"])

    rows = (seqs.select("node", "seq").mapInArrow(run, "node binary, shingles array<long>")
            .select(F.xxhash64("node").alias("who"), F.explode("shingles").alias("shingle")))
    own = (rows.groupBy("shingle").agg(F.min("who").alias("who"), F.max("who").alias("other")).where("who = other")
           .groupBy("who").agg(F.count("*").alias("own")))
    n = F.octet_length("seq") / 8
    return seqs.join(own, F.xxhash64("node") == F.col("who")).where(n - F.col("own") < threshold * n - _SLACK).select("node")


def _pivoted(member: DataFrame, weights: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's pivot."""
    weighed = member.join(weights, "node")
    heaviest = weighed.groupBy("bid").agg(F.max(F.struct("weight", F.xxhash64("node"), "node")).alias("top"))
    return member.join(heaviest.select("bid", F.col("top.node").alias("pivot")), "bid").select("pivot", "node").distinct()


def _against_cover(pairs: DataFrame, pivots: DataFrame, weights: DataFrame, seqs: DataFrame, threshold: float, scratch: Scratch,
                   step: int) -> DataFrame:
    """Each member of a bucket against its pivot's cover: pivot, node, the texts of the cover that it is linked to,
    how many of its shingles the cover has (covered), how many it has itself (size), and the others (rest)."""
    pairs = scratch.keep(pairs, f"{step}/large")
    order = Window.partitionBy("pivot").orderBy(F.desc("weight"), F.xxhash64("node"), "node")
    others = (pairs.where("pivot != node").join(weights, "node").withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= COMPANIONS).select("pivot", "node"))
    salts = pivots.select("pivot", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts"))
    covers = (salts.select("pivot", F.col("pivot").alias("node")).union(others).join(salts, "pivot").join(seqs, "node")
              .select("pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("member"), "node", "seq"))
    members = pairs.join(salts, "pivot").join(seqs, "node").select(
        "pivot", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("member"), "node", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, cover, inside = None, [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for key, salt, is_member, node, seq in zip(*(c.to_pylist() for c in part.columns)):
                    own = np.frombuffer(seq, "<u8")
                    if (key, salt) != pivot:
                        pivot, cover, inside = (key, salt), [], None
                    if not is_member:
                        cover.append((node, Aligner(own)))
                        continue
                    if inside is None:
                        inside = np.sort(np.concatenate([a.sorted for _, a in cover]))
                    known = inside[np.minimum(np.searchsorted(inside, own), len(inside) - 1)] == own
                    out.append((key, node, [k for k, a in cover if k != node and a.similarity(own, threshold)], int(known.sum()), len(own),
                                own[~known].view(np.int64)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)

    kinds = [pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = ["pivot", "node", "links", "covered", "size", "rest"]
    dealt = covers.unionByName(members).repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "member")
    return dealt.mapInArrow(run, "pivot binary, node binary, links array<binary>, covered long, size long, rest array<long>")


def _among_few(few: DataFrame, seqs: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the members of a pivot that are in different classes; every pivot has at most ``MANY`` members."""
    def links(group: list[tuple]) -> list[tuple]:
        texts = [np.frombuffer(seq, "<u8") for _, _, seq in group]
        size, first = np.array([len(x) for x in texts]), {}
        comps = np.array([first.setdefault(comp, k) for k, (_, comp, _) in enumerate(group)])
        able = np.ones((len(group), len(group)), bool)
        if size.sum() <= MANY_SHINGLES and len(first) > 1:
            able = common_counts(texts) * (1 + threshold) >= threshold * (size[:, None] + size) - _SLACK
        out = []
        for i, (node, _, _) in enumerate(group):
            others, own = np.flatnonzero(able[i, :i] & (comps[:i] != comps[i])), None
            for j in others:
                if comps[i] != comps[j]:
                    own = own or Aligner(texts[i])
                    if own.similarity(texts[j], threshold):
                        out.append((node, group[j][0]))
                        comps[comps == comps[i]] = comps[j]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, group = None, []
        for batch in batches:
            out = []
            for key, *member in zip(*(c.to_pylist() for c in batch.columns)):
                if key != pivot:
                    out += links(group)
                    pivot, group = key, []
                group.append(member)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["a", "b"])
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links(group)], pa.binary()) for k in (0, 1)], names=["a", "b"])

    dealt = few.join(seqs, "node").select("pivot", "node", "comp", "seq").repartition("pivot").sortWithinPartitions("pivot", "node")
    return dealt.mapInArrow(run, "a binary, b binary")


def _close_in_cover(held: DataFrame, threshold: float) -> DataFrame:
    """Pairs (pivot, node) of texts in different classes that can be linked by what they share inside the cover.

    L shingles in common make a similarity of ``threshold`` only if L is at least
    ``threshold / (1 + threshold)`` of both sizes together, and L is at most what
    the cover has of either.  One of the two is outside the cover's largest class.
    """
    share = threshold / (1 + threshold)
    can = held.where(F.col("covered") >= threshold * F.col("size")).select("pivot", "node", "covered", "size", "comp")
    largest = (can.groupBy("pivot", "comp").agg(F.count("*").alias("n")).groupBy("pivot")
               .agg(F.max(F.struct("n", "comp")).alias("top")).select("pivot", F.col("top.comp").alias("main")))
    can = can.join(largest, "pivot")
    u, v = can.where("comp != main").alias("u"), can.alias("v")
    bound = F.least("u.covered", "v.covered") >= share * (F.col("u.size") + F.col("v.size"))
    apart = (F.col("u.comp") < F.col("v.comp")) | ((F.col("u.comp") > F.col("v.comp")) & (F.col("v.comp") == F.col("v.main")))
    return u.join(v, (F.col("u.pivot") == F.col("v.pivot")) & bound & apart).select(
        F.col("u.node").alias("pivot"), F.col("v.node").alias("node")).distinct()


def _sharing_outside(held: DataFrame, threshold: float, scratch: Scratch, step: int) -> DataFrame:
    """New buckets (bid, node): the holders of a shingle outside the cover, if they are in different classes.

    A text of n shingles shares at least ``threshold * n`` with a partner, so it
    shares one of any n - ceil(threshold * n) + 1 of its shingles; the rarest are
    taken, first those that no other member has, which make no bucket.  Members of a
    pivot's largest class only look for members of others, so of theirs only the
    shingles are listed that some other member may have, by a bitmap of these.
    """
    largest = (held.groupBy("pivot", "comp").agg(F.count("*").alias("n")).groupBy("pivot")
               .agg(F.max(F.struct("n", "comp")).alias("top")).select("pivot", F.col("top.comp").alias("main")))
    columns = ["pivot", "node", "comp", "size", (F.col("size") - F.col("covered")).alias("outside"), "rest"]
    sided = held.join(scratch.keep(largest, f"{step}/largest"), "pivot")
    others, main = sided.where("comp != main").select(*columns), sided.where("comp = main").select(*columns)
    bits = (others.select("pivot", F.explode("rest").alias("shingle")).groupBy("pivot")
            .agg(F.bitmap_construct_agg(F.col("shingle").bitwiseAND(F.lit(_BITMAP - 1))).alias("bits")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for rest, known in zip(batch.column("rest"), batch.column("bits")):
                own = rest.values.to_numpy()
                kept.append(own[np.unpackbits(np.frombuffer(known.as_py(), np.uint8), bitorder="little")[own & (_BITMAP - 1)] == 1])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(kept, pa.list_(pa.int64()))], names=[*names, "rest"])

    names = ["pivot", "node", "comp", "size", "outside"]
    main = main.join(scratch.keep(bits, f"{step}/bits"), "pivot").mapInArrow(
        run, "pivot binary, node binary, comp binary, size long, outside long, rest array<long>")
    rows = others.unionByName(main).select(*names, F.explode("rest").alias("shingle"))
    counts = rows.groupBy("pivot", "shingle").agg(F.count("*").alias("n")).where("n > 1")
    shared = rows.join(counts, ["pivot", "shingle"])
    one = Window.partitionBy("pivot", "node")  # the shingles of one text
    room = F.col("size") - F.ceil(threshold * F.col("size") - _SLACK) + 1 - (F.col("outside") - F.count("*").over(one))
    shared = (shared.withColumn("room", room).withColumn("rank", F.row_number().over(one.orderBy("n", "shingle")))
              .where("rank <= room").select("pivot", "node", "comp", "shingle"))
    sets = shared.groupBy("pivot", "shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n"),
                                                  F.bit_xor(F.xxhash64("node")).alias("who")).where("low != high")
    first = sets.groupBy("pivot", "n", "who").agg(F.min("shingle").alias("shingle")).select("pivot", "shingle")  # one for equal sets
    key = F.xxhash64("pivot", "shingle").alias("bid")
    return shared.join(first, ["pivot", "shingle"], "left_semi").select(key, "node").distinct()


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, nd_node and nd_comp of every row with a text."""
    comps = classes(docs.select("doc_id", "text")).withColumnRenamed("node", "nd_node")
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", _node().alias("nd_node"))
    return rows.join(comps, "nd_node", "left").select("doc_id", "nd_node", F.coalesce("comp", "nd_node").alias("nd_comp"))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class) and class_size of every document."""
    rows = _rows(docs)
    of = rows.groupBy("nd_comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    null = docs.where(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return rows.join(of, "nd_comp").select("doc_id", "class_id", "class_size").unionByName(null)


def stage(docs: DataFrame) -> DataFrame:
    """One document of each class: the one with the least doc_id; all documents without a text."""
    columns = docs.columns
    docs, names = shielded(docs, "doc_id", "text")
    first = _rows(docs).groupBy("nd_comp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "nd_node")).alias("first"))
    keepers = first.select(F.col("first.nd_node").alias("nd_node"), F.col("first.doc_id").alias("nd_doc"))
    texts = docs.where(F.col("text").isNotNull()).withColumn("nd_node", _node())
    kept = texts.join(keepers, ["nd_node"]).where(F.col("doc_id").eqNullSafe(F.col("nd_doc"))).dropDuplicates(["nd_node"])
    out = kept.select(*docs.columns).unionByName(docs.where(F.col("text").isNull()))
    return out.withColumnsRenamed(names).select(*columns)
