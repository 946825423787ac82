"""Conversation prefix trie: rebuilt conversations, their distinct prefixes as nodes, and sums over subtrees.

Every conv_id c is rebuilt: the first h = crc32(c) % 9 turns of conversation
c - c % 5, then c's own turns after its first h.  A prefix of d rebuilt turns is
named by a 128-bit digest, the running xor of the digests of (place, role, text),
computed by segments so that one conversation may have any number of turns.  The
node table is the distinct digests with their members counted, grouped with the
place, the parent's digest and a third hash of the last turn, so that texts
that agree in a digest only are not taken for one node.

Subtree sums are taken in numpy, over shards that hold whole subtrees.  A node is
heavy if its subtree has more than one shard's share of all prefix rows; a light
node whose parent is heavy is the root of a subtree that goes to one shard, dealt by the root's digest.
Within a shard a minimal perfect hash gives each
digest a slot (levels of one-hit cells; a slot is verified by the digest stored in
it), counts are scattered into flat arrays by slot, parents' slots are looked up,
and the arrays are accumulated from the deepest nodes to the roots.  The heavy
nodes, at most one for each shard and depth, are the last shard, with the sums of
the subtrees below them added first.

The members that end at a node are hashed in a stream of sorted ids, never held
in one row.

Defined cases: turns are ordered by (turn, null first, role, text), so ties and
repeated rows are turns of their own, in that order; a null role or text is empty; rows
without conv_id belong to no conversation; a negative c has the remainder's sign
(c - c % 5 is nearer to zero); an empty table has no conversation and no node,
not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import mix
from gavel.operators.segments import running
from gavel.sources.scratch import Scratch

HOSTS, HEADS = 5, 9
SHARD_ROWS = 200_000
_HEAVY, _NO_ENDS = -1, hashlib.sha256(b"").hexdigest()
_GAMMA = 1.5


# ------------------------------------------------------------------ rebuilding

def _long(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, -10).cast("long")


def turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv, own place from 1, bytes of the text, and the turn's digests t1, t2 (128 bits) and t3 (another 64)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (conversations.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text")))
    digest = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))
    rows = running(rows, ["conv"], ["turn", "role", "text"], position="place", scratch=scratch).withColumn("digest", digest)
    return rows.select("conv", "place", F.octet_length("text").cast("long").alias("size"), _long(F.substr("digest", F.lit(1), F.lit(16))).alias("t1"),
                       _long(F.substr("digest", F.lit(17), F.lit(16))).alias("t2"), F.xxhash64("role", "text").alias("t3"))


def rebuilt(own: DataFrame) -> DataFrame:
    """conv, depth from 1, size, t1, t2 and t3 of the rebuilt turns."""
    head = F.crc32(F.col("conv").cast("string")) % HEADS
    convs = own.groupBy("conv").agg(F.max("place").alias("n")).withColumn("head", head).withColumn("host", F.col("conv") - F.col("conv") % HOSTS)
    hosts = own.where(F.col("place") < HEADS)
    borrowed = convs.alias("c").join(hosts.alias("h"), (F.col("c.host") == F.col("h.conv")) & (F.col("h.place") <= F.col("c.head"))).select(
        F.col("c.conv").alias("conv"), F.col("h.place").alias("depth"), "size", "t1", "t2", "t3")
    lengths = convs.select(F.col("conv").alias("host"), F.col("n").alias("host_n"))
    start = (convs.join(lengths, "host", "left")
             .select("conv", "head", (F.least(F.coalesce("host_n", F.lit(0)), "head") - F.col("head")).alias("shift")))
    after = own.join(start, "conv").where(F.col("place") > F.col("head")).select(
        "conv", (F.col("place") + F.col("shift")).alias("depth"), "size", "t1", "t2", "t3")
    return borrowed.unionByName(after)


def prefixes(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv, length) and their prefixes of one turn or more: conv, depth, size and t3 of the last turn,
    the prefix's digest d1, d2 and its parent's p1, p2."""
    own = scratch.keep(turns(conversations, scratch), "turns")
    rows = rebuilt(own)
    one, two = F.xxhash64(F.lit(1), "depth", "t1", "t2"), F.xxhash64(F.lit(2), "depth", "t2", "t1")
    rows = running(rows.withColumn("e1", one).withColumn("e2", two), ["conv"], ["depth"], xors={"d1": F.col("e1"), "d2": F.col("e2")},
                   scratch=Scratch(scratch.spark, "trie-digests"))
    rows = scratch.keep(rows.select("conv", "depth", "size", "t3", "d1", "d2", F.col("d1").bitwiseXOR(F.col("e1")).alias("p1"),
                                    F.col("d2").bitwiseXOR(F.col("e2")).alias("p2")), "prefixes")
    lengths = rows.groupBy("conv").agg(F.max("depth").alias("length"))
    convs = own.select("conv").distinct().join(lengths, "conv", "left").select("conv", F.coalesce("length", F.lit(0).cast("long")).alias("length"))
    return scratch.keep(convs, "conversations"), rows


# ----------------------------------------------------------------- slot tables

class SlotTable:
    """Minimal perfect hash of distinct pairs of 64-bit digests, to slots 0..n-1, verified by the pairs it stores.

    Level by level the pairs fall into cells; those alone in a cell keep it, the
    others go on to the next level.  A slot is the number of kept cells before.
    """

    def __init__(self, one: np.ndarray, two: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []  # slots before the level, and per cell its rank within the level or -1
        left, done = np.arange(len(one)), 0
        slots = np.empty(len(one), np.int64)
        while len(left):
            size = max(1, int(_GAMMA * len(left)))
            cell = self._cells(one[left], two[left], len(self.levels), size)
            alone = np.bincount(cell, minlength=size) == 1
            rank = np.where(alone, np.cumsum(alone) - 1, -1)
            kept = alone[cell]
            slots[left[kept]] = done + rank[cell[kept]]
            self.levels.append((done, rank))
            done, left = done + int(alone.sum()), left[~kept]
        self.one, self.two = np.empty_like(one), np.empty_like(two)
        self.one[slots], self.two[slots] = one, two
        self.slots = slots

    @staticmethod
    def _cells(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
        return (mix((one.astype(np.uint64) ^ seed) + mix(two.astype(np.uint64) + seed)) % np.uint64(size)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Slots of the pairs; -1 where the table holds no such pair."""
        out = np.full(len(one), -1, np.int64)
        left = np.arange(len(one))
        for level, (before, rank) in enumerate(self.levels):
            got = rank[self._cells(one[left], two[left], level, len(rank))]
            out[left[got >= 0]] = before + got[got >= 0]
            left = left[got < 0]
        known = out >= 0
        known[known] = (self.one[out[known]] == one[known]) & (self.two[out[known]] == two[known])
        return np.where(known, out, -1)


def subtree_sums(nodes: pd.DataFrame) -> pd.DataFrame:
    """``nodes`` of whole subtrees (d1, d2, p1, p2, conv, depth, n_convs, size, and children, leaves and saved from below) with
    parent_conv_id, n_children, n_leaves and saved_tokens."""
    table = SlotTable(nodes["d1"].to_numpy(np.int64), nodes["d2"].to_numpy(np.int64))

    def by_slot(column):
        flat = np.empty(len(nodes), np.int64)
        flat[table.slots] = nodes[column].to_numpy(np.int64)
        return flat
    conv, depth, convs, size, children, leaves, saved = map(by_slot, ("conv", "depth", "n_convs", "size", "children", "leaves", "saved"))
    parent = table.find(by_slot("p1"), by_slot("p2"))
    inner = (parent >= 0) & (depth > 0)
    children += np.bincount(parent[inner], minlength=len(nodes))
    leaves[children == 0] = 1
    saved += (convs - 1) * size
    order = np.argsort(-depth, kind="stable")
    bounds = np.append(np.flatnonzero(np.append(True, np.diff(depth[order]) != 0)), len(order)) if len(order) else np.zeros(1, int)
    for i, j in zip(bounds[:-1], bounds[1:]):  # one depth after the other, the deepest first
        here = order[i:j][inner[order[i:j]]]
        np.add.at(leaves, parent[here], leaves[here])
        np.add.at(saved, parent[here], saved[here])
    above = pd.array(np.where(inner, conv[parent], 0), "Int64")
    above[~inner] = pd.NA
    at = table.slots
    return nodes[["d1", "d2", "p1", "p2", "conv", "depth", "n_convs"]].assign(
        parent_conv_id=above[at], n_children=children[at], n_leaves=leaves[at], saved_tokens=saved[at])


# ----------------------------------------------------------------------- Spark

_SUMS = ("d1 long, d2 long, p1 long, p2 long, conv long, depth long, n_convs long, parent_conv_id long, n_children long, "
         "n_leaves long, saved_tokens long")


def trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes: digests d1, d2, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    spark = conversations.sparkSession
    scratch = Scratch(spark, "trie")
    convs, rows = prefixes(conversations, scratch)
    nothing = F.lit(0).cast("long")
    # a prefix of a conversation of n turns has n - depth + 1 prefix rows of that conversation in its subtree
    inner = rows.join(convs, "conv").groupBy("d1", "d2", "p1", "p2", "depth", "t3").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.coalesce(F.sum("length"), nothing).alias("weight")).where("n_convs > 0")
    root = root.select(*(nothing.alias(c) for c in ("d1", "d2", "p1", "p2", "depth", "t3")), "conv", "n_convs", nothing.alias("size"), "weight")
    nodes = scratch.keep(inner.unionByName(root).withColumns({c: nothing for c in ("children", "leaves", "saved")}), "nodes")
    total = rows.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_rows))
    heavy = nodes.where((F.col("weight") > -(-total // shards)) | (F.col("depth") == 0))
    light = nodes.where((F.col("weight") <= -(-total // shards)) & (F.col("depth") > 0))

    # the shard of a conversation's light nodes: by its first prefix that isn't heavy
    key = ["d1", "d2", "depth", "t3", "p1", "p2"]
    cut = (rows.join(heavy.select(*key), key, "left_anti").groupBy("conv").agg(F.min_by(F.struct("d1", "d2"), "depth").alias("cut"))
           .select("conv", F.pmod(F.xxhash64("cut"), F.lit(shards)).alias("shard")))
    columns = ["d1", "d2", "p1", "p2", "conv", "depth", "n_convs", "size", "children", "leaves", "saved"]
    below = light.join(cut, "conv").select("shard", *columns).groupBy("shard").applyInPandas(subtree_sums, _SUMS)
    below = scratch.keep(below, "light")
    to_heavy = below.where("parent_conv_id IS NULL").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    upper = heavy.join(to_heavy, ["d1", "d2"], "left").select(
        *columns[:-3], *(F.coalesce(c, nothing).alias(name) for c, name in zip("cls", columns[-3:])))
    upper = scratch.keep(upper.groupBy(F.lit(_HEAVY).alias("shard")).applyInPandas(subtree_sums, _SUMS), "heavy")

    # parents of the light subtrees' roots are heavy
    heads = upper.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv").alias("above"))
    tops = below.where("parent_conv_id IS NULL").join(heads, ["p1", "p2"]).withColumn("parent_conv_id", F.col("above")).select(*below.columns)
    sums = upper.unionByName(below.where("parent_conv_id IS NOT NULL")).unionByName(tops)
    return (sums.join(ends(convs, rows), ["d1", "d2"], "left")
            .select("d1", "d2", F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")))


def ends(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """d1, d2 and ends_sha256 of the nodes at which conversations end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            one, two, conv = (c.to_numpy() for c in batch.columns)
            starts = np.flatnonzero(np.append(True, (np.diff(one) != 0) | (np.diff(two) != 0))) if len(one) else []
            done = []
            for i, j in zip(starts, [*starts[1:], len(one)]):
                ids = ",".join(map(str, conv[i:j].tolist())).encode()
                if node == (one[i], two[i]):
                    state.update(b"," + ids)
                else:
                    done += [(*node, state.hexdigest())] if node else []
                    node, state = (one[i], two[i]), hashlib.sha256(ids)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], names=["d1", "d2", "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=["d1", "d2", "ends_sha256"])

    last = convs.join(rows.select("conv", "depth", "d1", "d2"), "conv").where("depth = length").select("d1", "d2", "conv")
    none = convs.where("length = 0").select(F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"), "conv")
    dealt = last.unionByName(none).repartition("d1", "d2").sortWithinPartitions("d1", "d2", "conv")
    return dealt.mapInArrow(run, "d1 long, d2 long, ends_sha256 string")


def query(conversations: DataFrame) -> DataFrame:
    return trie(conversations).drop("d1", "d2")


SQL = f"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT range AS b, CASE WHEN range % 2 = 1 THEN 1 ELSE 0 END AS odd FROM range(256)),
crc AS (
  SELECT b AS byte, list_reduce(list_prepend(b::UBIGINT, range(8)::UBIGINT[]),
         lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END) AS v FROM bits),
crc_table AS (SELECT list(v ORDER BY byte) AS t FROM crc),
convs AS (
  SELECT c, n, c - c % {HOSTS} AS host,
         (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
              lambda acc, ch: xor(t[(xor(acc % 256, ch))::INTEGER + 1], acc // 256)), 4294967295::UBIGINT) % {HEADS})::BIGINT AS h
  FROM (SELECT c, count(*) AS n FROM own GROUP BY c), crc_table),
heads AS (
  SELECT k.c, k.h, least(k.h, coalesce(p.n, 0)) AS lent FROM convs k LEFT JOIN convs p ON p.c = k.host),
rebuilt AS (
  SELECT k.c, o.place AS depth, o.role, o.text FROM convs k JOIN own o ON o.c = k.host AND o.place <= k.h
  UNION ALL
  SELECT k.c, o.place - k.h + k.lent, o.role, o.text FROM heads k JOIN own o ON o.c = k.c AND o.place > k.h),
paths AS (
  SELECT c, depth, strlen(text) AS size,
         list([role, text]) OVER (PARTITION BY c ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, [] FROM convs),
lengths AS (SELECT c, max(depth) AS length FROM paths GROUP BY c),
nodes AS (
  SELECT path, min(c) AS conv_id, depth, count(*) AS n_convs, max(size) AS size,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = length), '') AS ends
  FROM paths JOIN lengths USING (c) GROUP BY path, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
up AS (
  SELECT a.path, sum((d.n_children = 0)::INTEGER)::BIGINT AS n_leaves, sum((d.n_convs - 1) * d.size)::BIGINT AS saved_tokens
  FROM linked d, range(0, d.depth + 1) AS r(up_depth) JOIN nodes a ON a.depth = up_depth AND a.path = d.path[1:up_depth]
  GROUP BY a.path)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM linked JOIN up USING (path)
"""
