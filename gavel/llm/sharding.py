"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record is hashed into one of ``SLOTS`` virtual slots; the bytes of each slot
are aggregated, and a map says which shard a slot belongs to.  The first map
deals the slots out largest first, each to the shard with the fewest bytes so
far.  Rebalancing edits a stored version: only the slots that leave an overfull
shard, or that a new shard takes, change; all other entries stay.  Maps are
kept as ``version=N`` folders of Parquet.

The slot table has ``SLOTS`` rows whatever the input, so the dealing out is one
fold over one array.  Record positions come from the slot's first position plus
the record's rank inside its slot, so no task ever numbers a whole shard.

Defined cases: a null text has no bytes (size 8, crc 0); a null doc_id hashes
like any other value; rows are hashed by doc_id and text, so rows that share an
id spread by their texts; equal rows are numbered in either order, which gives
the same output rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gavel.llm.common import Scratch, text_key

SLOTS = 8192
SHARDS = 24
RECORD_BYTES = 8


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot ``sh_slot`` of every row."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + RECORD_BYTES).alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", text_key()), F.lit(slots)).cast("int").alias("sh_slot"))


def slot_bytes(recs: DataFrame) -> DataFrame:
    return recs.groupBy("sh_slot").agg(F.sum("size").alias("sh_bytes"), F.count("*").alias("sh_rows"))


def _lightest(load: Column) -> Column:
    return F.array_position(load, F.array_min(load)).cast("int")


def _deal(items: Column, start: Column) -> Column:
    """Fold (sh_bytes, sh_slot) items, largest first, into the lightest shard; ``start``: bytes of each shard."""
    def step(state, item):
        at = _lightest(state["load"])
        load = F.transform(state["load"], lambda v, i: F.when(i == at - 1, v + item["sh_bytes"]).otherwise(v))
        return F.struct(load.alias("load"), F.concat(state["shards"], F.array(at - 1)).alias("shards"))
    empty = F.struct(start.alias("load"), F.expr("cast(array() as array<int>)").alias("shards"))
    return F.aggregate(items, empty, step, lambda s: s["shards"])


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Slot map (sh_slot, sh_bytes, sh_rows, shard) with near equal bytes."""
    items = F.reverse(F.array_sort(F.collect_list(F.struct("sh_bytes", "sh_slot", "sh_rows"))))
    start = F.expr(f"array_repeat(0L, {shards})")
    dealt = sizes.groupBy().agg(items.alias("items")).select(
        F.explode(F.arrays_zip("items", _deal(F.col("items"), start).alias("shard"))).alias("x"))
    return dealt.select("x.items.sh_slot", "x.items.sh_bytes", "x.items.sh_rows", "x.shard")


def edit_map(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """Next version of a map for new slot sizes and at least as many shards.

    Each shard keeps its largest slots while they fit the new mean; the rest,
    and slots that the map doesn't know, are dealt to the lightest shards.
    """
    mean = sizes.agg(F.sum("sh_bytes") / shards).scalar()
    slot = sizes.join(current.select("sh_slot", F.col("shard").alias("was")), "sh_slot", "left")
    run = F.sum("sh_bytes").over(_by_size("was")).alias("run")
    slot = slot.select("*", run)
    slot = slot.withColumn("stay", F.coalesce((F.col("was") < shards) & (F.col("run") <= mean), F.lit(False)))
    entry = F.struct("sh_bytes", "sh_slot", "sh_rows")
    folded = slot.groupBy().agg(
        F.array_sort(F.collect_list(F.when(F.col("stay"), F.struct("was", "sh_bytes", "sh_slot", "sh_rows")))).alias("kept"),
        F.reverse(F.array_sort(F.collect_list(F.when(~F.col("stay"), entry)))).alias("moved"))
    load = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.aggregate(
        F.filter("kept", lambda k: k["was"] == s), F.lit(0).cast("long"), lambda a, k: a + k["sh_bytes"]))
    moved = folded.select(F.explode(F.arrays_zip("moved", _deal(F.col("moved"), load).alias("shard"))).alias("x"))
    kept = folded.select(F.explode("kept").alias("k")).select(
        "k.sh_slot", "k.sh_bytes", "k.sh_rows", F.col("k.was").alias("shard"))
    return kept.unionByName(moved.select("x.moved.sh_slot", "x.moved.sh_bytes", "x.moved.sh_rows", "x.shard"))


def _by_size(key: str):
    return (Window.partitionBy(key).orderBy(F.desc("sh_bytes"), "sh_slot")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


class ShardMap:
    """Versions of a slot map below one folder."""

    def __init__(self, spark: SparkSession):
        self.scratch, self.versions = Scratch(spark, "shards"), []

    def store(self, slot_map: DataFrame) -> DataFrame:
        self.versions.append(self.scratch.keep(slot_map.coalesce(1), f"version={len(self.versions)}"))
        return self.versions[-1]


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Every record with its shard and its gapless position there."""
    before = F.coalesce(F.sum("sh_rows").over(
        Window.partitionBy("shard").orderBy("sh_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = slot_map.select("sh_slot", "shard", before.alias("sh_start"))
    rank = F.row_number().over(Window.partitionBy("sh_slot").orderBy("doc_id", "text_crc32", "size"))
    numbered = recs.withColumn("sh_rank", rank.cast("long"))
    # the map has one row per slot: SLOTS rows of three numbers at most
    return numbered.join(F.broadcast(starts), "sh_slot").withColumn("slot", F.col("sh_start") + F.col("sh_rank") - 1)


def grown(recs: DataFrame) -> ShardMap:
    """A map for one shard less than ``SHARDS``, edited to ``SHARDS``: two stored versions."""
    maps = ShardMap(recs.sparkSession)
    sizes = maps.scratch.keep(slot_bytes(recs), "sizes")
    maps.store(edit_map(maps.store(first_map(sizes, SHARDS - 1)), sizes, SHARDS))
    return maps


def query(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for 24 shards of near equal bytes."""
    recs = records(docs)
    return place(recs, grown(recs).versions[-1]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"))
