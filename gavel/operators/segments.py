"""Positions and running totals within keys of any size, without a window over a large key.

Keys of at most ``SEGMENT_ROWS`` rows are windows of their own.  The rows of the
others, which are at most one key for each ``SEGMENT_ROWS`` rows, are range-partitioned by (key, order), so a key that holds a third of
all rows is cut into many segments.  Each segment is summed once; a key that
spans several segments (at most two for each partition begin or end in one)
gets the totals of its earlier segments as offsets, and the running values are a
window over (key, segment) plus the offset.

Rows with equal (key, order) are numbered in any order.  A null key is a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.sources.scratch import Scratch

SEGMENT_ROWS = 1 << 20


def running(df: DataFrame, keys: list[str], order: list[Column | str], position: str | None = None, sums: dict[str, Column] | None = None,
            xors: dict[str, Column] | None = None, scratch: Scratch | None = None, segment_rows: int | None = None) -> DataFrame:
    """``df`` plus ``position`` (from 1), running sums and running bitwise xors (all inclusive) along ``order`` within ``keys``."""
    spark = df.sparkSession
    size = SEGMENT_ROWS if segment_rows is None else segment_rows
    large = df.groupBy(*(F.col(k).alias(f"sg_key{n}") for n, k in enumerate(keys))).agg(F.count("*").alias("sg_n")).where(F.col("sg_n") > size)
    same = [F.col(k).eqNullSafe(F.col(f"sg_key{n}")) for n, k in enumerate(keys)]
    if large.isEmpty():
        return _windowed(df, keys, order, position, sums, xors)
    large = F.broadcast(large.drop("sg_n"))  # at most one row for each ``size`` rows
    return _windowed(df.join(large, same, "left_anti"), keys, order, position, sums, xors).unionByName(
        _segmented(df.join(large, same, "left_semi"), keys, order, position, sums, xors, scratch))


def _values(position, sums, xors) -> tuple[dict, dict]:
    """The columns to be folded, and by what."""
    values = ({position: F.lit(1).cast("long")} if position else {}) | dict(sums or {}) | dict(xors or {})
    return values, {name: F.bit_xor if name in (xors or {}) else F.sum for name in values}


def _windowed(df, keys, order, position, sums, xors) -> DataFrame:
    values, folds = _values(position, sums, xors)
    along = Window.partitionBy(*keys).orderBy(*(o.asc_nulls_first() if isinstance(o, Column) else F.col(o).asc_nulls_first() for o in order))
    return df.select("*", *(folds[name](value).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias(name) for name, value in values.items()))


def _segmented(df, keys, order, position, sums, xors, scratch) -> DataFrame:
    spark = df.sparkSession
    scratch = scratch or Scratch(spark, "segments")
    values, folds = _values(position, sums, xors)
    ordered = {f"sg_order{k}": o if isinstance(o, Column) else F.col(o) for k, o in enumerate(order)}
    placed = df.withColumns({f"sg_{name}": value for name, value in values.items()} | ordered)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (placed.repartitionByRange(ranges, *(F.col(k).asc_nulls_first() for k in keys), *(F.col(o).asc_nulls_first() for o in ordered))
              .withColumn("sg_segment", F.spark_partition_id()))
    placed = scratch.keep(placed, "segments")

    ends = placed.groupBy("sg_segment").agg(F.min(F.struct(*keys)).alias("low"), F.max(F.struct(*keys)).alias("high"))
    edge = ends.select(F.explode(F.array("low", "high")).alias("key")).select("key.*").distinct()
    edge = F.broadcast(edge.toDF(*(f"sg_key{n}" for n in range(len(keys)))))  # at most two rows for each range
    same = [F.col(k).eqNullSafe(F.col(f"sg_key{n}")) for n, k in enumerate(keys)]
    parts = placed.join(edge, same, "left_semi").groupBy(*keys, "sg_segment").agg(
        *(folds[name](f"sg_{name}").alias(f"sg_total_{name}") for name in values))
    before = Window.partitionBy(*keys).orderBy("sg_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*(F.col(k).alias(f"sg_key{n}") for n, k in enumerate(keys)), F.col("sg_segment").alias("sg_at"),
                           *(folds[name](f"sg_total_{name}").over(before).alias(f"sg_before_{name}") for name in values))
    offsets = F.broadcast(scratch.keep(offsets, "offsets"))  # at most two rows for each range
    inside = Window.partitionBy(*keys, "sg_segment").orderBy(*(F.col(o).asc_nulls_first() for o in ordered)).rowsBetween(
        Window.unboundedPreceding, 0)
    out = placed.withColumns({name: folds[name](f"sg_{name}").over(inside) for name in values})
    out = out.join(offsets, [F.col("sg_segment") == F.col("sg_at"), *same], "left")

    def with_offset(name):
        first = F.coalesce(F.col(f"sg_before_{name}"), F.lit(0))
        return F.col(name).bitwiseXOR(first) if name in (xors or {}) else F.col(name) + first
    return out.withColumns({name: with_offset(name) for name in values}).select(*df.columns, *values)
