"""Structured Streaming over an append-only run log.

Every ``live_*`` function maps a streaming DataFrame to a streaming DataFrame;
for the windowed ones the same function applied to a batch DataFrame is its
batch twin (Spark's ``withWatermark`` is a no-op on batch data).  All streams run
in append mode: a window, session or submission is emitted once the watermark
has passed its end, and its state is dropped, so state stays bounded; rows later
than the watermark are not counted.  ``run_to_table`` drives a stream to
completion with ``availableNow`` into Parquet under the shared
``spark.checkpoint.dir`` and reads the result back; what the last watermark has
not closed is not in it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import (DoubleType, IntegralType, LongType, StringType, StructField, StructType,
                               TimestampType)

from gavel.operators.segments import running
from gavel.session import ensure_checkpoint_dir
from gavel.sources.scratch import Scratch

RUN_LOG_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType()),
])


def read_run_log(spark: SparkSession, folder: str, file_glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Replay a folder of run-log parquet files as a stream; schema is fixed.

    ``file_glob`` picks files inside the folder (stream sources read folders).
    """
    r = spark.readStream.schema(RUN_LOG_SCHEMA).format("parquet")
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def as_run_log(df: DataFrame) -> DataFrame:
    """Log columns used below: endpoint, ts, is_error, submission key."""
    return df.select("event_id", "ts", F.col("user_id").alias("endpoint"),
                     (F.col("event_type") == "error").alias("is_error"),
                     F.get_json_object("props", "$.k").cast("long").alias("k"), "value")


# ------------------------------------------------------------------ S1
def live_verdict_rate(log: DataFrame, window: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """Verdict counts and error rate per tumbling window."""
    return (log.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_error").alias("n_error"))
            .select(F.col("w.start").alias("window_start"), "n", "n_error",
                    (F.col("n_error") / F.col("n")).alias("error_rate")))


# ------------------------------------------------------------------ S2
def live_bad_cases(log: DataFrame) -> DataFrame:
    """Rows that must go to the bad-case sink, with their date."""
    return (log.filter("is_error")
            .select("event_id", "endpoint", "k", "ts", F.date_format("ts", "yyyy-MM-dd").alias("dt")))


def start_bad_case_sink(bad: DataFrame, out_dir: str, checkpoint: str):
    """Exactly-once file sink partitioned by date."""
    return (bad.writeStream.format("json").partitionBy("dt").option("path", out_dir)
            .option("checkpointLocation", checkpoint).outputMode("append").start())


# ------------------------------------------------------------------ S3
def live_request_rate(log: DataFrame, rpm: int, watermark: str = "2 minutes") -> DataFrame:
    """Requests per endpoint in a sliding 60 s window (30 s slide); flag above ``rpm`` (S3)."""
    return (log.withWatermark("ts", watermark)
            .groupBy("endpoint", F.window("ts", "60 seconds", "30 seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("endpoint", F.col("w.start").alias("window_start"), "n", (F.col("n") > rpm).alias("over_limit")))


# ------------------------------------------------------------------ S4
BUCKETS = 1024
_NO_TIME = 2**63 - 1  # after all others


def _by_bucket(rows: DataFrame, key: str, buckets: int) -> GroupedData:
    """Rows grouped by the bucket of their key: a call to Python is for a bucket of keys, not for one key."""
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).groupBy("_bucket")


def _load(state: GroupState) -> pd.DataFrame | None:
    """The table that a bucket's state holds."""
    return pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else None


def _store(state: GroupState, table: pd.DataFrame, until: pd.Series, watermark: int) -> None:
    """Hold ``table`` until the watermark passes the least of ``until`` (milliseconds); an empty one is dropped."""
    if table.empty:
        state.remove()
        return
    batch = pa.Table.from_pandas(table, preserve_index=False).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_table(batch)
    state.update((sink.getvalue().to_pybytes(),))
    state.setTimeoutTimestamp(max(int(until.min()), watermark, 1))


def live_dedupe(log: DataFrame, keys: list[str], keep: timedelta = timedelta(days=30), watermark: str = "1 hour",
                buckets: int = BUCKETS) -> DataFrame:
    """A submission seen again within ``keep`` is ignored (S4, resume): the earliest row of each
    key's first micro-batch is emitted, and the key is remembered until the watermark is ``keep`` past it.

    Keys are dealt to ``buckets`` (fixed for the life of a checkpoint), and a bucket's
    keys are handled together; its state is a table of keys and when to forget them.
    """
    schema, keep_ms = log.schema, keep // timedelta(milliseconds=1)
    columns = log.columns

    def first(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, now = _load(state), state.getCurrentWatermarkMs()
        new = None
        if not state.hasTimedOut:
            for rows in frames:  # one frame at a time: a key may have any number of rows
                if known is not None:
                    rows = rows[~rows["_key"].isin(known["key"])]
                new = (pd.concat([x for x in (new, rows) if x is not None])
                       .sort_values(["_micros", "_order"], kind="stable").drop_duplicates("_key"))
        if known is not None:
            known = known[known["until"] >= now]
        if new is not None and len(new):
            at = new["_micros"].where(new["_micros"] != _NO_TIME, now * 1000) // 1000
            seen = pd.DataFrame({"key": new["_key"], "until": (at + keep_ms).clip(lower=now + 1)})
            known = seen if known is None or known.empty else pd.concat([known, seen])
            yield new[columns]
        if known is not None:
            _store(state, known, known["until"], now)

    # integers as text: with nulls among them pandas would make them floats
    text = StructType([StructField(f.name, StringType() if isinstance(f.dataType, IntegralType) else f.dataType) for f in schema])
    order = F.coalesce("event_id", F.lit(_NO_TIME)) if isinstance(schema["event_id"].dataType, IntegralType) else F.col("event_id")
    rows = log.withWatermark("ts", watermark).select(
        *[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, IntegralType) else f.name for f in schema],
        F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{n}") for n, k in enumerate(keys)])).alias("_key"),
        F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(_NO_TIME)).alias("_micros"),
        order.alias("_order"))
    out = _by_bucket(rows, "_key", buckets).applyInPandasWithState(
        first, text, "seen binary", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def first_seen(log: DataFrame, keys: list[str], ts_col: str = "ts") -> DataFrame:
    """Batch form of S4: the earliest row per key, as a partial aggregate (``min_by``)."""
    cols = [c for c in log.columns if c not in keys]
    agg = log.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.col(ts_col)).alias("__r"))
    return agg.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in cols])


# ------------------------------------------------------------------ S5
def live_sessions(log: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Per endpoint activity sessions, closed after ``gap`` of event time without a row."""
    return (log.withWatermark("ts", watermark)
            .groupBy("endpoint", F.session_window("ts", gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_error").alias("n_error"))
            .select("endpoint", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "n", "n_error"))


def sessions(log: DataFrame, gap: timedelta = timedelta(minutes=30), slice_length: timedelta = timedelta(hours=6)) -> DataFrame:
    """The sessions of ``live_sessions`` on batch data, for endpoints of any size.

    Two levels: sessions within (endpoint, time slice), so that an endpoint's rows
    are dealt over as many tasks as it has slices; then the last session of a slice
    is joined with the first one of the next slice if that begins within the gap, and
    chains of such sessions are numbered by segments and summed.  A slice is at least
    as long as the gap, so no session can reach beyond the neighbouring slice without having a row in it.
    """
    micros = timedelta(microseconds=1)
    if slice_length < gap:
        raise ValueError("a slice can't be shorter than the gap")
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(slice_length // micros)).cast("long")
    parts = (log.where(F.col("ts").isNotNull()).withColumn("slice", at)
             .groupBy("endpoint", "slice", F.session_window("ts", f"{gap // micros} microseconds").alias("s"))
             .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_error").alias("n_error"))
             .select("endpoint", "slice", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n", "n_error"))
    parts = Scratch(log.sparkSession, "sessions").keep(parts, "parts")
    last = parts.groupBy(F.col("endpoint").alias("e"), (F.col("slice") + 1).alias("next")).agg(F.max("session_end").alias("until"))
    first = F.unix_micros(F.col("session_start").cast("timestamp")) - F.col("slice") * F.lit(slice_length // micros) <= F.lit(gap // micros)
    joined = parts.join(last, F.col("endpoint").eqNullSafe(F.col("e")) & (F.col("slice") == F.col("next")) & first, "left")
    goes_on = F.coalesce(F.col("session_start") <= F.col("until"), F.lit(False))  # a row at the very end belongs to the session
    numbered = running(joined.select(*parts.columns, goes_on.alias("goes_on")), ["endpoint"], ["session_start"],
                       sums={"session": F.when(F.col("goes_on"), 0).otherwise(1).cast("long")})
    return numbered.groupBy("endpoint", "session").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n").alias("n"),
        F.sum("n_error").alias("n_error")).drop("session")


VERDICT_SCHEMA = "submission string, case_idx int, passed boolean, status string, message string"


def live_deadline(log: DataFrame, n_cases: int, total_timeout: timedelta, keep: timedelta = timedelta(days=1),
                  watermark: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """Deadline of a submission (S5): it closes ``total_timeout`` of event time after its first row.

    ``log`` has submission, case_idx (0 to ``n_cases`` - 1), passed and ts.  At the close one
    verdict per case is emitted: of a case's rows within the deadline the first counts, and
    a case without one fails with 'Total Timeout'; rows of no such case are left out.  Submissions are dealt to
    ``buckets`` (fixed for the life of a checkpoint), and a bucket's submissions are handled together.  Its state
    is a table with the first row of each case of an open submission, ``n_cases`` at most; a closed one is
    a single row with case -1, remembered for ``keep``, so that rows after the close are ignored.
    """
    limit, hold = total_timeout // timedelta(microseconds=1), keep // timedelta(microseconds=1)
    columns = ["submission", "case_idx", "micros", "passed"]
    by_case = columns[:2]

    def close(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, now = _load(state), state.getCurrentWatermarkMs()
        closed = opened = new = None
        if known is not None:
            closed, opened = known[known["case_idx"] < 0], known[known["case_idx"] >= 0]
        if not state.hasTimedOut:
            for rows in frames:  # one frame at a time: a submission may have any number of rows
                rows = rows[columns]
                if closed is not None:
                    rows = rows[~rows["submission"].isin(closed["submission"])]
                new = pd.concat([x for x in (new, rows) if x is not None]).sort_values(["micros", "passed"], kind="stable").drop_duplicates(by_case)
        parts = [x for x in (opened, new) if x is not None and len(x)]
        held = [] if closed is None else [closed[(closed["micros"] + limit + hold) // 1000 >= now]]
        if parts:
            rows = pd.concat(parts).sort_values("micros", kind="stable").drop_duplicates(by_case)  # on a tie the one held
            start = rows.groupby("submission", dropna=False)["micros"].transform("min")
            over = (start + limit) // 1000 + 1 < now
            held.append(rows[~over])
            if over.any():
                done = rows[over].assign(first=start[over])
                ends = done.drop_duplicates("submission")
                held.append(pd.DataFrame({"submission": ends["submission"], "case_idx": -1, "micros": ends["first"], "passed": False}))
                yield _verdicts(ends["submission"], done[done["micros"] <= done["first"] + limit], n_cases)
        held = pd.concat([x for x in held if len(x)]) if any(map(len, held)) else pd.DataFrame(columns=columns)
        if held.empty:
            state.remove()
            return
        first = held.groupby("submission", dropna=False)["micros"].transform("min")
        until = (first + limit + (held["case_idx"] < 0) * hold) // 1000 + (held["case_idx"] >= 0)
        _store(state, held.astype({"case_idx": "int32", "passed": "bool"}), until, now)

    known = F.col("case_idx").between(0, n_cases - 1) & F.col("ts").isNotNull()
    rows = log.withWatermark("ts", watermark).where(known).select(
        F.col("submission").cast("string").alias("submission"), F.col("case_idx").cast("int").alias("case_idx"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), F.coalesce("passed", F.lit(False)).alias("passed"), "ts")
    return _by_bucket(rows, "submission", buckets).applyInPandasWithState(
        close, VERDICT_SCHEMA, "open binary", "append", GroupStateTimeout.EventTimeTimeout)


def _verdicts(submissions: pd.Series, in_time: pd.DataFrame, n_cases: int) -> pd.DataFrame:
    """``n_cases`` verdicts for each of the submissions, all different."""
    place = pd.Index(submissions).get_indexer(in_time["submission"]) * n_cases + in_time["case_idx"].to_numpy()
    done = np.zeros(len(submissions) * n_cases, bool)
    passed = done.copy()
    done[place], passed[place] = True, in_time["passed"]
    return pd.DataFrame({
        "submission": np.repeat(submissions.to_numpy(), n_cases), "case_idx": np.tile(np.arange(n_cases, dtype="int32"), len(submissions)),
        "passed": passed, "status": np.where(done, "Finished", "SandboxError"), "message": np.where(done, "", "Total Timeout")})


# ------------------------------------------------------------------ driver
def stream_checkpoint(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything available now and return its result table.

    The file sink writes Parquet under the shared checkpoint folder, exactly once
    through its metadata log; nothing is collected on the driver.
    """
    spark = df.sparkSession
    base = stream_checkpoint(spark, name)
    out = f"{base}/out"
    query = (df.writeStream.option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True)
             .format("parquet").option("path", out).outputMode("append").start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(df.schema).parquet(out)
