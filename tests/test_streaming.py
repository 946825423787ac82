"""Live operators over a replayed run log, in several micro-batches, against their batch twins."""

import glob
import os
import shutil
import tempfile
from datetime import timedelta

from pyspark.sql import functions as F

from gavel.plans import q_streaming
from gavel.streaming import live as L

from helpers import SF_MID


def _replay_dir(spark, order=(0, 1, 2, 3)):
    """The events table as 4 files of a quarter of the time each, so the stream sees several micro-batches in this order."""
    d = tempfile.mkdtemp(prefix="gavel-log-")
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = [None, *ev.agg(F.percentile_approx(t, [0.25, 0.5, 0.75])).first()[0], None]
    for k in order:
        inside = (t > cuts[k] if cuts[k] else F.lit(True)) & (t <= cuts[k + 1] if cuts[k + 1] else F.lit(True))
        ev.where(inside).coalesce(1).write.mode("append").parquet(d)
    return d


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def _stream(spark, d):
    return L.as_run_log(L.read_run_log(spark, d, "*.parquet", max_files_per_trigger=1))


def test_live_matches_batch_twins(spark):
    """In append mode: what the last watermark has closed."""
    d = _replay_dir(spark)
    batch = L.as_run_log(spark.read.parquet(d))
    last = batch.agg(F.max("ts")).first()[0]

    live = L.run_to_table(L.live_verdict_rate(_stream(spark, d)), "t_rate")
    assert _sorted(live) == _sorted(L.live_verdict_rate(batch).where(F.col("window_start") <= F.lit(last - timedelta(minutes=15))))

    live = L.run_to_table(L.live_request_rate(_stream(spark, d), 1), "t_rpm")
    assert _sorted(live) == _sorted(L.live_request_rate(batch, 1).where(F.col("window_start") <= F.lit(last - timedelta(minutes=3))))

    live = L.run_to_table(L.live_sessions(_stream(spark, d)), "t_sess")
    assert _sorted(live) == _sorted(L.live_sessions(batch).where(F.col("session_end") <= F.lit(last - timedelta(hours=1))))

    live = L.run_to_table(L.live_dedupe(_stream(spark, d), ["endpoint", "k"]), "t_dedupe")
    cols = ["endpoint", "k", "event_id", "ts"]
    assert _sorted(live.select(cols)) == _sorted(L.first_seen(batch.select(cols), ["endpoint", "k"]).select(cols))

    live = L.run_to_table(L.live_bad_cases(_stream(spark, d)), "t_bad")
    assert _sorted(live.select("event_id")) == _sorted(batch.filter("is_error").select("event_id"))


def test_late_rows_are_not_counted(spark):
    """The first quarter arrives last, later than the watermark: its windows are never emitted."""
    d = _replay_dir(spark, (1, 2, 3, 0))
    batch = L.as_run_log(spark.read.parquet(d))
    live = L.run_to_table(L.live_verdict_rate(_stream(spark, d)), "t_late")
    quarter = batch.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.25)).first()[0]
    late = live.where(F.unix_micros(F.col("window_start").cast("timestamp")) < quarter - 300_000_000)
    assert late.count() == 0 and live.count() > 0


def test_deadline_closes_submissions(spark):
    rows = [("a", 0, True, 0), ("a", 1, False, 50), ("a", 2, True, 400), ("b", 0, True, 100), ("b", 1, True, 130), ("b", 2, True, 150),
            ("z", 0, True, 90_000), ("a", 1, True, 90_001)]
    d = tempfile.mkdtemp(prefix="gavel-deadline-")
    df = spark.createDataFrame(rows, "submission string, case_idx int, passed boolean, s long").withColumn("ts", F.timestamp_seconds(F.col("s") + 1_000_000)).drop("s")
    for part in (rows[:4], rows[4:6], rows[6:]):
        keep = F.lit(False)
        for r in part:
            keep = keep | ((F.col("submission") == r[0]) & (F.unix_seconds("ts") == r[3] + 1_000_000))
        df.where(keep).coalesce(1).write.mode("append").parquet(d)
    log = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d)
    got = L.run_to_table(L.live_deadline(log, 3, timedelta(seconds=300)), "t_deadline")
    assert _sorted(got.select("submission", "case_idx", "passed", "message")) == [
        ("a", 0, True, ""), ("a", 1, False, ""), ("a", 2, False, "Total Timeout"), ("b", 0, True, ""), ("b", 1, True, ""), ("b", 2, True, "")]


def test_bad_case_sink_partitions_by_date(spark):
    d = _replay_dir(spark)
    out = tempfile.mkdtemp(prefix="gavel-bad-")
    ck = tempfile.mkdtemp(prefix="gavel-ck-")
    q = L.start_bad_case_sink(L.live_bad_cases(L.as_run_log(L.read_run_log(spark, d, "*.parquet"))), out, ck)
    q.processAllAvailable()
    q.stop()
    got = spark.read.json(out)
    assert "dt" in got.columns
    n_err = spark.read.parquet(d).filter(F.col("event_type") == "error").count()
    assert got.count() == n_err


def _batches(spark, schema, *batches):
    """A stream of these micro-batches, ts given in seconds."""
    d = tempfile.mkdtemp(prefix="gavel-batches-")
    for rows in batches:
        df = spark.createDataFrame(rows, schema.replace("ts timestamp", "ts long"))
        df.withColumn("ts", F.timestamp_seconds(F.col("ts") + 1_000_000)).coalesce(1).write.mode("append").parquet(d)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)


RUN = "event_id long, ts timestamp, endpoint long, k long"
CASE = "submission string, case_idx int, passed boolean, ts timestamp"


def _state_rows(df):
    q = df.writeStream.format("noop").trigger(availableNow=True).option("checkpointLocation", tempfile.mkdtemp(prefix="gavel-ck-")).start()
    q.awaitTermination()
    return max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"])


def test_state_is_by_buckets_of_keys(spark):
    """Python is called for a bucket of keys, not once per key."""
    runs = [(i, i, i % 600, i) for i in range(600)]
    assert 1 < _state_rows(L.live_dedupe(_batches(spark, RUN, runs), ["endpoint", "k"], buckets=16)) <= 16
    cases = [(f"s{i}", 0, True, 0) for i in range(600)]
    assert 1 < _state_rows(L.live_deadline(_batches(spark, CASE, cases), 2, timedelta(hours=1), buckets=16)) <= 16


def test_dedupe_forgets_keys_and_keeps_integers(spark):
    big, day = 2**60 + 1, 86_400
    log = _batches(spark, RUN, [(big, 50, 1, None), (big + 2, 40, 1, None), (7, 60, None, big), (9, 60, 2, 2), (8, 60, 2, 2)],
                   [(10, 100, 1, None), (11, 100, 3, 3)], [(12, 5 * day, 4, 4)], [(13, 5 * day + 1, 1, None)], [(14, 5 * day + 2, 1, None)])
    got = L.run_to_table(L.live_dedupe(log, ["endpoint", "k"], keep=timedelta(days=1), buckets=1), "t_forget")
    # the key seen again at 100 s is still forgotten a day after its first row, once the watermark's next micro-batch is done
    assert {tuple(r) for r in got.select("event_id", "endpoint", "k").collect()} == {
        (big + 2, 1, None), (7, None, big), (8, 2, 2), (11, 3, 3), (12, 4, 4), (14, 1, None)} and got.count() == 6


def test_dedupe_orders_ids_of_any_type(spark):
    log = _batches(spark, RUN.replace("event_id long", "event_id string"), [("b", 5, 1, 1), ("a", 5, 1, 1), (None, 4, 2, 2), ("c", 9, 2, 2)])
    got = L.run_to_table(L.live_dedupe(log, ["endpoint", "k"]), "t_ids")
    assert {tuple(r) for r in got.select("event_id", "endpoint").collect()} == {("a", 1), (None, 2)}


def test_dedupe_takes_rows_without_time(spark):
    rows = [(1, None, 1, "view", 0.0, '{"k": 1}'), (2, 20, 2, "view", 0.0, '{"k": 1}'), (3, None, 2, "view", 0.0, '{"k": 1}'), (4, 10, None, "view", 0.0, None)]
    log = _batches(spark, RUN, [(event, ts, user, 1) for event, ts, user, *_ in rows])
    got = L.run_to_table(L.live_dedupe(log, ["endpoint", "k"]), "t_untimed")
    assert {tuple(r) for r in got.select("event_id", "endpoint").collect()} == {(1, 1), (2, 2), (4, None)} and got.count() == 3

    d = tempfile.mkdtemp(prefix="gavel-untimed-")
    df = spark.createDataFrame(rows, "event_id long, ts long, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.timestamp_seconds("ts")).coalesce(1).write.parquet(f"{d}/out")
    os.makedirs(f"{d}/table")
    shutil.copy(glob.glob(f"{d}/out/*.parquet")[0], f"{d}/table/events.parquet")  # a stream reads a file of this name
    got = q_streaming.q_live_dedupe(spark, f"{d}/table")
    assert {tuple(r) for r in got.collect()} == {(1, 1, None, None), (2, 1, 2, "1970-01-01 00:00:20.000000"), (None, None, 4, "1970-01-01 00:00:10.000000")}


def test_deadlines_of_one_bucket(spark):
    """Open, closed and forgotten submissions side by side."""
    log = _batches(spark, CASE, [("a", 0, None, 0), ("a", 0, True, 5), ("b", 1, True, 200), (None, 1, True, 10), ("a", 5, True, 0)],
                   [("b", 0, True, 450), ("a", 1, True, 300), ("c", 0, True, 900)], [("d", 0, True, 5_000)], [("b", 0, False, 5_000), ("d", 0, False, 4_999)],
                   [("z", 0, True, 90_000)])
    got = L.run_to_table(L.live_deadline(log, 2, timedelta(seconds=300), watermark="1 minute", buckets=1), "t_bucket")
    assert {tuple(r) for r in got.select("submission", "case_idx", "passed", "message").collect()} == {
        ("a", 0, False, ""), ("a", 1, True, ""), ("b", 0, True, ""), ("b", 1, True, ""), (None, 0, False, "Total Timeout"), (None, 1, True, ""),
        ("c", 0, True, ""), ("c", 1, False, "Total Timeout"), ("d", 0, False, ""), ("d", 1, False, "Total Timeout")} and got.count() == 10
