"""Two-level sessions against Spark's session windows, with an endpoint that holds most rows."""

import random
from datetime import datetime, timedelta

import pytest
from gavel.operators import segments
from gavel.streaming import live as L


@pytest.mark.parametrize("segment_rows", [1 << 20, 20])
def test_sessions_of_a_hot_endpoint(spark, monkeypatch, segment_rows):
    monkeypatch.setattr(segments, "SEGMENT_ROWS", segment_rows)
    rng, start, rows = random.Random(3), datetime(2024, 1, 1), []
    for endpoint, n, step in ((1, 2500, 700), (2, 300, 4000), (3, 40, 1800), (None, 30, 1500)):
        at = start
        for k in range(n):
            at += timedelta(seconds=rng.choice([1, step, 1799, 1800, 1801, 20_000 if rng.random() < 0.05 else 30]))
            rows.append((endpoint, at, rng.random() < 0.2))
    rows += [(4, start, True), (4, start, False), (5, None, True)]
    log = spark.createDataFrame(rng.sample(rows, len(rows)), "endpoint long, ts timestamp, is_error boolean")
    columns = ["endpoint", "session_start", "session_end", "n", "n_error"]
    want = sorted(map(tuple, L.live_sessions(log).select(columns).collect()), key=str)
    assert sorted(map(tuple, L.sessions(log).select(columns).collect()), key=str) == want
    short = L.sessions(log, slice_length=timedelta(minutes=30))
    assert sorted(map(tuple, short.select(columns).collect()), key=str) == want


def test_a_slice_is_not_shorter_than_the_gap(spark):
    log = spark.createDataFrame([], "endpoint long, ts timestamp, is_error boolean")
    assert L.sessions(log).count() == 0
    with pytest.raises(ValueError):
        L.sessions(log, slice_length=timedelta(minutes=1))
