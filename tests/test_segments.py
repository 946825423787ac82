"""Segmented running values against plain Python, with a key that holds most rows."""

import random

import pytest
from gavel.operators.segments import running
from pyspark.sql import functions as F


@pytest.mark.parametrize("segment_rows", [0, 400, 10**6])
def test_running_values(spark, segment_rows):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", "c", None]), k, rng.randrange(-50, 50), rng.randrange(2**40)) for k in range(3000)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "k string, at long, x long, y long")
    out = running(df, ["k"], ["at"], position="pos", sums={"total": F.col("x")}, xors={"mixed": F.col("y")}, segment_rows=segment_rows)
    assert out.columns == ["k", "at", "x", "y", "pos", "total", "mixed"]
    want, state = [], {}
    for k, at, x, y in rows:
        pos, total, mixed = state.get(k, (0, 0, 0))
        state[k] = pos + 1, total + x, mixed ^ y
        want.append((k, at, x, y, *state[k]))
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == want


def test_running_of_two_keys_and_none(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 1), (1, "b", 2), (2, "a", None)], "p long, q string, at int")
    got = {tuple(r) for r in running(df, ["p", "q"], ["at"], position="n", segment_rows=0).collect()}
    assert got == {(1, "a", 1, 1), (1, "a", 3, 2), (1, "b", 2, 1), (2, "a", None, 1)}
    assert running(df.limit(0), ["p"], ["at"], position="n").count() == 0
