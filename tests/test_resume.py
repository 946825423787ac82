"""A sampler that dies between writing and committing a batch."""

import pytest
from gavel.operators import metrics as M
from gavel.operators.resume import ResultStore
from pyspark.sql import functions as F


def test_a_job_that_dies_repeats_and_loses_nothing(spark, tmp_path, monkeypatch):
    problems = spark.createDataFrame([(k,) for k in range(10)], "id int")
    store = ResultStore(spark, str(tmp_path))
    assert store.latest() is None and store.pending(problems).count() == 10 and store.results(problems).where("size(sample) = 0").count() == 10

    def batch(ids, name):
        return spark.createDataFrame([(i, [f"{name}{i}"]) for i in ids], "id int, sample array<string>")
    assert store.commit("a", batch(range(4), "a"))
    enter = ResultStore._enter
    monkeypatch.setattr(ResultStore, "_enter", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        store.commit("b", batch(range(4, 7), "lost"))
    monkeypatch.setattr(ResultStore, "_enter", enter)

    again = ResultStore(spark, str(tmp_path))
    assert sorted(r[0] for r in again.pending(problems).collect()) == [4, 5, 6, 7, 8, 9]
    assert not again.commit("a", batch(range(4), "twice"))
    assert again.commit("b", batch(range(4, 7), "b"))
    again._enter([("b", 99, "nowhere")])  # entered twice
    assert again.commit("c", batch([0], "c").unionByName(batch([1], "").select("id", F.array().cast("array<string>").alias("sample"))))
    got = {r["id"]: r["sample"] for r in again.results(problems).collect()}
    assert got == {0: ["c0"], **{k: [f"a{k}"] for k in (1, 2, 3)}, **{k: [f"b{k}"] for k in (4, 5, 6)}, 7: [], 8: [], 9: []}


def test_counts_of_the_pass_that_writes(spark, tmp_path):
    df = spark.range(100)
    counts = M.write_counted(df, F.col("id") % 7 == 0, lambda kept: kept.write.parquet(f"{tmp_path}/kept"))
    assert {tuple(r) for r in counts.collect()} == {("before", 100), ("after", 15)}
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 15
