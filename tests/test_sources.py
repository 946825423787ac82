"""Readers and sinks on small files written to a scratch folder."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gavel.operators import judging as J
from gavel.sources import readers as R
from gavel.sources import sinks as W


def _scratch():
    return tempfile.mkdtemp(prefix="gavel-src-")


def test_problem_tables_from_jsonl_folder(spark):
    d = _scratch()
    rows = [{"id": 1, "content": "add", "labels": {"difficulty": "easy"}, "test": [{"input": "1 2"}]},
            {"id": 2, "content": "sub", "labels": {"difficulty": "hard"}, "test": []}]
    with open(os.path.join(d, "code_eval_demo.jsonl"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    schema = StructType([StructField("id", LongType()), StructField("content", StringType()),
                         StructField("labels", StringType()), StructField("test", StringType())])
    tables = R.read_problem_tables(spark, d, {"code_eval_demo": schema})
    got = {r["id"]: r for r in tables["code_eval_demo"].collect()}
    with pytest.raises(ValueError):
        R.read_problem_tables(spark, d, {})
    assert json.loads(got[1]["labels"]) == {"difficulty": "easy"} and json.loads(got[2]["test"]) == []


def test_read_corpus_dispatch_and_text_field(spark):
    d = _scratch()
    p = os.path.join(d, "c.jsonl")
    with open(p, "w") as f:
        f.write("\n".join(json.dumps({"problem_id": i, "question": f"q{i}"}) for i in range(5)))
    schema = StructType([StructField("problem_id", LongType()), StructField("question", StringType())])
    df, field = R.read_corpus(spark, p, max_items=3, schema=schema)
    assert field == "question" and df.count() == 3
    for bad in (os.path.join(d, "c.csv"), p):  # no such suffix; JSON without a schema
        with pytest.raises(ValueError):
            R.read_corpus(spark, bad)


def test_cache_requires_every_column(spark):
    df = spark.createDataFrame([(1, "a")], "id long, content string")
    assert R.cache_tables(df, ["id"]).columns == ["id"]
    with pytest.raises(ValueError):
        R.cache_tables(df, ["id", "labels"])


def test_result_and_bad_case_sinks(spark):
    d = _scratch()
    runs = spark.createDataFrame([(1, "SandboxError"), (1, "Success"), (2, "Success")],
                                 "submission_id long, status string")
    subs = spark.createDataFrame([(1, "2024-01-02"), (2, "2024-01-03")], "submission_id long, dt string")
    bad = J.bad_cases(runs, subs)
    W.write_bad_cases(bad, os.path.join(d, "bad"))
    assert sorted(os.listdir(os.path.join(d, "bad")))[-1] == "dt=2024-01-02"
    W.write_results(runs, os.path.join(d, "res"), "parquet")
    assert spark.read.parquet(os.path.join(d, "res")).count() == 3
    W.write_results(runs.withColumn("x", F.lit(1)), os.path.join(d, "resj"), "json")
    assert spark.read.json(os.path.join(d, "resj")).count() == 3
