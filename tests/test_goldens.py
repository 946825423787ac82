"""Goldens for rows that plans rarely hold: long code, repeated keys, zero sizes, nested values, hooks that must not run."""

import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from gavel.operators import extraction as X
from gavel.operators import hooks as H
from gavel.operators import judging as J
from gavel.operators import metrics as M
from gavel.operators import prompts as P
from gavel.operators import tables as TB

LONG = "import os\ndef f(x):\n" + "    x += 1\n" * 20_000


@pytest.mark.parametrize("text", [LONG, "```python\n" + LONG + "```", "```python\n" + LONG, "text\n" + LONG + "print(1)"])
def test_twenty_thousand_lines(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    t0 = time.time()
    code = X.pick(df, "t", "python", out="w").select("w.code").first()[0]
    assert code.strip() == LONG.strip() and time.time() - t0 < 60
    assert X.extract_freeform_df(df, "t", "python").select("extracted.code").first()[0].strip() == LONG.strip()


def test_bare_python_blocks(spark):
    text = "say\nimport a\n# c\n\nfrom b import c\ndef f():\n  return 1\nend\ndef g():\nno body\nclass K:\n\tx = 1\n"
    got = spark.createDataFrame([(text,)], "t string").select(X.heuristic_blocks("t", "python")["code"]).first()[0]
    assert list(got) == ["import a\n# c\nfrom b import c\ndef f():\n  return 1\n", "class K:\n\tx = 1\n"]


def test_blocks_of_the_hook_settle(spark):
    custom = F.array(F.struct(F.lit(25).alias("priority"), F.lit("go").alias("language"), F.lit("mine").alias("code")))
    df = spark.createDataFrame([("def f():\n  return 1\n",), ("```python\nx\n```",)], "t string")
    got = [r["w"]["code"] for r in X.pick(df, "t", "python", out="w", custom=custom).collect()]
    assert got == ["mine", "x"]


def test_context_pack_with_zero_sizes(spark):
    df = spark.createDataFrame([("k", i, f"t{i}", s) for i, s in enumerate([0, 0, 0, 0, 1, 1, 0, 1, 0])] + [("z", 0, "a", 9)],
                               "key string, i int, text string, size int")
    got = {r["key"]: (r["n_snippets"], r["used"]) for r in P.context_pack(df, "key", "i", "text", "size", 2).collect()}
    assert got == {"k": (7, 2)}
    assert P.context_pack(df, "key", "i", "text", "size", 2, base_size=3).count() == 0


def test_pass_at_k_uses_every_sample(spark):
    data = [("a", "c", i < 3) for i in range(12)] + [("b", "c", True), ("b", "c", False)]
    df = spark.createDataFrame(data, "problem_id string, category string, accepted boolean")
    got = {k: v for _, k, v in rows(M.pass_at_k(df, n=None, ks=[1, 2, 3]), "category", "k", "pass_at_k")}
    assert got[1] == pytest.approx((3 / 12 + 1 / 2) / 2)
    assert got[3] == pytest.approx(1 - (9 * 8 * 7) / (12 * 11 * 10))  # only the first problem has three


def test_page_without_a_limit(spark):
    df = spark.range(25).withColumnRenamed("id", "id")
    assert TB.page(df).count() == 25 and rows(TB.page(df, offset=3, limit=2)) == [(3,), (4,)]


def test_training_records_of_a_repeated_id(spark):
    case = ("1", "2", None)
    good = ("```python\nx\n```", ("python", [case] * 5))
    df = spark.createDataFrame([(1, "p", *good, "s"), (1, "q", None, good[1], "s"), (1, "r", *good, "s")],
                               "problem_id int, prompt string, gold_standard_solution string, "
                               "info struct<language:string,test_cases:array<struct<input:string,output:string,fn_name:string>>>, source string")
    got = sorted((r["prompt"][0]["content"], list(r["solutions"])) for r in TB.training_record(df).collect())
    assert got == [("p", [good[0]]), ("q", [""]), ("r", [good[0]])]


def test_pair_lines_of_a_repeated_key(spark):
    df = spark.createDataFrame([(1, "a\nb", "a\nc"), (1, "x", "y\nz")], "id int, actual string, expected string")
    assert sorted(rows(J.pair_lines(df, "id", "actual", "expected"))) == [(1, 0, "a", "a"), (1, 0, "x", "y"), (1, 1, "b", "c")]


def test_checker_sees_mismatches_only(spark):
    @H.checker_hook
    def checker(stdin, expected, answer):
        if expected == answer or stdin == "crash":
            raise AssertionError("must not be asked")
        return answer == "b"
    df = spark.createDataFrame([("i", "a", "a", "Success"), ("i", "a", "b", "Success"), ("i", "a", "c", "Success"), ("crash", "a", "b", "Failed"),
                                ("crash", "a", "b", None)], "stdin string, expected string, stdout string, status string")
    out = J.judge_stdout(df, checker=checker)
    assert sorted(rows(out, "stdout", "passed"), key=str) == [("a", True), ("b", False), ("b", False), ("b", True), ("c", False)]


@pytest.mark.parametrize("expected,actual,same", [
    ("[1]", "[1e0]", True), ("[1]", "[true]", True), ('{"a": [1, {"b": 2.0}]}', '{"a": [1.0, {"b": 2}]}', True), ('["1"]', "[1]", False),
    ('["true"]', "[true]", False), ("[0]", "[false]", True), ("[null]", "[0]", False), ("[0.1]", "[0.10]", True), ('["a,1"]', '["a,1.0"]', False),
    ("[9007199254740993]", "[9007199254740992]", False), ("[-0.0]", "[0]", True)])
def test_nested_json_equality(spark, expected, actual, same):
    df = spark.createDataFrame([(expected, actual, "Success")], "expected string, stdout string, status string")
    assert J.judge_call(df).first()["passed"] is same


def test_math_judge_keeps_null_answers(spark):
    df = spark.createDataFrame([(1, None, "2"), (2, "2", None), (3, "2.0", "2"), (4, "+\\infty", "+infinity"), (5, ".5", "0.5"), (6, "1.05", "1.05")],
                               "id int, answer string, reference string")
    assert dict(rows(J.judge_math(df), "id", "passed")) == {1: False, 2: False, 3: True, 4: False, 5: True, 6: True}


def test_classification_truthiness(spark):
    values = ['"maybe"', "1", "true", "[0]", '""', "0", "0.0", "false", "null", "[]", "{}"]
    df = spark.createDataFrame([(i, '{"needs_special_judge": %s}' % v) for i, v in enumerate(values)], "i int, raw string")
    got = [r["needs_special_judge"] for r in X.parse_classification(df, "raw").orderBy("i").collect()]
    assert got == [True] * 4 + [False] * 7


def test_results_in_one_aggregation(spark):
    cases = spark.createDataFrame([(1, 0, True), (1, 1, False), (1, 2, True), (2, 0, True), (2, 1, True)], "submission_id int, case_idx int, passed boolean")
    subs = spark.createDataFrame([(1,), (2,), (3,)], "submission_id int")
    assert sorted(rows(J.results_of_cases(cases, subs))) == [(1, False, 2), (2, True, 2), (3, True, 0)]
    cut = J.results(J.cut_at_first_failure(cases), subs)
    assert sorted(rows(cut)) == sorted(rows(J.results_of_cases(cases, subs)))


def test_a_case_without_a_verdict_is_a_failure(spark):
    cases = spark.createDataFrame([(1, 0, None), (2, 0, True), (2, 1, None), (2, 2, True), (3, 0, True)], "submission_id int, case_idx int, passed boolean")
    subs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "submission_id int")
    want = [(1, False, 1), (2, False, 2), (3, True, 1), (4, True, 0)]
    assert sorted(rows(J.results_of_cases(cases, subs))) == want
    assert sorted(rows(J.results(J.cut_at_first_failure(cases), subs))) == want
    coded = J.error_code(cases.selectExpr("*", "'Success' AS summary"))
    assert sorted(rows(coded, "submission_id", "case_idx", "error_code")) == [(1, 0, -2), (2, 0, 0), (2, 1, -2), (2, 2, 0), (3, 0, 0)]
