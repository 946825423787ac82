"""Small operators with no driver plan of their own."""

import json

from pyspark.sql import functions as F

from gavel.operators import assembly as A
from gavel.operators import extraction as X
from gavel.operators import hooks as H
from gavel.operators import judging as J
from gavel.operators import metrics as M
from gavel.operators import prompts as P


def test_class_names_and_solution_block(spark):
    fence = "```"
    df = spark.createDataFrame([("public class Main { }", "object Solver extends App",
                                 f"{fence}python\nx=1\n{fence}\n{fence}python\ndef solution():\n    return 2\n{fence}")],
                               "j string, s string, c string")
    r = df.select(X.java_class_name(F.col("j")).alias("j"), X.scala_object_name(F.col("s")).alias("s"),
                  X.solution_block(F.col("c")).alias("c")).first()
    assert (r["j"], r["s"], r["c"]) == ("Main", "Solver", "x=1\n```\n```python\ndef solution():\n    return 2\n")
    other = spark.createDataFrame([("public final class A {", "```\ndef solution():\n 1\n```"), ("public abstract class B", "```python\ndef solution(x):\n 1\n```"),
                                   ("class C", "")], "j string, c string")
    got = [tuple(r) for r in other.select(X.java_class_name("j"), X.solution_block("c")).collect()]
    assert got == [("A", ""), ("B", ""), (None, "")]


def test_mhpp_and_marker_programs(spark):
    df = spark.createDataFrame([("  ", "def f(): pass", "assert f() is None", "X = 1\n#CODE#\nrun()")],
                               "a string, b string, t string, m string")
    r = df.select(A.mhpp_program("a", "b", "t").alias("p"), A.marker_program(F.col("b"), F.col("m"), "#CODE#")
                  .alias("q")).first()
    assert r["p"] == "def f(): pass\nassert f() is None" and r["q"] == "X = 1\ndef f(): pass\nrun()"
    r = df.select(A.marker_program("b", "t", "#CODE#"), A.verilog_program("t", "m", "b"), A.ncb_python_program("b", "t")).first()
    assert tuple(r) == ("assert f() is None", "assert f() is None\nX = 1\n#CODE#\nrun()\ndef f(): pass",
                        "import pytest\n\ndef f(): pass\n\nassert f() is None")


def test_contest_cases_public_then_private(spark):
    df = spark.createDataFrame([([("1 2", "3")], [("[1]\n2", "[3]")])],
                               "pub array<struct<input string, output string>>, "
                               "priv array<struct<input string, output string>>")
    stdin = df.select(A.contest_cases(F.col("pub"), F.col("priv"), False).alias("c")).first()["c"]
    assert list(stdin["input"]) == ["1 2", "[1]\n2"]
    call = df.limit(1).select(A.contest_cases(F.array(), F.col("priv"), True).alias("c")).first()["c"]
    assert [json.loads(v.toJson()) for v in call["input"][0]] == [[1], 2]


def test_fewshot_prompt_and_exit_judge(spark):
    df = spark.createDataFrame([("Q?", "Success"), ("R?", "Failed")], "q string, status string")
    r = df.select(P.fewshot_prompt([("E1", "A1"), ("E2", "A2")], F.col("q")).alias("p")).first()["p"]
    assert r == "问题:\nE1\n答案:\nA1\n---\n问题:\nE2\n答案:\nA2\n---\n问题:\nQ?\n答案:\n"
    assert [x["passed"] for x in J.judge_exit(df).orderBy("q").collect()] == [True, False]


def test_metric_and_dataset_registries(spark):
    @H.register_metric("acc")
    def acc(results):
        return M.pass_at_1(results)
    assert "acc" in H.METRICS
    H.register_dataset(H.DatasetProfile("humaneval_python", match=lambda d: d.startswith("humaneval_")))
    assert H.dataset_for("humaneval_cpp").name == "humaneval_python" and H.dataset_for("nope") is None


def test_function_assertion_programs(spark):
    df = spark.createDataFrame([("def add(a, b):\n    return a + b", "add", '[1, "x", true, null]', '[3]'),
                                ("class Solution:\n    def f(self, s): return s", "f", '["it\'s"]', '["ok"]')],
                               "fn string, name string, i string, o string")
    d = df.select("fn", "name", F.parse_json("i").alias("i"), F.parse_json("o").alias("o"))
    py = [r["p"] for r in d.select(A.function_assertion(F.col("fn"), F.col("name"), F.col("i"), F.col("o"),
                                                        "python").alias("p")).collect()]
    assert py[0] == "\ndef add(a, b):\n    return a + b\nres = add(*[1, 'x', True, None])\nassert res == [3][0]\n"
    assert py[1].startswith(A.PY_SOLUTION_HEADER) and "res = sol.f(*[\"it's\"])" in py[1]
    js = d.limit(1).select(A.function_assertion(F.col("fn"), F.col("name"), F.col("i"), F.col("o"), "nodejs")
                           .alias("p")).first()["p"]
    assert "const res = add(1, \"x\", True, None);\nconst expected = 3;" in js
    sw = spark.createDataFrame([("func g(a: Int, s: String) -> Bool { }", "g", '[2, "y"]', "[true]"), ("func h(x: Int) { }", "h", "[5]", "7")],
                               "fn string, name string, i string, o string")
    got = [r["p"] for r in sw.select(A.function_assertion("fn", "name", F.parse_json("i"), F.parse_json("o"), "swift").alias("p")).collect()]
    assert "let res = g(a: 2, s: \"y\")\nlet expected = true\n" in got[0] and "let res = h(5)\nlet expected = 7\n" in got[1]
    b = spark.createDataFrame([("f() { echo 1; }", "f", "[2, \"y\"]", "[true]")], "fn string, name string, i string, o string")
    bash = b.select(A.function_assertion(F.col("fn"), F.col("name"), F.parse_json("i"), F.parse_json("o"), "bash")
                    .alias("p")).first()["p"]
    assert 'res=$(f 2 "y")\nexpected=1\n' in bash
