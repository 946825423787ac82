"""Golden rows for judging, cases and metrics (shapes from the reference's tests)."""

import json

from pyspark.sql import functions as F

from gavel.operators import assembly as A
from gavel.operators import judging as J
from gavel.operators import metrics as M
from gavel.operators import tables as TB
from gavel.operators.hooks import checker_hook
from gavel.sources.readers import inline_rows

from helpers import rows


def test_stdout_judge_line_rules(spark):
    data = [(1, "3\n4", "3", "Success"),          # shorter side decides
            (2, "HELLO", "hello  ", "Success"),   # lower + strip
            (3, "1.000001", "1.0000015", "Success"),  # numeric escape
            (4, "1", "2", "Success"),
            (5, "a", "a", "Failed"),
            (6, "1e400", "inf", "Success"),       # inf - inf is nan -> not close, strings differ
            (7, "a\n\nb", "a\nzzz\nb", "Success")]
    df = spark.createDataFrame(data, "id int, expected string, stdout string, status string")
    got = dict(rows(J.judge_stdout(df), "id", "passed"))
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: False}


def test_special_judge_only_on_mismatch(spark):
    def a_plus_b(stdin, expected, answer):
        a, b = map(int, answer.split())
        return a + b == int(stdin)
    chk = checker_hook(a_plus_b)
    data = [(1, "3", "1 2", "2 1", "Success"), (2, "7", "3 4", "6 1", "Success"),
            (3, "7", "3 4", "3 5", "Success"), (4, "5", "1 4", "1 4", "Success")]
    df = spark.createDataFrame(data, "id int, stdin string, expected string, stdout string, status string")
    got = dict(rows(J.judge_stdout(df, checker=chk), "id", "passed"))
    assert got == {1: True, 2: True, 3: False, 4: True}


def test_contest_judge_rules(spark):
    data = [(1, "1 2\n3", " 1 2 \n3\n"), (2, "a\n\nb", "a\nb"), (3, "0.1000001", "0.1"),
            (4, "12", "012"), (5, "nan", "nan"), (6, "x", "y"), (7, "1\n2", "1.0\n2.0")]
    df = spark.createDataFrame([(i, e, a, "Success") for i, e, a in data],
                               "id int, expected string, stdout string, status string")
    got = dict(rows(J.judge_contest_stdout(df), "id", "passed"))
    assert got == {1: True, 2: True, 3: True, 4: False, 5: True, 6: False, 7: True}


def test_first_failure_cut_and_results(spark):
    v = spark.createDataFrame([(1, 0, True), (1, 1, False), (1, 2, False), (2, 0, True), (2, 1, True)],
                              "submission_id long, case_idx int, passed boolean")
    subs = spark.createDataFrame([(1,), (2,), (3,)], "submission_id long")
    kept = J.cut_at_first_failure(v)
    assert sorted(rows(kept, "submission_id", "case_idx")) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    res = dict((k, (a, n)) for k, a, n in rows(J.results(kept, subs)))
    assert res == {1: (False, 2), 2: (True, 2), 3: (True, 0)}


def test_total_deadline(spark):
    v = spark.createDataFrame([(1, 0, True, 0.0, 1.0), (1, 1, True, 0.0, 2.0), (1, 2, True, 0.0, None)],
                              "submission_id long, case_idx int, passed boolean, started double, finished double")
    v = v.withColumn("status", F.lit("Success")).withColumn("message", F.lit(""))
    out = sorted(rows(J.apply_deadline(v, 1.5), "case_idx", "passed", "status", "message"))
    assert out == [(0, True, "Success", ""), (1, False, "SandboxError", "Total Timeout"),
                   (2, False, "SandboxError", "Total Timeout")]


def test_json_input_case(spark):
    df = spark.createDataFrame([('[1, 2]\n3\n"s"', "15"), ("not json", "1"), ("4", "oops")], "i string, o string")
    c = df.select(TB.json_input_case(F.col("i"), F.col("o")).alias("c"))
    got = [(json.loads(r["c"]["input"].toJson()), json.loads(r["c"]["output"].toJson())) for r in c.collect()]
    assert got == [([[1, 2], 3, "s"], [15]), ("not json", "1"), ([4], "oops")]


def test_test_report_counts(spark):
    tests = [{"status": "passed" if i < 9 else "failed", "fullName": f"t{i}", "ancestorTitles": ["A", "B"],
              "title": f"t{i}", "failureMessages": [] if i < 9 else ["bad"]} for i in range(11)]
    report = json.dumps({"testResults": [{"testFilePath": "/x.test.js", "testResults": tests}]})
    df = spark.createDataFrame([(1, report)], "id int, report string")
    cases = A.explode_test_report(df, "report", ["id"])
    assert dict(rows(M.report_counts(cases), "passed", "n")) == {True: 9, False: 2}
    assert cases.filter("test_idx = 0").first()["suite"] == "A > B"


def test_inline_rows_and_pass_at_k(spark):
    df = inline_rows(spark, [{"id": "a", "content": "x"}, {"id": "b", "content": "y"}], ["id", "content"])
    assert sorted(rows(df, "content")) == [("x",), ("y",)]
    one = spark.createDataFrame([("p1", "c", True)], "problem_id string, category string, accepted boolean")
    got = rows(M.pass_at_k(one, n=1, ks=[1, 10]), "category", "k", "pass_at_k")
    assert got == [("c", 1, 1.0)]


def test_pass_at_k_matches_numpy(spark):
    import numpy as np
    n = 7
    data = [(f"p{i}", "c", j < c) for i, c in enumerate(range(0, 8)) for j in range(n)]
    df = spark.createDataFrame(data, "problem_id string, category string, accepted boolean")
    got = dict(((k, v) for _, k, v in rows(M.pass_at_k(df, n=n, ks=[1, 3, 7]))))

    def est(c, k):
        return 1.0 if n - c < k else 1.0 - float(np.prod(1.0 - k / np.arange(n - c + 1, n + 1)))
    for k in (1, 3, 7):
        assert abs(got[k] - np.mean([est(min(c, n), k) for c in range(0, 8)])) < 1e-12


def test_run_status_and_summary(spark):
    runs = spark.createDataFrame(
        [("Finished", 0, "", "Finished", 0, ""), ("Finished", 1, "", None, None, ""),
         ("Finished", 0, "", "TimeLimitExceeded", None, ""), ("Error", None, "boom", None, None, ""),
         ("Finished", 0, "", "Error", None, "lost")],
        "compile_state string, compile_return_code int, compile_stderr string, run_state string, "
        "return_code int, run_stderr string")
    out = rows(J.run_summary(J.run_status(runs), J.FULL_SUMMARY), "status", "message", "summary")
    assert out == [("Success", "", "Success"), ("Failed", "", "CompileFailed"), ("Failed", "", "RunTimeout"),
                   ("SandboxError", "boom", "Invalid"), ("SandboxError", "lost", "Invalid")]


def test_call_judge_json_rules(spark):
    data = [(1, "[1, 2]", "[1, 2]"), (2, "[[1, 2]]", "[1, 2]"), (3, "3", "3.0"), (4, '{"1": "a"}', '{"1": "a"}'),
            (5, "[3]", "4"), (6, "[]", "[]"), (7, '"x"', '["x"]'), (8, "true", "1"), (9, '"1"', "1")]
    df = spark.createDataFrame([(i, e, a, "Success") for i, e, a in data],
                               "id int, expected string, stdout string, status string")
    got = dict(rows(J.judge_call(df), "id", "passed"))
    # 8: Python compares True == 1 as equal; 9: a string is never a number
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False, 6: True, 7: False, 8: True, 9: False}


def test_math_normalize_and_equal(spark):
    cases = [("\\$1,234.50.", "1234.5", True),       # dollar, comma, closing dot, trailing zero
             ("25\\%", "25", True),                  # percent removed
             ("50", "0.5", True),                    # ref * 100
             ("x = 7", "7", True),                   # short left-hand side
             ("\\frac12", "\\frac{1}{2}", True),      # \frac12 -> \frac{1}{2}
             ("3/4", "\\frac{3}{4}", True),           # a/b -> \frac{a}{b}
             ("\\sqrt2", "\\sqrt{2}", True),
             ("[1, 2]", "[1,2]", True),              # bracket-free text
             ("(1.00, 3)", "(1, 3)", True),           # element-wise
             ("10 \\text{ miles}", "10", True),       # unit removed
             ("7", "8", False), ("", "0", False), ("abc", "abd", False)]
    df = spark.createDataFrame([(a, r) for a, r, _ in cases], "answer string, reference string")
    got = {(a, r): p for a, r, p in rows(J.judge_math(df), "answer", "reference", "passed")}
    for a, r, want in cases:
        assert got[(a, r)] == want, (a, r)


def test_humaneval_program_java_and_go(spark):
    fence = "```"
    df = spark.createDataFrame(
        [(f"{fence}java\nclass Problem {{ int f() {{ return 1; }} }}\n{fence}", "", "// tests", ["\n}"]),
         (f"{fence}go\npackage main\nimport \"fmt\"\nfunc F() {{}}\n{fence}", "", "import \"os\"", ["\nzz"])],
        "completion string, prompt string, tests string, stops array<string>")
    java = A.humaneval_program_df(df.limit(1), "completion", "prompt", "tests", "stops", "java", "stop_token")
    p = java.first()["program"]
    assert p.startswith("import java.util.*;") and "class Main" in p and "class Problem" not in p
    go = A.humaneval_program_df(df.subtract(df.limit(1)), "completion", "prompt", "tests", "stops", "go", "func")
    g = go.first()["program"]
    assert g.startswith('package main\n\nimport "fmt"\nimport "os"\n\n')


def test_line_tables_judge_as_rows(spark):
    """Random small texts: the join of line tables gives the verdicts of the row form."""
    import random
    rng = random.Random(8)
    line = lambda: rng.choice(["", " ", "a", "A ", "1.0", "1", "1.000001", "x\ty", "\u2003", "nan", "2e3", "2000"])
    texts = [(k, "\n".join(line() for _ in range(rng.randrange(4))), "\n".join(line() for _ in range(rng.randrange(4))), rng.choice(["Success", "Success", "Failed"]))
             for k in range(400)]
    runs = spark.createDataFrame(texts, "case_id int, stdout string, expected string, status string")
    tables = [runs.select("case_id", F.posexplode(F.split(c, "\n", -1)).alias("line_no", "line")) for c in ("stdout", "expected")]
    for lower in (True, False):
        want = sorted(rows(J.judge_stdout(runs, lower=lower), "case_id", "passed"))
        got = J.judge_line_tables(runs.select("case_id", "status"), *tables, lower=lower)
        assert sorted(rows(got, "case_id", "passed")) == want
    one = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "case_id int, line_no int, line string")
    other = spark.createDataFrame([(1, 0, "a"), (1, 1, "c")], "case_id int, line_no int, line string")
    case = spark.createDataFrame([(1, "Success"), (2, "Success"), (3, None)], "case_id int, status string")
    got = J.judge_line_tables(case, one, other)
    assert sorted(rows(got, "case_id", "first_mismatch", "passed")) == [(1, 2, False), (2, None, True), (3, None, False)]
