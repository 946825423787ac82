"""Plans whose oracle is the row's own making: each input is built around a whole text in a known form, so the SQL
states the expected answer and shares neither pattern nor template with the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.operators import assembly as A
from gavel.operators import extraction as X
from gavel.operators import judging as J
from gavel.operators import prompts as P
from gavel.plans import fixtures as V
from gavel.plans.registry import register
from gavel.sources import readers as R

FENCE = "```"


def _docs(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", "text")


def _forms(*forms):
    """The doc_id's form among several columns."""
    i = F.col("doc_id") % len(forms)
    out = forms[-1]
    for k in range(len(forms) - 2, -1, -1):
        out = F.when(i == k, forms[k]).otherwise(out)
    return out


def _around(before: str, after: str):
    return F.concat(F.lit(before), F.col("text"), F.lit(after))


# ------------------------------------------------------------------ D19 / D20
@register("ncb_python_answers", """
SELECT doc_id, 'import pytest' || chr(10) || CASE WHEN doc_id % 5 = 3 THEN 'import x' || chr(10) ELSE '' END || text AS code FROM documents""")
def q_ncb_python(spark, sf):
    form = _forms(_around("Sure [Python]", "[/Python] done"), _around(f"see {FENCE}python\n", f"\n{FENCE} end"), _around(f"{FENCE}\n", f"\n{FENCE}"),
                  _around("so import x\n", ""), _around("[Python]", f"{FENCE} [/Python]"))
    return _docs(spark, sf).select("doc_id", X.ncb_python(form).alias("code"))


@register("ncb_java_answers", """
SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN [text, 'class B {}'] ELSE [text] END AS snippets FROM documents""")
def q_ncb_java(spark, sf):
    form = _forms(_around("[Java]", "[/Java]"), _around(f"{FENCE}java\n", f"\n{FENCE}\n{FENCE}\nclass B {{}}\n{FENCE}"), _around(f"a {FENCE}Java", FENCE))
    return _docs(spark, sf).select("doc_id", X.ncb_java_snippets(form).alias("snippets"))


# ------------------------------------------------------------------ D5 / D7
@register("freeform_v2", """
SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN text || chr(10) || '# c' ELSE text END AS code, 'fenced' AS extracted_type FROM documents""")
def q_freeform_v2(spark, sf):
    form = _forms(_around(f"{FENCE}\n{FENCE}python\n", f"\n{FENCE}"), _around(f"{FENCE}\nPython3\n", f"\n{FENCE}"),
                  _around(f"{FENCE}py\n", f"\nif __name__ == '__main__':\n    f()\n{FENCE}"), _around(f"{FENCE}python\n", f"\nassert f(1)\n# c\n{FENCE}"))
    df = _docs(spark, sf).select("doc_id", form.alias("completion"))
    out = X.extract_freeform_v2_df(df, "completion", "python", exactly_match=True, remove_asserts=True)
    return out.select("doc_id", "extracted.code", "extracted.extracted_type")


# ------------------------------------------------------------------ D18 / E6 / E9
@register("marker_programs", """
SELECT doc_id,
  CASE doc_id % 3 WHEN 0 THEN 'import t' || chr(10) || text || chr(10) || 'def solution():' || chr(10) || ' return 1' || chr(10) || chr(10) || 'run()'
                  ELSE 'import t' || chr(10) || chr(10) || 'run()' END AS palmath,
  'tb' || chr(10) || text || chr(10) || 'module m; endmodule' AS verilog,
  'import pytest' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'assert f()' AS ncb,
  CASE WHEN doc_id % 2 = 0 THEN text ELSE 'retry ' || text END || chr(10) || 'check(f)' AS mhpp
FROM documents""")
def q_marker_programs(spark, sf):
    body = "\ndef solution():\n return 1\n" + FENCE
    answer = _forms(_around(f"so {FENCE}python\n", body), _around(f"{FENCE}\n", body), _around(f"{FENCE}python\n", body.replace("()", "(x)")))
    blank = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.lit(" \n"))
    return _docs(spark, sf).select(
        "doc_id", A.marker_program(X.solution_block(answer), F.lit("import t\n#<INSERT>\nrun()"), "#<INSERT>").alias("palmath"),
        A.verilog_program(F.lit("tb"), F.col("text"), F.lit("module m; endmodule")).alias("verilog"),
        A.ncb_python_program(F.col("text"), F.lit("assert f()")).alias("ncb"),
        A.mhpp_program(blank, _around("retry ", ""), F.lit("check(f)")).alias("mhpp"))


# ------------------------------------------------------------------ E8
@register("assertion_programs", r"""
SELECT item_id,
  chr(10) || text || ' func g' || CAST(item_id AS VARCHAR) || '(a: Int, s: String) -> Bool { }' || chr(10) || chr(10) || 'let res = g'
    || CAST(item_id AS VARCHAR) || '(a: ' || CAST(item_id AS VARCHAR) || ', s: "w")' || chr(10) || 'let expected = '
    || CASE WHEN item_id % 2 = 0 THEN 'true' ELSE 'false' END || chr(10) || 'if res != expected {' || chr(10)
    || '    fatalError("Test failed: Expected \(expected), got \(res)")' || chr(10) || '} else {' || chr(10) || '    print("Test passed")'
    || chr(10) || '}' || chr(10) AS swift,
  chr(10) || text || chr(10) || 'res=$(g ' || CAST(item_id AS VARCHAR) || ' "w")' || chr(10) || 'expected='
    || CASE WHEN item_id % 2 = 0 THEN '1' ELSE '0' END || chr(10) || 'if [ "$res" != "$expected" ]; then' || chr(10)
    || '    echo "Test failed, res: $res, expected: $expected" 1>&2' || chr(10) || '    exit 1' || chr(10) || 'fi' || chr(10) AS bash,
  chr(10) || text || chr(10) || 'res = g(*[' || CAST(item_id AS VARCHAR) || ', ''w''])' || chr(10) || 'assert res == ['
    || CASE WHEN item_id % 2 = 0 THEN 'True' ELSE 'False' END || '][0]' || chr(10) AS python
FROM benchmark""")
def q_assertion_programs(spark, sf):
    b = V.table(spark, sf, "benchmark").select("item_id", "text")
    name = F.concat(F.lit("g"), F.col("item_id").cast("string"))
    b = b.select("item_id", "text", name.alias("name"),
                 F.parse_json(F.concat(F.lit("["), F.col("item_id").cast("string"), F.lit(', "w"]'))).alias("inputs"),
                 F.parse_json(F.when(F.col("item_id") % 2 == 0, "[true]").otherwise("[false]")).alias("output"))
    swift = F.concat(F.col("text"), F.lit(" func "), F.col("name"), F.lit("(a: Int, s: String) -> Bool { }"))
    return b.select("item_id", A.function_assertion(swift, "name", "inputs", "output", "swift").alias("swift"),
                    A.function_assertion("text", F.lit("g"), "inputs", "output", "bash").alias("bash"),
                    A.function_assertion("text", F.lit("g"), "inputs", "output", "python").alias("python"))


# ------------------------------------------------------------------ G5 / G7 / G8
@register("call_verdicts", """
SELECT doc_id, doc_id % 5 <> 4 AS exit_passed, doc_id % 5 IN (0, 1, 2) AS call_passed FROM documents""")
def q_call_verdicts(spark, sf):
    words = F.to_json(F.split("text", " "))
    n = F.col("doc_id").cast("string")
    value = lambda k: F.concat(F.lit('{"words": '), words, F.lit(', "n": ['), k, F.lit(", true]}"))
    actual = _forms(value(n), value(F.concat(n, F.lit(".0"))), value(n), value(F.concat(n, F.lit("1"))), value(n))
    expected = F.when(F.col("doc_id") % 5 == 2, F.concat(F.lit("["), value(n), F.lit("]"))).otherwise(value(n))
    runs = _docs(spark, sf).select("doc_id", actual.alias("stdout"), expected.alias("expected"),
                                   F.when(F.col("doc_id") % 5 == 4, "Failed").otherwise(J.SUCCESS).alias("status"))
    judged = J.judge_exit(runs).withColumnRenamed("passed", "exit_passed")
    return J.judge_call(judged).select("doc_id", "exit_passed", F.col("passed").alias("call_passed"))


@register("checker_verdicts", """
SELECT doc_id, doc_id % 3 <> 2 AS passed FROM documents""")
def q_checker_verdicts(spark, sf):
    """Texts reversed word by word count as right; the checker fails on rows it must not see."""
    from gavel.operators.hooks import checker_hook

    def reversed_words(stdin: str, expected: str, answer: str) -> bool:
        if stdin != "ask":
            raise ValueError("asked about a matching row")
        return answer == "answer " + " ".join(reversed(expected.split(" ")))

    backwards = F.concat(F.lit("answer "), F.array_join(F.reverse(F.split("text", " ")), " "))
    runs = _docs(spark, sf).select("doc_id", F.col("text").alias("expected"), F.lit(J.SUCCESS).alias("status"),
                                   _forms(F.col("text"), backwards, _around("wrong ", "")).alias("stdout"),
                                   F.when(F.col("doc_id") % 3 == 0, "match").otherwise("ask").alias("stdin"))
    return J.judge_stdout(runs, checker=checker_hook(reversed_words)).select("doc_id", "passed")


# ------------------------------------------------------------------ F8 / F13 / F14
@register("fewshot_prompts", """
SELECT doc_id,
  'SHOTS' || chr(10) || text || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0
    THEN '### Format: Read the inputs from stdin solve the problem and write the answer to stdout (do not directly test on the sample inputs). Enclose your code within delimiters as follows.'
         || chr(10) || '```python' || chr(10) || '```'
    ELSE '### Format: You will use the following starter code to write the solution to the problem and enclose your code within delimiters.'
         || chr(10) || '```python' || chr(10) || 'def f():' || chr(10) || '```' END
    || chr(10) || chr(10) || '### Answer: (use the provided format with backticks)' || chr(10) AS contest,
  '问题:' || chr(10) || 'q' || chr(10) || '答案:' || chr(10) || 'a' || chr(10) || '---' || chr(10) || '问题:' || chr(10) || text || chr(10)
    || '答案:' || chr(10) AS labelled
FROM documents""")
def q_fewshot_prompts(spark, sf):
    starter = F.when(F.col("doc_id") % 2 == 0, "# YOUR CODE HERE").otherwise("def f():")
    zero = F.concat(F.lit("### Question:\n"), F.col("text"), F.lit("\n\n### Format: see below\n```python\n"), starter, F.lit("\n```\n\n### Answer"))
    return _docs(spark, sf).select("doc_id", P.lcb_fewshot_prompt(zero, "SHOTS\n").alias("contest"),
                                   P.fewshot_prompt([("q", "a")], "text").alias("labelled"))


@register("judge_prompts", """
SELECT doc_id, '<problem_that_require_special_judging>' || chr(10)
  || CASE WHEN length(t) > 12000 THEN left(t, 12000) || '...[TRUNCATED]' || chr(10) || right(t, 1000) ELSE t END
  || chr(10) || '</problem_that_require_special_judging>' || chr(10) || chr(10)
  || 'Now, write the python code for judging the correctness of the answer output.' || chr(10) AS prompt
FROM (SELECT doc_id, 'x' || text || 'x' AS t FROM documents)""")
def q_judge_prompts(spark, sf):
    return _docs(spark, sf).select("doc_id", P.judge_program_prompt(_around("  x", "x\n")).alias("prompt"))


# ------------------------------------------------------------------ F7 / E7
def _crux_leads() -> str:
    """The instruction and the shots of each mode and form, up to the row's own part."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    cases = (f"WHEN mode = '{m}' AND form = '{f}' THEN {quoted(P.CRUX_WRAP[0] + chr(10) + P._crux_lead(m, f))}"
             for m in ("input", "output") for f in ("direct", "reasoning"))
    return "CASE " + " ".join(cases) + " END"


@register("cruxeval_prompt", f"""
SELECT doc_id, mode, form, {_crux_leads()} || text || chr(10) || CASE mode WHEN 'input' THEN 'assert f(??) == ' || doc_id ELSE 'assert f(' || doc_id || ') == ??' END
    || chr(10) || '[/PYTHON]' || chr(10) || CASE form WHEN 'direct' THEN '[ANSWER]' ELSE '[THOUGHT]' END || chr(10) || chr(10) || 'Response:' || chr(10) AS prompt
FROM documents, (SELECT unnest(['input', 'output']) AS mode), (SELECT unnest(['direct', 'reasoning']) AS form)""")
def q_cruxeval_prompt(spark, sf):
    n = F.col("doc_id").cast("string")
    rows = _docs(spark, sf).select("doc_id", F.col("text").alias("code"), n.alias("input"), n.alias("output"))
    both = (P.crux_prompts(rows, wrap=True).withColumn("form", F.lit("direct"))
            .unionByName(P.crux_prompts(rows, reasoning=True, wrap=True).withColumn("form", F.lit("reasoning"))))
    return both.select("doc_id", "mode", "form", "prompt")


@register("cruxeval_x_program", """
SELECT doc_id, text || chr(10) || 'assert(candidate(' || doc_id || ') == 1)' AS input_program, text || chr(10) || 'assert(f(1) == ' || doc_id || ')' AS output_program
FROM documents""")
def q_cruxeval_x_program(spark, sf):
    n = F.col("doc_id").cast("string")
    answer = _forms(n, F.concat(F.lit("candidate("), n, F.lit(")")))
    code = F.concat(F.col("text"), F.lit("\n"))
    return _docs(spark, sf).select(
        "doc_id", A.cruxeval_x_program(code, answer, F.lit("assert(candidate(????) == 1)"), F.lit("cpp"), "input").alias("input_program"),
        A.cruxeval_x_program(code, n, F.lit("assert(f(1) == ????)"), F.lit("cpp"), "output").alias("output_program"))


# ------------------------------------------------------------------ A4
@register("read_corpus", "SELECT doc_id, text FROM documents")
def q_read_corpus(spark, sf):
    df, field = R.read_corpus(spark, f"{sf}/documents.parquet")
    return df.select("doc_id", F.col(field).alias("text"))
