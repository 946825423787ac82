"""Phase 6 plans: program assembly, anti-abuse rules, test reports, judge acceptance."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.operators import assembly as A
from gavel.operators import extraction as X
from gavel.operators import metrics as M
from gavel.operators import tables as TB
from gavel.plans import fixtures as V
from gavel.plans import sql_views as S
from gavel.plans.q_extraction import _ANSWERS, _answer_sql
from gavel.plans.q_prompts import _q
from gavel.plans.registry import register, with_ctes


# ------------------------------------------------------------------ E1 / E3 / E5
_PROGRAMS = """
prog AS (SELECT doc_id,
    text || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'if __name__ == "__main__":' || chr(10) || '  run()' ELSE '' END
      AS code,
    CASE doc_id % 3 WHEN 0 THEN 'prefix' || chr(10) || '#<INSERT>' || chr(10) || 'suffix'
                    WHEN 1 THEN 'a#<INSERT>b#<INSERT>c' ELSE 'assert f()' END AS test,
    list_transform(string_split(text, ' '), lambda w: 'assert ' || w) AS tests
  FROM documents)"""


def _cut_guard_sql(c: str) -> str:
    return f"(CASE WHEN strpos({c}, 'if __name__ ==') > 0 THEN left({c}, strpos({c}, 'if __name__ ==') - 1) ELSE {c} END)"


@register("append_test", with_ctes(_PROGRAMS) + f"""
SELECT doc_id,
  CASE WHEN contains(test, '#<INSERT>') THEN split_part(test, '#<INSERT>', 1) || code || split_part(test, '#<INSERT>', 2)
       ELSE {_cut_guard_sql('code')} || chr(10) || test END AS program,
  {_q(chr(10).join(A.IMPORT_PREAMBLE['python']) + chr(10))} || code AS with_imports,
  {_cut_guard_sql("'setup = 1' || chr(10) || code")} || array_to_string(list_transform(tests, lambda x: chr(10) || x || chr(10)), '')
    AS mbpp_all,
  {_cut_guard_sql("'setup = 1' || chr(10) || code")} || chr(10) || tests[-1] || chr(10) AS mbpp_fewshot
FROM prog""")
def q_append_test(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i, t = F.col("doc_id"), F.col("text")
    code = F.concat(t, F.when(i % 2 == 0, F.lit('\nif __name__ == "__main__":\n  run()')).otherwise(F.lit("")))
    test = (F.when(i % 3 == 0, F.lit("prefix\n#<INSERT>\nsuffix")).when(i % 3 == 1, F.lit("a#<INSERT>b#<INSERT>c"))
            .otherwise(F.lit("assert f()")))
    tests = F.transform(F.split(t, " "), lambda w: F.concat(F.lit("assert "), w))
    p = d.select("doc_id", code.alias("code"), test.alias("test"), tests.alias("tests"))
    return p.select("doc_id", A.append_test("code", "test").alias("program"),
                    A.with_import_preamble(F.col("code"), "python").alias("with_imports"),
                    A.mbpp_program(F.lit("setup = 1"), F.col("code"), F.col("tests")).alias("mbpp_all"),
                    A.mbpp_program(F.lit("setup = 1"), F.col("code"), F.col("tests"), fewshot=True)
                    .alias("mbpp_fewshot"))


# ------------------------------------------------------------------ B8 / E14
_HACKS = """
hack AS (SELECT doc_id,
    CASE WHEN doc_id % 5 = 0 THEN '  <?php ' ELSE '' END || text ||
    CASE doc_id % 4 WHEN 0 THEN ' exit(0)' WHEN 1 THEN ' exit( 0 )' WHEN 2 THEN ' exit(1)' ELSE '' END AS code
  FROM documents)"""


@register("antihack", with_ctes(_HACKS) + f"""
SELECT doc_id, NOT regexp_matches(code, '{TB.EXIT_RE}') AS ok_python,
  {_q(A.PY_ANTIHACK_HEADER + chr(10) + chr(10))} || code AS program_python,
  {_q(A.CPP_ANTIHACK_HEADER + chr(10) + chr(10))} || code AS program_cpp,
  CASE WHEN starts_with(ltrim(code, {S.WS}), '<?php') THEN ltrim(code, {S.WS})
       ELSE '<?php' || chr(10) || ltrim(code, {S.WS}) END AS program_php
FROM hack""")
def q_antihack(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    code = F.concat(F.when(i % 5 == 0, F.lit("  <?php ")).otherwise(F.lit("")), F.col("text"),
                    F.when(i % 4 == 0, F.lit(" exit(0)")).when(i % 4 == 1, F.lit(" exit( 0 )"))
                    .when(i % 4 == 2, F.lit(" exit(1)")).otherwise(F.lit("")))
    c = d.select("doc_id", code.alias("code"))
    return c.select("doc_id", TB.antihack_ok(F.col("code"), "python").alias("ok_python"),
                    A.antihack_program(F.col("code"), "python").alias("program_python"),
                    A.antihack_program(F.col("code"), "cpp").alias("program_cpp"),
                    A.antihack_program(F.col("code"), "php").alias("program_php"))


# ------------------------------------------------------------------ E7
@register("cruxeval_program", with_ctes(_ANSWERS) + f"""
SELECT doc_id,
  'def f(x):' || chr(10) || '    return x' || chr(10) || 'assert ' || {_answer_sql('input')} || ' == ' || 'out' AS program_input,
  'def f(x):' || chr(10) || '    return x' || chr(10) || 'assert ' || {_answer_sql('output')} || ' == f(' || 'inp' || ')'
    AS program_output
FROM ans""")
def q_cruxeval_program(spark, sf):
    from gavel.plans.q_extraction import q_answer_of
    a = q_answer_of(spark, sf)
    code = F.lit("def f(x):\n    return x")
    return a.select("doc_id", A.cruxeval_program(code, F.col("answer_input"), F.lit("out"), "input")
                    .alias("program_input"),
                    A.cruxeval_program(code, F.col("answer_output"), F.lit("inp"), "output").alias("program_output"))


# ------------------------------------------------------------------ G17 / H8
def _reports(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    words = F.split("text", " ")
    tests = F.transform(words, lambda w, k: F.struct(
        F.when((i + k) % 4 == 0, F.lit("failed")).otherwise(F.lit("passed")).alias("status"),
        F.concat(F.lit("suite "), w).alias("fullName"),
        F.array(F.lit("root"), w).alias("ancestorTitles"),
        w.alias("title"),
        F.when((i + k) % 4 == 0, F.array(F.lit("boom"))).otherwise(F.array().cast("array<string>"))
        .alias("failureMessages")))
    report = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("/t/"), i.cast("string")).alias("testFilePath"),
                                                 tests.alias("testResults"))).alias("testResults")))
    return d.select("doc_id", report.alias("report"))


_REPORT_ROWS = """
rep AS (SELECT doc_id, 0 AS suite_idx, CAST(k - 1 AS INTEGER) AS test_idx, (doc_id + k - 1) % 4 <> 0 AS passed,
           'suite ' || w[k] AS full_name, '/t/' || CAST(doc_id AS VARCHAR) AS file, 'root > ' || w[k] AS suite,
           w[k] AS test, CASE WHEN (doc_id + k - 1) % 4 = 0 THEN 1 ELSE 0 END AS n_failure_messages
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k
        FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)))"""


@register("report_cases", with_ctes(_REPORT_ROWS) + "SELECT * FROM rep")
def q_report_cases(spark, sf):
    t = A.explode_test_report(_reports(spark, sf), "report", ["doc_id"])
    return t.select("doc_id", F.col("suite_idx").cast("int").alias("suite_idx"), "test_idx", "passed", "full_name",
                    "file", "suite", "test", F.size("failure_messages").alias("n_failure_messages"))


@register("report_counts", with_ctes(_REPORT_ROWS) + "SELECT passed, count(*) AS n FROM rep GROUP BY 1")
def q_report_counts(spark, sf):
    return M.report_counts(A.explode_test_report(_reports(spark, sf), "report", ["doc_id"]))


# ------------------------------------------------------------------ G15
@register("judge_acceptance", """
WITH a AS (SELECT l_partkey AS problem_id, l_linenumber AS attempt,
             bool_or(CASE WHEN l_suppkey % 2 = 0 THEN l_returnflag <> 'R' END) AS gold_ok,
             bool_or(CASE WHEN l_suppkey % 2 = 1 THEN l_returnflag <> 'R' END) AS empty_ok
           FROM lineitem GROUP BY 1, 2)
SELECT problem_id, bool_or(coalesce(gold_ok, false) AND NOT coalesce(empty_ok, true)) AS accepted
FROM a GROUP BY 1""")
def q_judge_acceptance(spark, sf):
    li = V.table(spark, sf, "lineitem")
    ev = li.select(F.col("l_partkey").alias("problem_id"), F.col("l_linenumber").alias("attempt"),
                   F.when(F.col("l_suppkey") % 2 == 0, "gold").otherwise("empty").alias("kind"),
                   (F.col("l_returnflag") != "R").alias("accepted"))
    return A.accept_judges(ev)


# ------------------------------------------------------------------ E2
_GO = """
go AS (SELECT doc_id, 'package main' || chr(10) || 'import "fmt"' || chr(10) || 'import (' || chr(10) || '  "os"'
    || chr(10) || '  "strings"' || chr(10) || ')' || chr(10) || 'package util' || chr(10) || 'import "os"' || chr(10)
    || text AS code FROM documents)"""


@register("go_imports", with_ctes(_GO) + r"""
SELECT doc_id,
  array_to_string(list_transform(list_sort(list_distinct(regexp_extract_all(code, 'package\s+(\w+)', 1))),
                                 lambda p: 'package ' || p), chr(10)) || chr(10) || chr(10) ||
  array_to_string(list_transform(list_sort(list_distinct(list_filter(list_concat(
      regexp_extract_all(code, 'import\s+("\w+")', 1),
      flatten(list_transform(regexp_extract_all(code, '(?s)import\s+\((.*?)\)', 1),
                             lambda b: list_transform(string_split(b, chr(10)), lambda x: trim(x))))),
      lambda x: x <> ''))), lambda i: 'import ' || i), chr(10)) || chr(10) || chr(10) ||
  regexp_replace(regexp_replace(regexp_replace(code, 'package\s+(\w+)', '', 'g'), 'import\s+("\w+")', '', 'g'),
                 '(?s)import\s+\((.*?)\)', '', 'g') AS program
FROM go""")
def q_go_imports(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    code = F.concat(F.lit('package main\nimport "fmt"\nimport (\n  "os"\n  "strings"\n)\npackage util\nimport "os"\n'),
                    "text")
    return d.select("doc_id", A.go_hoist_imports(code).alias("program"))
