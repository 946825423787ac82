"""Phase 3 plans: case judges over stdout pairs derived from ``documents`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.functions import text as T
from gavel.operators import judging as J
from gavel.plans import fixtures as V
from gavel.plans import sql_views as S
from gavel.plans.registry import register, with_ctes


def _t(x: str) -> str:
    return S.py_strip_sql(x)


PYFLOAT_RE = T._PY_FLOAT_RE  # same grammar in RE2


_FT = S.sql_chars(T.FLOAT_BLANKS)


def _isfloat(x: str) -> str:
    return f"coalesce(regexp_matches(trim({x}, {_FT}), '{PYFLOAT_RE}'), false)"


def _float(x: str) -> str:
    return f"TRY_CAST(replace(trim({x}, {_FT}), '_', '') AS DOUBLE)"


def _g3_sql(src: str, key_cols: str) -> str:
    a, e = "a[i]", "e[i]"
    la, le = f"lower({a})", f"lower({e})"
    match = (f"({_t(la)} = {_t(le)} OR ({_isfloat(le)} AND {_isfloat(la)} AND "
             f"abs({_float(la)} - {_float(le)}) / greatest(abs({_float(le)}), 1e-10) < 1e-5))")
    return f"""
SELECT {key_cols}, status = 'Success' AND coalesce(list_bool_and(
         list_transform(range(1, least(len(a), len(e)) + 1), lambda i: {match})), true) AS passed
FROM (SELECT {key_cols}, status, string_split({_t('actual')}, chr(10)) AS a, string_split({_t('expected')}, chr(10)) AS e
      FROM {src})"""


NUM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


# ------------------------------------------------------------------ G3 / G4
@register("judge_stdout", with_ctes(S.STDOUT_PAIRS) + _g3_sql("pairs", "case_id"))
def q_judge_stdout(spark, sf):
    p = V.stdout_pairs(spark, sf)
    return J.judge_stdout(p, actual_col="actual", expected_col="expected").select("case_id", "passed")


@register("judge_line_tables", with_ctes(S.STDOUT_PAIRS) + _g3_sql("pairs", "case_id"))
def q_judge_line_tables(spark, sf):
    p = V.stdout_pairs(spark, sf)
    lines = lambda c: p.select("case_id", F.posexplode(F.split(c, "\n", -1)).alias("line_no", "line"))
    return J.judge_line_tables(p.select("case_id", "status"), lines("actual"), lines("expected")).select("case_id", "passed")


@register("judge_stdout_numeric", with_ctes(S.NUMERIC_PAIRS) + _g3_sql("npairs", ", ".join(NUM_KEYS)))
def q_judge_stdout_numeric(spark, sf):
    p = V.numeric_pairs(spark, sf)
    return J.judge_stdout(p, actual_col="actual", expected_col="expected").select(*NUM_KEYS, "passed")


# ------------------------------------------------------------------ G6
_SPLITLINES_RE = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def _splitlines(x: str) -> str:
    parts = f"regexp_split_to_array({x}, '{_SPLITLINES_RE}')"
    return (f"(CASE WHEN {x} = '' THEN CAST([] AS VARCHAR[]) WHEN {parts}[-1] = '' "
            f"THEN {parts}[1:len({parts}) - 1] ELSE {parts} END)")


def _g6_sql(src: str, key_cols: str) -> str:
    allclose = (f"(list_bool_and(list_transform(o_ne, lambda x: {_isfloat('x')})) AND "
                f"list_bool_and(list_transform(ex, lambda x: {_isfloat('x')})) AND len(o_ne) = len(ex) AND "
                f"coalesce(list_bool_and(list_transform(range(1, len(o_ne) + 1), lambda i: "
                f"({_float('o_ne[i]')} = {_float('ex[i]')} AND NOT isnan({_float('o_ne[i]')})) OR "
                f"abs({_float('o_ne[i]')} - {_float('ex[i]')}) <= 1e-8 + 1e-5 * abs({_float('ex[i]')}))), true))")
    all_ints = ("coalesce(list_bool_and(list_transform(range(1, least(len(o_ne), len(ex)) + 1), lambda i: "
                "regexp_matches(o_ne[i], '^[0-9]+$') AND regexp_matches(ex[i], '^[0-9]+$'))), true)")
    return f"""
SELECT {key_cols}, coalesce(status = 'Success' AND (
    {_t("array_to_string(o, chr(10))")} = {_t('expected')}
    OR {_t(f"array_to_string(list_transform(o, lambda x: {_t('x')}), chr(10))")} = {_t('expected')}
    OR o = [expected] OR o = ex OR o_ne = ex
    OR (NOT {all_ints} AND {allclose})), false) AS passed
FROM (SELECT *, list_filter(o, lambda x: length(x) > 0) AS o_ne
      FROM (SELECT {key_cols}, status, expected, {_splitlines('actual')} AS o,
                   list_transform(list_filter(string_split(expected, chr(10)), lambda x: length(x) > 0),
                                  lambda x: {_t('x')}) AS ex
            FROM {src}))"""


@register("judge_contest_stdout", with_ctes(S.STDOUT_PAIRS) + _g6_sql("pairs", "case_id"))
def q_judge_contest_stdout(spark, sf):
    p = V.stdout_pairs(spark, sf)
    return J.judge_contest_stdout(p, actual_col="actual", expected_col="expected").select("case_id", "passed")


@register("judge_contest_numeric", with_ctes(S.NUMERIC_PAIRS) + _g6_sql("npairs", ", ".join(NUM_KEYS)))
def q_judge_contest_numeric(spark, sf):
    p = V.numeric_pairs(spark, sf)
    return J.judge_contest_stdout(p, actual_col="actual", expected_col="expected").select(*NUM_KEYS, "passed")


# ------------------------------------------------------------------ C10
@register("pair_lines", with_ctes(S.STDOUT_PAIRS) + f"""
SELECT case_id, CAST(i - 1 AS INTEGER) AS line_no, a[i] AS actual_line, e[i] AS expected_line
FROM (SELECT case_id, a, e, unnest(range(1, least(len(a), len(e)) + 1)) AS i
      FROM (SELECT case_id, string_split({_t('actual')}, chr(10)) AS a, string_split({_t('expected')}, chr(10)) AS e
            FROM pairs))""")
def q_pair_lines(spark, sf):
    return J.pair_lines(V.stdout_pairs(spark, sf), "case_id", "actual", "expected")


# ------------------------------------------------------------------ G9
_NEXT = """
nl AS (SELECT doc_id, text AS next_line,
    CASE doc_id % 3 WHEN 0 THEN replace(text, ' ', ' ' || chr(9) || ' ')
                    WHEN 1 THEN text || ' x'
                    ELSE '  ' || text || chr(10) END AS prediction
  FROM documents)"""

_WS_RUN = "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in T.PY_WHITESPACE) + "]+"


def _tokens(x: str) -> str:
    return (f"(CASE WHEN {_t(x)} = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE string_split_regex({_t(x)}, '{_WS_RUN}') END)")


@register("judge_next_line", with_ctes(_NEXT) +
          f"SELECT doc_id, {_tokens('prediction')} = {_tokens('next_line')} AS passed FROM nl")
def q_judge_next_line(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    first = F.col("text")
    pred = (F.when(i % 3 == 0, F.replace(first, F.lit(" "), F.lit(" \t ")))
            .when(i % 3 == 1, F.concat(first, F.lit(" x")))
            .otherwise(F.concat(F.lit("  "), first, F.lit("\n"))))
    df = d.select("doc_id", first.alias("next_line"), pred.alias("prediction"))
    return J.judge_next_line(df).select("doc_id", "passed")


# ------------------------------------------------------------------ G18
@register("truncate_text", """
SELECT doc_id, doc_id % 2 = 0 AS passed,
  CASE WHEN doc_id % 2 = 0 AND length(text) > 1000 THEN left(text, 498) || '...' || right(text, 498) ELSE text END
    AS case_text,
  CASE WHEN length(text) > 300 THEN left(text, 150) || '...(truncated) ...' || right(text, 150) ELSE text END
    AS contest_text
FROM documents""")
def q_truncate_text(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text", (F.col("doc_id") % 2 == 0).alias("passed"))
    d = d.withColumn("case_text", F.col("text"))
    d = J.truncate_case_text(d, ["case_text"])
    return d.select("doc_id", "passed", "case_text",
                    T.truncate_middle(F.col("text"), 300, 150, "...(truncated) ...").alias("contest_text"))


# ------------------------------------------------------------------ G10
# The answers are other spellings of the reference, except that the reference of every sixteenth part is doubled:
# the expected verdicts follow from how the rows were made.
@register("judge_math", "SELECT p_partkey, p_partkey % 16 <> 6 AS passed FROM part")
def q_judge_math(spark, sf):
    p = V.table(spark, sf, "part")
    pr = F.col("p_retailprice").cast("decimal(18,2)").cast("string")
    k = (F.col("p_size") % 9 + 1).cast("string")
    m = F.col("p_partkey") % 8
    ans = (F.when(m == 0, F.concat(F.lit("\\$"), pr, F.lit(".")))
           .when(m == 1, F.concat(pr, F.lit("\\%")))
           .when(m == 2, F.concat(F.lit("x = "), pr))
           .when(m == 3, F.concat(F.lit("["), pr, F.lit(", 2]")))
           .when(m == 4, F.concat(F.lit("\\frac"), k, F.lit("2")))
           .when(m == 5, F.concat(F.col("p_size").cast("string"), F.lit("/7")))
           .when(m == 6, F.concat(pr, F.lit(" \\text{ dollars}")))
           .otherwise(F.col("p_brand")))
    scaled = (F.col("p_retailprice") * F.when(F.col("p_partkey") % 16 == 6, 2).otherwise(1)) \
        .cast("decimal(18,2)").cast("string")
    ref = (F.when(m == 3, F.concat(F.lit("["), pr, F.lit(",2]")))
           .when(m == 4, F.concat(F.lit("\\frac{"), k, F.lit("}{2}")))
           .when(m == 5, F.concat(F.lit("\\frac{"), F.col("p_size").cast("string"), F.lit("}{7}")))
           .when(m == 7, F.replace(F.col("p_brand"), F.lit("and"), F.lit("")))
           .otherwise(scaled))
    df = p.select("p_partkey", ans.alias("answer"), ref.alias("reference"))
    return J.judge_math(df).select("p_partkey", F.coalesce("passed", F.lit(False)).alias("passed"))
