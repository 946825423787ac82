"""Phase 0/1 plans: verdicts, results and metrics over the derived run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.operators import judging as J
from gavel.operators import metrics as M
from gavel.plans import fixtures as V
from gavel.plans import sql_views as S
from gavel.plans.registry import register, with_ctes

R9 = 9  # doubles are rounded to 9 digits on both sides of the oracle check


def _r(c: str):
    return F.round(F.col(c), R9).alias(c)


# ------------------------------------------------------------------ H3
PASS_AT_K_SQL = with_ctes("""
cc AS (SELECT l_partkey AS problem_id, p_brand AS category, count(*) AS n, count(*) FILTER (WHERE l_returnflag <> 'R') AS c
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""", "kk AS (SELECT unnest([1, 3]) AS k)") + """
SELECT category, k, round(avg(CASE WHEN n - c < k THEN 1.0::DOUBLE WHEN c = 0 THEN 0.0::DOUBLE
  ELSE 1.0::DOUBLE - list_reduce(list_prepend(1.0::DOUBLE,
         list_transform(range(n - c + 1, n + 1), lambda i: 1.0::DOUBLE - k::DOUBLE / i)), lambda a, b: a * b)
  END), 9) AS pass_at_k
FROM cc JOIN kk ON k <= n GROUP BY 1, 2
"""


@register("pass_at_k", PASS_AT_K_SQL)
def q_pass_at_k(spark, sf):
    """pass@1 and pass@3 by category over all samples of every problem."""
    return M.pass_at_k(V.verdicts(spark, sf), n=None, ks=[1, 3]).select("category", "k", _r("pass_at_k"))


# ------------------------------------------------------------------ G1 / G2 / G11
@register("run_status", with_ctes(S.RUNS, S.RUN_STATUS) +
          "SELECT submission_id, case_idx, status, message FROM runs_st")
def q_run_status(spark, sf):
    return J.run_status(V.runs(spark, sf)).select("submission_id", "case_idx", "status", "message")


@register("run_summary", with_ctes(S.RUNS, S.RUN_STATUS, S.RUN_SUMMARY) +
          "SELECT status, summary, count(*) AS n FROM runs_sum GROUP BY 1, 2")
def q_run_summary(spark, sf):
    st = J.run_summary(J.run_status(V.runs(spark, sf)), J.FULL_SUMMARY)
    return st.groupBy("status", "summary").agg(F.count(F.lit(1)).alias("n"))


@register("error_codes", with_ctes(S.RUNS, S.RUN_STATUS, S.RUN_SUMMARY) + """
SELECT CASE WHEN summary IN ('CompileFailed', 'CompileTimeout') THEN -1 WHEN summary = 'RunTimeout' THEN -3
            WHEN summary IN ('RunFailed', 'Invalid') THEN -4 WHEN NOT passed THEN -2 ELSE 0 END AS error_code,
       count(*) AS n
FROM runs_sum GROUP BY 1""")
def q_error_codes(spark, sf):
    st = J.run_summary(J.run_status(V.runs(spark, sf)), J.FULL_SUMMARY)
    return J.error_histogram(J.error_code(st))


# ------------------------------------------------------------------ G12 / G14 / G16 / A7
@register("cut_at_first_failure", with_ctes(S.RUNS, S.CUT) +
          "SELECT submission_id, case_idx, passed FROM kept")
def q_cut(spark, sf):
    return J.cut_at_first_failure(V.runs(spark, sf).select("submission_id", "case_idx", "passed"))


@register("results", with_ctes(S.RUNS, S.CUT) + """
SELECT o_orderkey AS submission_id, coalesce(p.accepted, true) AS accepted, coalesce(p.n_tests, 0) AS n_tests
FROM orders LEFT JOIN (SELECT submission_id, bool_and(passed) AS accepted, count(*) AS n_tests
                       FROM kept GROUP BY 1) p ON o_orderkey = p.submission_id""")
def q_results(spark, sf):
    return J.results_of_cases(V.runs(spark, sf).select("submission_id", "case_idx", "passed"), V.submissions(spark, sf))


@register("default_reject", with_ctes(S.RUNS, S.RUN_STATUS, S.CUT.replace("FROM runs ", "FROM runs_st ")) + """
SELECT o_orderkey AS submission_id, coalesce(p.accepted, false) AS accepted
FROM orders LEFT JOIN (SELECT submission_id, bool_and(passed) AS accepted FROM kept GROUP BY 1
                       HAVING count(*) FILTER (WHERE status = 'SandboxError') = 0) p ON o_orderkey = p.submission_id""")
def q_default_reject(spark, sf):
    st = J.run_status(V.runs(spark, sf)).select("submission_id", "case_idx", "passed", "status")
    kept = J.cut_at_first_failure(st)
    evaluated = (kept.groupBy("submission_id")
                 .agg(F.bool_and("passed").alias("accepted"),
                      F.count_if(F.col("status") == J.SANDBOX_ERROR).alias("n_err"))
                 .filter(F.col("n_err") == 0))
    return J.default_reject(V.submissions(spark, sf), evaluated)


@register("bad_cases", with_ctes(S.RUNS, S.RUN_STATUS, S.SUBMISSIONS) + """
SELECT b.submission_id, n_sandbox_error, n_cases, dt
FROM (SELECT submission_id, count(*) FILTER (WHERE status = 'SandboxError') AS n_sandbox_error, count(*) AS n_cases
      FROM runs_st GROUP BY 1 HAVING count(*) FILTER (WHERE status = 'SandboxError') > 0) b
JOIN subs ON b.submission_id = subs.submission_id""")
def q_bad_cases(spark, sf):
    st = J.run_status(V.runs(spark, sf)).select("submission_id", "status")
    return J.bad_cases(st, V.submissions(spark, sf))


# ------------------------------------------------------------------ H1 / H2 / H7
@register("accuracy_by_sample", with_ctes(S.SAMPLES_ALL) + """
SELECT sample_idx, round(n_acc / n_prob, 9) AS accuracy
FROM (SELECT sample_idx, count(*) FILTER (WHERE accepted) AS n_acc, count(*) AS n_prob FROM samples GROUP BY 1) p
WHERE sample_idx < (SELECT min(len) FROM (SELECT problem_id, count(*) AS len FROM samples GROUP BY 1))""")
def q_accuracy_by_sample(spark, sf):
    s = V.samples(spark, sf)
    return M.accuracy_by_sample(s).select("sample_idx", _r("accuracy"))


@register("accuracy_report", with_ctes(S.SAMPLES_ALL, """
per_idx AS (SELECT dataset, category AS sub_dataset, sample_idx, count(*) FILTER (WHERE accepted) AS n_acc, count(*) AS n_prob
            FROM samples GROUP BY 1, 2, 3)""", """
ml AS (SELECT dataset, sub_dataset, min(len) AS min_len
       FROM (SELECT dataset, category AS sub_dataset, problem_id, count(*) AS len FROM samples GROUP BY 1, 2, 3)
       GROUP BY 1, 2)""", """
acc AS (SELECT p.dataset, p.sub_dataset, avg(n_acc / n_prob) AS avg_acc
        FROM per_idx p JOIN ml ON p.dataset = ml.dataset AND p.sub_dataset = ml.sub_dataset
        WHERE sample_idx < min_len GROUP BY 1, 2)""") + """
SELECT dataset, sub_dataset, round(avg(avg_acc), 9) AS avg_acc, count(*) AS n_sub_datasets
FROM acc GROUP BY ROLLUP (dataset, sub_dataset)""")
def q_accuracy_report(spark, sf):
    s = V.samples(spark, sf).withColumnRenamed("category", "sub_dataset")
    return M.accuracy_report(s).select("dataset", "sub_dataset", _r("avg_acc"), "n_sub_datasets")


@register("pass_at_1", with_ctes(S.SAMPLES_ALL) +
          "SELECT problem_id, round(avg(CAST(accepted AS DOUBLE)), 9) AS pass_at_1 FROM samples GROUP BY 1")
def q_pass_at_1(spark, sf):
    return M.pass_at_1(V.verdicts(spark, sf)).select("problem_id", _r("pass_at_1"))


# ------------------------------------------------------------------ H4 / H5
@register("with_category", """
SELECT p_partkey AS problem_id,
       coalesce(json_extract_string(labels, '$.difficulty_type'), regexp_extract(id, 'EvoEval_(.*)_EvoEval', 1))
         AS category
FROM (SELECT p_partkey, 'EvoEval_' || replace(p_type, ' ', '_EvoEval_') || '_EvoEval/' || CAST(p_partkey AS VARCHAR) AS id,
             CASE WHEN p_partkey % 2 = 0 THEN json_object('difficulty_type', p_brand)::VARCHAR END AS labels
      FROM part)""")
def q_with_category(spark, sf):
    p = V.table(spark, sf, "part")
    df = p.select(F.col("p_partkey").alias("problem_id"),
                  F.concat(F.lit("EvoEval_"), F.regexp_replace("p_type", " ", "_EvoEval_"), F.lit("_EvoEval/"),
                           F.col("p_partkey").cast("string")).alias("id"),
                  F.when(F.col("p_partkey") % 2 == 0, F.to_json(F.struct(F.col("p_brand").alias("difficulty_type"))))
                  .alias("labels"))
    return M.with_category(df, "id", "labels").select("problem_id", "category")


_CAT_SQL = """
WITH a AS (SELECT count(*) AS total, count(*) FILTER (WHERE quality = 1) AS f, count(*) FILTER (WHERE toxic = 1) AS t, count(*) FILTER (WHERE false) AS fc
           FROM labels)
SELECT 'needs_special_judge' AS name, f AS n, total,
       CASE WHEN total > 0 THEN f / total ELSE 0.0 END AS proportion FROM a
UNION ALL SELECT 'toxic', t, total, CASE WHEN total > 0 THEN t / total ELSE 0.0 END FROM a
UNION ALL SELECT 'float_comparison', fc, total, CASE WHEN total > 0 THEN fc / total ELSE 0.0 END FROM a
"""


@register("category_summary", _CAT_SQL)
def q_category_summary(spark, sf):
    lab = V.table(spark, sf, "labels").select(
        (F.col("quality") == 1).alias("needs_special_judge"),
        F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>"))
        .alias("categories"))
    return M.category_summary(lab, ["toxic", "float_comparison"])
