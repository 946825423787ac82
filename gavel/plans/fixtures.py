"""Views derived from the driver's tables (FIXTURES.md section 2).

The driver tables are TPC-H-ish plus text tables; they are re-read here as the
engine's own tables (problems, submissions, runs, completions ...).  Every
view is a lazy DataFrame over the parquet scans, so Catalyst still prunes
columns and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.operators.segments import running

NL = "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- V1 samples
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems are parts, categories are brands, a submission per lineitem row; all of them, in no order."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_partkey").alias("problem_id"), F.col("p_brand").alias("category"), (F.col("l_returnflag") != "R").alias("accepted"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a sample index, which lineitem lacks: a row number of the problem's submissions."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag")
    ranked = running(li, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"], position="rn")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (ranked.join(part, ranked.l_partkey == part.p_partkey)
            .select(F.col("l_partkey").alias("problem_id"),
                    F.col("p_brand").alias("category"),
                    F.split("p_type", " ").getItem(0).alias("dataset"),
                    (F.col("rn") - 1).cast("int").alias("sample_idx"),
                    (F.col("l_returnflag") != "R").alias("accepted")))


# ---------------------------------------------------------------- V2 runs
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recorded run per (submission, case): orders are submissions, lines are cases.

    ``(l_orderkey, l_linenumber)`` repeats, so ``case_idx`` is a row number with a
    full tie-break.  Outcome columns follow FIXTURES.md (first match wins).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    li = running(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], position="rn")
    pk = F.col("l_partkey")
    compile_fail = (pk % 31 == 0)
    run_state = (F.when(compile_fail, F.lit(None).cast("string"))
                 .when(pk % 23 == 0, "TimeLimitExceeded")
                 .when(pk % 29 == 0, "Error")
                 .otherwise("Finished"))
    return (li.withColumn("case_idx", F.col("rn") - 1)
            .select(F.col("l_orderkey").alias("submission_id"),
                    F.col("case_idx").cast("int").alias("case_idx"),
                    (pk % 7 != 0).alias("passed"),
                    F.lit("Finished").alias("compile_state"),
                    F.when(compile_fail, 1).otherwise(0).alias("compile_return_code"),
                    F.when(compile_fail, "compile error").otherwise("").alias("compile_stderr"),
                    run_state.alias("run_state"),
                    F.when(run_state == "Finished", F.when(pk % 17 == 0, 1).otherwise(0)).alias("return_code"),
                    F.when(run_state == "Error", F.concat(F.lit("runner lost part "), pk.cast("string")))
                    .otherwise("").alias("run_stderr"),
                    (F.col("l_quantity") / 10).alias("execution_time")))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a submission (some have no cases at all)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("submission_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"))


# ---------------------------------------------------------------- V3 completions
def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model completions built from ``documents``: fenced, open-fenced or bare."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    i = F.col("doc_id")
    tag = (F.when(i % 4 == 0, "python").when(i % 4 == 1, "js").when(i % 4 == 2, "c++").otherwise(""))
    fenced = F.concat(F.lit("pre\n```"), tag, F.lit(NL), F.col("text"), F.lit("\n```\npost"),
                      F.when(i % 3 == 0, F.concat(F.lit("\n```py\nx="), i.cast("string"), F.lit("\n```")))
                      .otherwise(F.lit("")))
    body = (F.when(i % 13 == 0, F.concat(F.lit("def f(): "), F.col("text")))
            .when(i % 11 == 0, F.concat(F.lit("```python\n"), F.col("text")))
            .otherwise(fenced))
    prefix = F.when(i % 5 == 0, F.lit("think \n</think>\n")).otherwise(F.lit(""))
    return d.select("doc_id", "lang", F.concat(prefix, body).alias("completion"))


# ---------------------------------------------------------------- V4 stdout pairs
def stdout_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected = text; actual is the same, lower-cased, longer, wrong or padded."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    t = F.col("text")
    actual = (F.when(i % 5 == 0, t)
              .when(i % 5 == 1, F.lower(t))
              .when(i % 5 == 2, F.concat(t, F.lit("\nextra line")))
              .when(i % 5 == 3, F.concat(F.lit("x"), t))
              .otherwise(F.concat(F.lit(NL), t, F.lit("  "))))
    return d.select(i.alias("case_id"), t.alias("expected"), actual.alias("actual"),
                    F.lit("Success").alias("status"))


def numeric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices printed at 2 and 4 decimals, off by 0, 0.01, 10 or 0.0001."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_extendedprice")
    delta = (F.when(F.col("l_partkey") % 4 == 0, F.lit(0).cast("decimal(18,4)"))
             .when(F.col("l_partkey") % 4 == 1, F.lit(0.01).cast("decimal(18,4)"))
             .when(F.col("l_partkey") % 4 == 2, F.lit(10).cast("decimal(18,4)"))
             .otherwise(F.lit(0.0001).cast("decimal(18,4)")))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("expected"),
        (F.col("l_extendedprice").cast("decimal(18,4)") + delta).cast("decimal(18,4)").cast("string").alias("actual"),
        F.lit("Success").alias("status"))


# ---------------------------------------------------------------- V5 chat
def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


# ---------------------------------------------------------------- V6 run log
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a run log: user_id is the endpoint, 'error' is a SandboxError."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "ts", F.col("user_id").alias("endpoint"), "event_type", "value", "props")
