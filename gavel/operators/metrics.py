"""Aggregations over verdicts and results.

All are partial-aggregate friendly: ``groupBy`` on the id first (map-side
combine), then a second aggregation over the much smaller per-id rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def pass_at_k_estimator(n: Column, c: Column, k: int) -> Column:
    """Unbiased pass@k, ``1 - prod(1 - k/i)`` for i in n-c+1..n; 1 when n-c < k.

    ``sequence(n+1, n)`` counts down in Spark, so c = 0 is handled explicitly.
    """
    prod = F.aggregate(F.sequence(n - c + 1, n), F.lit(1.0),
                       lambda acc, i: acc * (F.lit(1.0) - F.lit(float(k)) / i.cast("double")))
    return (F.when(n - c < k, F.lit(1.0))
            .when(c == 0, F.lit(0.0))
            .otherwise(F.lit(1.0) - prod))


def pass_at_k(results: DataFrame, n: int | None, ks: Sequence[int], id_col: str = "problem_id",
              category_col: str | None = "category", accepted_col: str = "accepted") -> DataFrame:
    """Mean pass@k per category, only for k <= n.

    Output: ``category, k, pass_at_k``.  With a configured repeat count ``n`` every
    problem counts as n samples, as in the reference; with ``n=None`` each problem
    counts all the samples it has, and takes part in the k it has samples for.
    """
    cat = F.col(category_col) if category_col else F.lit("all")
    per_id = (results.groupBy(F.col(id_col), cat.alias("category"))
              .agg(F.count_if(F.col(accepted_col)).alias("c"), F.count(F.lit(1)).alias("m")))
    if n is not None:
        per_id = per_id.withColumn("m", F.lit(n).cast("long"))
    if not ks:
        return per_id.select("category", F.lit(0).alias("k"), F.lit(0.0).alias("pass_at_k")).limit(0)
    per_k = per_id.select("category", "c", "m", F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k")).where("k <= m")
    est = F.coalesce(*[F.when(F.col("k") == k, pass_at_k_estimator(F.col("m"), F.col("c").cast("long"), k))
                       for k in map(int, ks)])
    return per_k.groupBy("category", "k").agg(F.avg(est).alias("pass_at_k"))


def accuracy_by_sample(results: DataFrame, id_col: str = "problem_id", sample_col: str = "sample_idx",
                       accepted_col: str = "accepted", group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy per sample index, only for indices every problem has (H1).

    Samples are numbered from 0 without gaps, so an index that every problem has
    counts as many problems as the fullest index of its group: one aggregation,
    then a maximum over the indices.  With no problems the result is empty.
    """
    g = list(group_cols)
    per_idx = (results.groupBy(*g, sample_col)
               .agg(F.count_if(F.col(accepted_col)).alias("n_accepted"), F.count(F.lit(1)).alias("n_problems")))
    fullest = F.max("n_problems").over(Window.partitionBy(*(g or [F.lit(0)])))
    return (per_idx.withColumn("__all", fullest).filter(F.col("n_problems") == F.col("__all"))
            .select(*g, sample_col, (F.col("n_accepted") / F.col("n_problems")).alias("accuracy")))


def accuracy_report(results: DataFrame, dataset_col: str = "dataset", sub_col: str = "sub_dataset",
                    **kw) -> DataFrame:
    """Mean of H1 per (dataset, sub-dataset), rolled up to dataset and overall (H2)."""
    per = accuracy_by_sample(results, group_cols=[dataset_col, sub_col], **kw)
    avg_acc = per.groupBy(dataset_col, sub_col).agg(F.avg("accuracy").alias("avg_acc"))
    return (avg_acc.rollup(dataset_col, sub_col)
            .agg(F.avg("avg_acc").alias("avg_acc"), F.count(F.lit(1)).alias("n_sub_datasets")))


def category_from_id(id_col: Column) -> Column:
    """``EvoEval_(.*)_EvoEval`` (greedy) on the id text (H4)."""
    return F.regexp_extract(id_col.cast("string"), r"EvoEval_(.*)_EvoEval", 1)


def category_from_labels(labels_json: Column, key: str = "difficulty_type") -> Column:
    """Category from the first case's labels JSON (H4)."""
    return F.get_json_object(labels_json, f"$.{key}")


def with_category(df: DataFrame, id_col: str = "id", labels_col: str | None = None) -> DataFrame:
    cat = category_from_id(F.col(id_col))
    if labels_col:
        cat = F.coalesce(category_from_labels(F.col(labels_col)), cat)
    return df.withColumn("category", cat)


def category_summary(df: DataFrame, categories: Sequence[str], flag_col: str = "needs_special_judge",
                     categories_col: str = "categories") -> DataFrame:
    """Count and proportion of flagged rows and of each category (H5), one pass.

    Rows may carry several categories; a missing flag counts as False.
    Output: ``name, n, total, proportion``.
    """
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(flag_col).eqNullSafe(True)).alias("__flag")]
    for i, c in enumerate(categories):
        aggs.append(F.count_if(F.coalesce(F.array_contains(F.col(categories_col), c), F.lit(False)))
                    .alias(f"__c{i}"))
    one = df.agg(*aggs)
    names = [(flag_col, "__flag")] + [(c, f"__c{i}") for i, c in enumerate(categories)]
    stack = "stack({}, {})".format(len(names), ", ".join(f"'{n}', {col}" for n, col in names))
    return (one.select("total", F.expr(stack).alias("name", "n"))
            .select("name", "n", "total",
                    F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(F.lit(0.0))
                    .alias("proportion")))


def endpoint_stats(tasks: DataFrame, endpoint_col: str = "endpoint", ok_col: str = "ok") -> DataFrame:
    """Per endpoint completed / failed / percent of all tasks (H6).

    The total is a scalar sub-query over a partial aggregate, not a window over all rows.
    """
    per = (tasks.groupBy(endpoint_col)
           .agg(F.count_if(F.col(ok_col)).alias("completed"),
                F.count_if(~F.col(ok_col)).alias("failed"),
                F.count(F.lit(1)).alias("tasks")))
    total = tasks.agg(F.count(F.lit(1))).scalar()
    return per.withColumn("percent", F.col("tasks") * F.lit(100.0) / total)


def pass_at_1(results: DataFrame, id_col: str = "problem_id", accepted_col: str = "accepted") -> DataFrame:
    """Per-problem pass@1 = accepted count / graded count (H7)."""
    return results.groupBy(id_col).agg(F.avg(F.col(accepted_col).cast("double")).alias("pass_at_1"))


def report_counts(tests: DataFrame, passed_col: str = "passed") -> DataFrame:
    """Pass / fail counts of a test report (H8)."""
    return tests.groupBy(passed_col).agg(F.count(F.lit(1)).alias("n"))


def row_counts(df: DataFrame, kept: Column) -> DataFrame:
    """Row counts before and after a filter (H9), as one two-row frame from one scan."""
    n = df.agg(F.count(F.lit(1)).alias("before"), F.count_if(kept).alias("after"))
    return n.select(F.explode(F.array(*(F.struct(F.lit(c).alias("stage"), F.col(c).alias("n")) for c in ("before", "after")))).alias("x")).select("x.*")


def distinct_imports(programs: DataFrame, key_cols: Sequence[str], array_col: str) -> DataFrame:
    """Set union of import lines per key, '' removed (H10): one row per key and line,
    a partial aggregate, so no row or task holds the set of a key."""
    return (programs.select(*key_cols, F.explode(array_col).alias("import_line"))
            .filter(F.col("import_line") != "").distinct())


def requests_per_endpoint(log: DataFrame, endpoints: DataFrame, key: str = "endpoint") -> DataFrame:
    """Connections per upstream address, zero included (A8): partial count, then a
    left join from the endpoint dimension."""
    counts = log.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (endpoints.select(key).join(counts, key, "left")
            .select(key, F.coalesce("n", F.lit(0).cast("long")).alias("n")))


def write_counted(df: DataFrame, kept: Column, write) -> DataFrame:
    """``row_counts`` of a filter, collected in the pass that writes the kept rows (H9): ``write`` takes the filtered rows."""
    before, after = Observation(), Observation()
    count = F.count(F.lit(1)).alias("n")
    write(df.observe(before, count).where(kept).observe(after, count))
    return df.sparkSession.createDataFrame([("before", before.get["n"]), ("after", after.get["n"])], "stage string, n long")
