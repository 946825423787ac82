"""Table operators: pages, lookups, filters, joins, sample bookkeeping and case
tables (SURVEY 2.2, 2.3, 2.5 E11/E13/E15).

Joins are plain equi-joins; Catalyst/AQE choose broadcast vs. shuffle from
size statistics at plan and run time, so nothing is force-broadcast here
except fixed-size literal dimension tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.functions.text import split_nl
from gavel.sources.scratch import Scratch


# ------------------------------------------------------------------ B1-B4
def page(df: DataFrame, cols: Sequence[str] | None = None, offset: int = 0,
         limit: int | None = None, id_col: str = "id") -> DataFrame:
    """Column-pruned page ``ORDER BY id LIMIT offset, limit`` (B1): all rows unless a limit is
    given; with one, a top-(offset + limit) per task is merged."""
    rows = (df.select(*cols) if cols else df).orderBy(id_col)
    rows = rows.offset(offset) if offset else rows
    return rows if limit is None else rows.limit(limit)


class Pages:
    """Deep pages (B1) of a table that is stored once in ranges of its id.

    The row counts of the ranges tell which of them a page lies in; only these are
    read and sorted, however deep the page is.
    """

    def __init__(self, df: DataFrame, id_col: str = "id", ranges: int | None = None):
        self.spark, self.id_col, self.columns = df.sparkSession, id_col, df.columns
        n = ranges or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = f"{Scratch(self.spark, 'pages').root}/table"
        placed = df.repartitionByRange(n, id_col).withColumn("pg_range", F.spark_partition_id())
        placed.write.partitionBy("pg_range").parquet(self.path)
        self.schema = placed.schema
        self.table = self.spark.read.schema(self.schema).parquet(self.path)
        # one row for each range
        self.counts = sorted(tuple(r) for r in self.table.groupBy("pg_range").agg(F.count("*")).collect())

    def page(self, offset: int, limit: int, cols: Sequence[str] | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in order of the id."""
        before, held, skip = 0, [], 0
        for range_id, count in self.counts:
            if before + count > offset and before < offset + limit:
                if not held:
                    skip = offset - before
                held.append(range_id)
            before += count
        rows = self.table.where(F.col("pg_range").isin(held)).drop("pg_range")
        return page(rows, cols or self.columns, skip, limit, self.id_col)


def by_id(df: DataFrame, value, id_col: str = "id") -> DataFrame:
    """Point lookup (B2); ints and quoted strings are both accepted and pushed to the scan."""
    if isinstance(value, str):
        v = value.strip().strip("'\"")
        dtype = dict(df.dtypes)[id_col]
        lit = F.lit(v).cast(dtype) if dtype != "string" else F.lit(v)
    else:
        lit = F.lit(value)
    return df.filter(F.col(id_col) == lit)


def list_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of a dataset as strings (B3; ids are ``int | str`` in the reference)."""
    return df.select(F.col(id_col).cast("string").alias("id"))


def contest_between(df: DataFrame, start: str | None, end: str | None, ts_col: str = "contest_date") -> DataFrame:
    """Contest date range, both ends inclusive, dates parsed as midnight."""
    out = df
    if start is not None:
        out = out.filter(F.col(ts_col) >= F.to_timestamp(F.lit(start), "yyyy-MM-dd"))
    if end is not None:
        out = out.filter(F.col(ts_col) <= F.to_timestamp(F.lit(end), "yyyy-MM-dd"))
    return out


def needing_special_judge(df: DataFrame, flag_col: str = "needs_special_judge") -> DataFrame:
    """Rows whose flag is True; missing counts as False."""
    return df.filter(F.col(flag_col).eqNullSafe(True))


def has_category(df: DataFrame, category: str, col: str = "categories") -> DataFrame:
    """Category membership on an array column."""
    return df.filter(F.coalesce(F.array_contains(F.col(col), category), F.lit(False)))


def as_labels(df: DataFrame, prompt_col: str = "prompt", id_col: str = "id") -> DataFrame:
    """Labels = every column except the prompt, as JSON text."""
    rest = [c for c in df.columns if c != prompt_col]
    return df.select(F.col(id_col), F.col(prompt_col), F.to_json(F.struct(*rest)).alias("labels"))


# ------------------------------------------------------------------ B8-B11 predicates
from gavel.operators.extraction import WS as _WS  # noqa: E402

EXIT_RE = r"exit\(" + _WS + r"*0" + _WS + r"*\)"


def antihack_ok(code: Column, language: str) -> Column:
    """Exit-abuse check: python / cpp code containing ``exit(0)`` is never accepted."""
    if language not in ("python", "cpp"):
        return F.lit(True)
    return ~code.rlike(EXIT_RE)


def post_judge(accepted: Column, language: Column, stderr: Column) -> Column:
    """Racket runs whose stderr mentions FAILURE are rejected whatever the exit code."""
    return F.when((language == "racket") & (F.instr(F.coalesce(stderr, F.lit("")), "FAILURE") > 0),
                  F.lit(False)).otherwise(accepted)


def proof_ok(program: Column, theorem_name: Column, stdout: Column) -> Column:
    """The theorem name must still be in the program and no ``sorry`` warning."""
    return ((F.instr(program, theorem_name) > 0)
            & (F.instr(F.coalesce(stdout, F.lit("")), "declaration uses 'sorry'") == 0))


def flag_seen(stdout: Column, marker: Column) -> Column:
    """A per-submission success marker printed by the program."""
    return F.instr(F.coalesce(stdout, F.lit("")), marker) > 0


# ------------------------------------------------------------------ C1-C5
def attach_problem(subs: DataFrame, problems: DataFrame, keys: Sequence[str] = ("dataset", "id")) -> DataFrame:
    """Submission x problem on the key (C1); inner, strategy left to Catalyst/AQE."""
    return subs.join(problems, list(keys), "inner")


def attach_checker(problems: DataFrame, checkers: DataFrame, key: str, checker_col: str,
                   order_col: str) -> DataFrame:
    """Problem x checker; problems without one dropped; the last checker per key wins.

    ``max_by`` is a partial aggregate, so duplicates collapse map-side.
    """
    last = checkers.groupBy(key).agg(F.max_by(checker_col, order_col).alias(checker_col))
    return problems.join(last, key, "inner")


def attach_samples(problems: DataFrame, samples: DataFrame, key: str = "id",
                   sample_col: str = "sample") -> DataFrame:
    """Problem x sample list; a missing problem keeps an empty list."""
    return (problems.join(samples.select(key, sample_col), key, "left")
            .withColumn(sample_col, F.coalesce(F.col(sample_col), F.array().cast("array<string>"))))


def pending(todo: DataFrame, done: DataFrame, key: str = "id", sample_col: str | None = None) -> DataFrame:
    """Rows not done yet (C4): id absent from ``done``; with ``sample_col`` an
    empty sample list also counts as not done (sampler resume)."""
    d = done
    if sample_col is not None:
        d = d.filter(F.size(F.col(sample_col)) > 0)
    return todo.join(d.select(key), key, "left_anti")


def merge_samples(problems: DataFrame, existing: DataFrame, new: DataFrame, key: str = "id",
                  sample_col: str = "sample") -> DataFrame:
    """Existing samples plus new ones for pending ids; new wins for those."""
    have = existing.filter(F.size(F.col(sample_col)) > 0).select(key, F.col(sample_col).alias("__old"))
    fresh = new.select(key, F.col(sample_col).alias("__new"))
    return (problems.select(key).join(have, key, "left").join(fresh, key, "left")
            .select(key, F.coalesce(F.col("__old"), F.col("__new"), F.array().cast("array<string>"))
                    .alias(sample_col)))


# ------------------------------------------------------------------ C7
def expand_samples(df: DataFrame, n: int, key: str = "id", spread: int | None = None) -> DataFrame:
    """Each prompt n times as (prompt, sample_idx).

    The reference shuffles its task queue so easy and hard prompts mix; here
    ``spread`` round-robins the grid over that many partitions (deterministic
    under task retry, unlike a random partition key).
    """
    out = df.withColumn("sample_idx", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    if spread:
        out = out.repartition(spread)
    return out


def regroup_samples(grid: DataFrame, results: DataFrame, n: int, key: str = "id",
                    text_col: str = "text") -> DataFrame:
    """Back to one list per prompt in sample order, '' for holes.

    A per-key collect is bounded by n (the configured number of samples).
    """
    full = grid.select(key, "sample_idx").join(results.select(key, "sample_idx", text_col),
                                               [key, "sample_idx"], "left")
    agg = full.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("sample_idx", F.coalesce(F.col(text_col), F.lit("")).alias("t"))))
        .alias("__s"))
    return agg.select(key, F.transform("__s", lambda s: s["t"]).alias("sample"))


# ------------------------------------------------------------------ C9 / E13
def explode_cases(df: DataFrame, keep: Sequence[str], input_col: str = "input", output_col: str = "output",
                  type_col: str = "type", fn_col: str = "fn_name") -> DataFrame:
    """Case batch -> one row per case (C9): input[i] with output[i]; a shorter
    output list is an error, as in the reference (index error)."""
    checked = df.withColumn("__n", F.when(F.size(output_col) >= F.size(input_col), F.size(input_col))
                            .otherwise(F.raise_error(F.lit("case batch: output shorter than input"))))
    return (checked.select(*keep, type_col, fn_col,
                           F.posexplode(F.arrays_zip(F.col(input_col).alias("i"),
                                                     F.slice(output_col, 1, F.col("__n")).alias("o")))
                           .alias("case_idx", "__z"))
            .select(*keep, "case_idx", type_col, fn_col, F.col("__z.i").alias("input"),
                    F.col("__z.o").alias("output")))


def json_input_case(input_text: Column, output_text: Column) -> Column:
    """``json_input`` normalisation of one function-call case (E13) ->
    ``struct(input variant, output variant)``.

    Input is split on newlines and each line parsed as JSON (one argument per
    line), output wrapped in a one-element list.  If an input line is not JSON
    both stay raw strings; if only the output is not JSON the parsed input is
    kept with the raw output.
    """
    lines = split_nl(input_text)
    in_ok = F.forall(lines, lambda x: F.try_parse_json(x).isNotNull())
    out_ok = F.try_parse_json(output_text).isNotNull()
    args = F.parse_json(F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]")))
    wrapped = F.parse_json(F.concat(F.lit("["), output_text, F.lit("]")))
    return F.struct(F.when(in_ok, args).otherwise(input_text.cast("variant")).alias("input"),
                    F.when(in_ok & out_ok, wrapped).otherwise(output_text.cast("variant")).alias("output"))


# ------------------------------------------------------------------ B6 / E11 / E15
def is_training_row(gold: Column, info: Column) -> Column:
    """Training-row rule (B6): gold solution present, a python fence at both
    ends, language python, more than 4 cases and a first case with input and output."""
    cases = info["test_cases"]
    first = F.try_element_at(cases, F.lit(1))
    rule = (gold.isNotNull() & F.startswith(gold, F.lit("```python")) & F.endswith(gold, F.lit("```"))
            & (info["language"] == "python") & (F.coalesce(F.size(cases), F.lit(0)) > 4)
            & first["input"].isNotNull() & first["output"].isNotNull())
    return F.coalesce(rule, F.lit(False))


def training_rows(df: DataFrame, gold_col: str = "gold_standard_solution", info_col: str = "info") -> DataFrame:
    """Rows that make training examples."""
    return df.filter(is_training_row(F.col(gold_col), F.col(info_col)))


def columnar_cases(cases: Column) -> Column:
    """Case list -> columnar tests sharing fn_name and type, as JSON text.

    ``cases`` is ``array<struct<input string, output string, fn_name string>>``.
    Function-call cases get each input line parsed as JSON and the output
    parsed; stdin cases keep text.  The reference then appends the raw values a
    second time (a defect); here each case is appended once.
    """
    first = F.try_element_at(cases, F.lit(1))
    call = F.struct(
        F.transform(cases, lambda c: F.transform(split_nl(c["input"]), lambda x: F.parse_json(x))).alias("input"),
        F.transform(cases, lambda c: F.parse_json(c["output"])).alias("output"),
        first["fn_name"].alias("fn_name"), F.lit("function_call").alias("type"))
    stdin = F.struct(F.transform(cases, lambda c: c["input"]).alias("input"),
                     F.transform(cases, lambda c: c["output"]).alias("output"),
                     F.lit(None).cast("string").alias("fn_name"), F.lit("stdin_stdout").alias("type"))
    opts = {"ignoreNullFields": "false"}
    return F.when(first["fn_name"].isNotNull(), F.to_json(call, opts)).otherwise(F.to_json(stdin, opts))


def training_record(df: DataFrame, prompt_col: str = "prompt", gold_col: str = "gold_standard_solution",
                    info_col: str = "info", source_col: str = "source", id_col: str = "problem_id") -> DataFrame:
    """RL training record (E15): prompt messages, solutions, ground truth, source.

    Rejected rows become the empty record (solutions ``['']``, ground truth '')
    so that ``training_rows``-style filtering can drop them later.
    """
    good = is_training_row(F.col(gold_col), F.col(info_col))
    return df.select(
        F.col(id_col),
        F.array(F.struct(F.lit("user").alias("role"), F.col(prompt_col).alias("content"))).alias("prompt"),
        F.when(good, F.array(F.col(gold_col))).otherwise(F.array(F.lit(""))).alias("solutions"),
        F.struct(F.when(good, columnar_cases(F.col(f"{info_col}.test_cases"))).otherwise(F.lit(""))
                 .alias("ground_truth"), F.lit("rule").alias("style")).alias("reward_model"),
        F.col(source_col).alias("data_source"))


# ------------------------------------------------------------------ C6
# HumanEval / MultiPL-E dataset id -> run language and extraction language.
HUMANEVAL_RUN_LANGUAGE = {
    "humaneval_python": "python", "humaneval_cpp": "cpp", "humaneval_typescript": "typescript",
    "humaneval_bash": "bash", "humaneval_csharp": "csharp", "humaneval_go": "go_test", "humaneval_java": "java",
    "humaneval_lua": "lua", "humaneval_javascript": "nodejs", "humaneval_php": "php", "humaneval_perl": "perl",
    "humaneval_racket": "racket", "humaneval_r": "R", "humaneval_rust": "rust", "humaneval_scala": "scala",
    "humaneval_swift": "swift", "humaneval_ruby": "ruby", "humaneval_d": "D_ut", "humaneval_julia": "julia",
    "shadow_humaneval_python": "python", "evoeval": "python",
}
HUMANEVAL_EXTRACT_LANGUAGE = {
    "humaneval_python": "python", "humaneval_cpp": "cpp", "humaneval_typescript": "typescript",
    "humaneval_bash": "bash", "humaneval_csharp": "csharp", "humaneval_go": "go", "humaneval_java": "java",
    "humaneval_lua": "lua", "humaneval_js": "js", "humaneval_php": "php", "humaneval_perl": "perl",
    "humaneval_racket": "racket", "humaneval_r": "r", "humaneval_rust": "rust", "humaneval_scala": "scala",
    "humaneval_swift": "swift", "humaneval_ruby": "ruby", "humaneval_d": "d", "humaneval_julia": "julia",
    "shadow_humaneval_python": "python", "evoeval": "python",
}


def map_language(key: Column, mapping: dict[str, str], default: Column) -> Column:
    """Dataset / alias -> language with a default (C6); a literal map, no join."""
    from itertools import chain
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.coalesce(F.element_at(m, key), default)
