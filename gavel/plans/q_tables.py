"""Phase 4 plans: tables in and out, lookups, resume and sample bookkeeping, cases."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gavel.operators import extraction as X
from gavel.operators import tables as TB
from gavel.plans import fixtures as V
from gavel.plans import sql_views as S
from gavel.plans.q_extraction import _CLASSIFIED, _classified
from gavel.plans.registry import register, with_ctes


# ------------------------------------------------------------------ B1-B4
@register("page", "SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 10 OFFSET 5")
def q_page(spark, sf):
    return TB.page(V.table(spark, sf, "benchmark"), ["item_id", "text"], offset=5, limit=10, id_col="item_id")


@register("by_id", "SELECT doc_id, lang, text FROM documents WHERE doc_id = 42")
def q_by_id(spark, sf):
    return TB.by_id(V.table(spark, sf, "documents"), "'42'", id_col="doc_id").select("doc_id", "lang", "text")


@register("list_ids", "SELECT CAST(item_id AS VARCHAR) AS id FROM benchmark")
def q_list_ids(spark, sf):
    return TB.list_ids(V.table(spark, sf, "benchmark"), "item_id")


@register("contest_between", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1995-06-30'""")
def q_contest_between(spark, sf):
    o = V.table(spark, sf, "orders")
    return (TB.contest_between(o, "1995-01-01", "1995-06-30", "o_orderdate")
            .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt")))


# ------------------------------------------------------------------ B5 / B7 on classified rows
_CLASSIFIED_PARSED = with_ctes(_CLASSIFIED, f"""
s AS (SELECT doc_id, {S.py_strip_sql("string_split(raw, '</think>')[-1]")} AS s FROM raw)""", f"""
j AS (SELECT doc_id, CASE WHEN starts_with(s, '```json') THEN {S.py_strip_sql('substr(s, 8, greatest(length(s) - 10, 0))')}
                          WHEN starts_with(s, '```') THEN {S.py_strip_sql('substr(s, 4, greatest(length(s) - 6, 0))')}
                          ELSE s END AS body FROM s)""", """
k0 AS (SELECT doc_id, coalesce(json_valid(body), false) AS valid, body FROM j)""", """
k AS (SELECT doc_id, CASE WHEN ok THEN body END AS body, ok
      FROM (SELECT doc_id, body, valid AND json_type(CASE WHEN valid THEN body END) = 'OBJECT' AS ok FROM k0))""", """
c AS (SELECT doc_id,
  CASE WHEN ok THEN coalesce(CAST(json_extract(body, '$.needs_special_judge') AS BOOLEAN), false)
                    OR coalesce(len(from_json(json_extract(body, '$.categories'), '["VARCHAR"]')), 0) > 0
       ELSE false END AS needs_special_judge,
  CASE WHEN ok THEN coalesce(from_json(json_extract(body, '$.categories'), '["VARCHAR"]'), [])
       ELSE CAST([] AS VARCHAR[]) END AS categories
FROM k)""")


@register("needing_special_judge", _CLASSIFIED_PARSED + "SELECT doc_id FROM c WHERE needs_special_judge")
def q_needing_special_judge(spark, sf):
    c = X.parse_classification(_classified(spark, sf), "raw")
    return TB.needing_special_judge(c).select("doc_id")


@register("has_category", _CLASSIFIED_PARSED + "SELECT doc_id FROM c WHERE list_contains(categories, 'toxic')")
def q_has_category(spark, sf):
    c = X.parse_classification(_classified(spark, sf), "raw")
    return TB.has_category(c, "toxic").select("doc_id")


# ------------------------------------------------------------------ C1 / C2
@register("attach_problem", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def q_attach_problem(spark, sf):
    li = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                               "l_extendedprice")
    p = V.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return TB.attach_problem(li, p, ["l_partkey"])


@register("attach_checker", """
SELECT p_partkey, checker FROM part JOIN (
  SELECT l_partkey, arg_max('check_' || CAST(l_suppkey AS VARCHAR),
                            (l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS checker
  FROM lineitem GROUP BY 1) c ON p_partkey = c.l_partkey""")
def q_attach_checker(spark, sf):
    li = V.table(spark, sf, "lineitem")
    checkers = li.select(F.col("l_partkey").alias("p_partkey"),
                         F.concat(F.lit("check_"), F.col("l_suppkey").cast("string")).alias("checker"),
                         F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("ord"))
    p = V.table(spark, sf, "part").select("p_partkey")
    return TB.attach_checker(p, checkers, "p_partkey", "checker", "ord")


# ------------------------------------------------------------------ C3-C5 sample files
_SAMPLES_SQL = """
sfile AS (SELECT conv_id AS id,
    CASE WHEN conv_id % 4 = 0 THEN CAST([] AS VARCHAR[])
         ELSE coalesce(list(text ORDER BY turn) FILTER (WHERE role = 'assistant'), CAST([] AS VARCHAR[])) END AS sample
  FROM conversations GROUP BY conv_id)"""


def _sample_file(spark, sf):
    """A sample file ``{id, sample: [str]}``: assistant turns of each conversation in order."""
    c = V.chat_messages(spark, sf)
    agg = c.groupBy(F.col("conv_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text")))).alias("s"))
    sample = F.when(F.col("id") % 4 == 0, F.array().cast("array<string>")).otherwise(
        F.transform("s", lambda x: x["text"]))
    return agg.select("id", sample.alias("sample"))


def _problems(spark, sf):
    return V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))


@register("attach_samples", with_ctes(_SAMPLES_SQL) + """
SELECT doc_id AS id, coalesce(sample, CAST([] AS VARCHAR[])) AS sample
FROM documents LEFT JOIN sfile ON doc_id = sfile.id""")
def q_attach_samples(spark, sf):
    return TB.attach_samples(_problems(spark, sf), _sample_file(spark, sf))


@register("pending", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_pending(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id")
    return TB.pending(d, V.table(spark, sf, "labels"), key="doc_id")


@register("pending_samples", with_ctes(_SAMPLES_SQL) + """
SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT id FROM sfile WHERE len(sample) > 0)""")
def q_pending_samples(spark, sf):
    return TB.pending(_problems(spark, sf), _sample_file(spark, sf), sample_col="sample")


@register("merge_samples", with_ctes(_SAMPLES_SQL) + """
SELECT doc_id AS id,
  CASE WHEN sfile.id IS NOT NULL AND len(sfile.sample) > 0 THEN sfile.sample
       ELSE ['new ' || CAST(doc_id AS VARCHAR)] END AS sample
FROM documents LEFT JOIN sfile ON doc_id = sfile.id""")
def q_merge_samples(spark, sf):
    problems = _problems(spark, sf)
    existing = _sample_file(spark, sf)
    todo = TB.pending(problems, existing, sample_col="sample")
    new = todo.select("id", F.array(F.concat(F.lit("new "), F.col("id").cast("string"))).alias("sample"))
    return TB.merge_samples(problems, existing, new)


# ------------------------------------------------------------------ C7
@register("expand_samples", "SELECT item_id, CAST(unnest(range(0, 4)) AS INTEGER) AS sample_idx FROM benchmark")
def q_expand_samples(spark, sf):
    b = V.table(spark, sf, "benchmark").select("item_id")
    return TB.expand_samples(b, 4, spread=8).select("item_id", "sample_idx")


@register("regroup_samples", """
WITH g AS (SELECT item_id, text, CAST(unnest(range(0, 4)) AS INTEGER) AS sample_idx FROM benchmark),
r AS (SELECT item_id, sample_idx, CASE WHEN (item_id + sample_idx) % 3 <> 0 THEN text || '#' || CAST(sample_idx AS VARCHAR) END AS text FROM g)
SELECT g.item_id, list(coalesce(r.text, '') ORDER BY g.sample_idx) AS sample
FROM g LEFT JOIN r ON g.item_id = r.item_id AND g.sample_idx = r.sample_idx GROUP BY g.item_id""")
def q_regroup_samples(spark, sf):
    b = V.table(spark, sf, "benchmark").select("item_id", "text")
    grid = TB.expand_samples(b, 4)
    answer = F.concat(F.col("text"), F.lit("#"), F.col("sample_idx").cast("string"))
    res = grid.select("item_id", "sample_idx", F.when((F.col("item_id") + F.col("sample_idx")) % 3 != 0, answer).alias("text"))
    return TB.regroup_samples(grid, res, 4, key="item_id")


# ------------------------------------------------------------------ C9 / E13
@register("explode_cases", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS case_idx, 'stdin_stdout' AS type, CAST(NULL AS VARCHAR) AS fn_name,
       inp[i] AS input, lower(inp[i]) AS output
FROM (SELECT doc_id, inp, unnest(range(1, len(inp) + 1)) AS i
      FROM (SELECT doc_id, string_split(text, '. ') AS inp FROM documents))""")
def q_explode_cases(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    inp = F.split(F.col("text"), r"\. ", -1)
    batch = d.select("doc_id", F.lit("stdin_stdout").alias("type"), F.lit(None).cast("string").alias("fn_name"),
                     inp.alias("input"), F.transform(inp, lambda x: F.lower(x)).alias("output"))
    return TB.explode_cases(batch, ["doc_id"])


_JSON_CASES = r"""
jc AS (SELECT doc_id,
    CASE WHEN doc_id % 5 = 0 THEN 'not json ' || w ELSE '"' || w || '"' || chr(10) || CAST(n_chars AS VARCHAR) END AS inp,
    CASE WHEN doc_id % 7 = 0 THEN 'oops' ELSE CAST(length(w) AS VARCHAR) END AS outp
  FROM (SELECT doc_id, n_chars, regexp_replace(text, '[^\p{L}]', '', 'g') AS w FROM documents))"""


@register("json_input_cases", with_ctes(_JSON_CASES) + """
SELECT doc_id,
  CASE WHEN doc_id % 5 = 0 THEN CAST(to_json(inp) AS VARCHAR)
       ELSE '[' || array_to_string(string_split(inp, chr(10)), ',') || ']' END AS input,
  CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 THEN CAST(to_json(outp) AS VARCHAR) ELSE '[' || outp || ']' END AS output
FROM jc""")
def q_json_input_cases(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    i = F.col("doc_id")
    w = F.regexp_replace("text", r"[^\p{L}]", "")
    inp = F.when(i % 5 == 0, F.concat(F.lit("not json "), w)).otherwise(
        F.concat(F.lit('"'), w, F.lit('"\n'), F.col("n_chars").cast("string")))
    outp = F.when(i % 7 == 0, F.lit("oops")).otherwise(F.length(w).cast("string"))
    case = TB.json_input_case(inp, outp)
    return d.select("doc_id", F.to_json(case["input"]).alias("input"), F.to_json(case["output"]).alias("output"))


# ------------------------------------------------------------------ B6 / E11 / E15
def _raw_training(spark, sf):
    """Raw training problems: prompt, source, gold solution and verification info."""
    d = V.table(spark, sf, "documents").select("doc_id", "text", "source")
    i = F.col("doc_id")
    raw = F.split("text", " ")
    words = F.transform(raw, lambda x: F.regexp_replace(x, r"[^\p{L}]", ""))
    body = F.array_join(words, " ")
    gold = (F.when(i % 5 == 0, F.lit(None).cast("string"))
            .when(i % 5 == 1, F.concat(F.lit("no fence "), body))
            .otherwise(F.concat(F.lit("```python\n"), body, F.lit("\n```"))))
    is_call = i % 2 == 0
    cases = F.transform(words, lambda w, k: F.struct(
        F.when(is_call, F.concat(F.lit('"'), w, F.lit('"\n'), (k + 1).cast("string"))).otherwise(w).alias("input"),
        F.when(is_call, F.length(w).cast("string")).otherwise(F.lower(w)).alias("output"),
        F.when(is_call, F.lit("f")).otherwise(F.lit(None).cast("string")).alias("fn_name")))
    info = F.struct(F.when(i % 7 == 0, F.lit("cpp")).otherwise(F.lit("python")).alias("language"),
                    cases.alias("test_cases"))
    return d.select(i.alias("problem_id"), F.col("text").alias("prompt"), "source",
                    gold.alias("gold_standard_solution"), info.alias("info"))


_TRAIN_SQL = r"""
tw AS (SELECT doc_id, text, source,
         list_transform(string_split(text, ' '), lambda x: regexp_replace(x, '[^\p{L}]', '', 'g')) AS words
       FROM documents),
tr AS (SELECT doc_id AS problem_id, text AS prompt, source,
    CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN 'no fence ' || array_to_string(words, ' ')
         ELSE '```python' || chr(10) || array_to_string(words, ' ') || chr(10) || '```' END AS gold,
    CASE WHEN doc_id % 7 = 0 THEN 'cpp' ELSE 'python' END AS language,
    doc_id % 2 = 0 AS is_call,
    words AS cw
  FROM tw),
ok AS (SELECT *, gold IS NOT NULL AND starts_with(gold, '```python') AND ends_with(gold, '```')
                 AND language = 'python' AND len(cw) > 4 AS good FROM tr)"""


@register("training_rows", with_ctes(_TRAIN_SQL) + "SELECT problem_id FROM ok WHERE good")
def q_training_rows(spark, sf):
    return TB.training_rows(_raw_training(spark, sf)).select("problem_id")


@register("training_record", with_ctes(_TRAIN_SQL) + """
SELECT problem_id, prompt AS prompt_content,
  CASE WHEN good THEN [gold] ELSE [''] END AS solutions,
  CASE WHEN NOT good THEN ''
       WHEN is_call THEN to_json({'input': list_transform(cw, lambda w, k: json('[' || '"' || w || '",' || CAST(k AS VARCHAR) || ']')),
                                   'output': list_transform(cw, lambda w: json(CAST(length(w) AS VARCHAR))),
                                   'fn_name': 'f', 'type': 'function_call'})::VARCHAR
       ELSE to_json({'input': cw, 'output': list_transform(cw, lambda w: lower(w)),
                     'fn_name': CAST(NULL AS VARCHAR), 'type': 'stdin_stdout'})::VARCHAR END AS ground_truth,
  'rule' AS style, source AS data_source
FROM ok""")
def q_training_record(spark, sf):
    r = TB.training_record(_raw_training(spark, sf))
    return r.select("problem_id", F.col("prompt")[0]["content"].alias("prompt_content"), "solutions",
                    F.col("reward_model.ground_truth").alias("ground_truth"),
                    F.col("reward_model.style").alias("style"), "data_source")


# ------------------------------------------------------------------ B9-B12 predicates over stdout pairs
_PRED = """
pr AS (SELECT doc_id,
    CASE doc_id % 3 WHEN 0 THEN 'racket' WHEN 1 THEN 'python' ELSE 'lean' END AS language,
    CASE WHEN doc_id % 4 = 0 THEN 'FAILURE in test' ELSE 'ok' END AS stderr,
    CASE WHEN doc_id % 5 = 0 THEN text || ' declaration uses ''sorry''' ELSE text END AS stdout,
    split_part(text, ' ', 1) AS marker, doc_id % 2 = 0 AS exit_ok
  FROM documents)"""


@register("post_judge_flags", with_ctes(_PRED) + """
SELECT doc_id,
  CASE WHEN language = 'racket' AND strpos(stderr, 'FAILURE') > 0 THEN false ELSE exit_ok END AS accepted,
  strpos(stdout, marker) > 0 AS flag_seen,
  strpos(stdout, marker) > 0 AND strpos(stdout, 'declaration uses ''sorry''') = 0 AS proof_ok
FROM pr""")
def q_post_judge_flags(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i, t = F.col("doc_id"), F.col("text")
    p = d.select("doc_id",
                 F.when(i % 3 == 0, "racket").when(i % 3 == 1, "python").otherwise("lean").alias("language"),
                 F.when(i % 4 == 0, "FAILURE in test").otherwise("ok").alias("stderr"),
                 F.when(i % 5 == 0, F.concat(t, F.lit(" declaration uses 'sorry'"))).otherwise(t).alias("stdout"),
                 F.split_part(t, F.lit(" "), F.lit(1)).alias("marker"), (i % 2 == 0).alias("exit_ok"))
    return p.select("doc_id", TB.post_judge(F.col("exit_ok"), F.col("language"), F.col("stderr")).alias("accepted"),
                    TB.flag_seen(F.col("stdout"), F.col("marker")).alias("flag_seen"),
                    TB.proof_ok(F.col("stdout"), F.col("marker"), F.col("stdout")).alias("proof_ok"))


@register("as_labels", """
SELECT item_id AS id, text AS prompt,
       '{"id":' || CAST(item_id AS VARCHAR) || ',"n_chars":' || CAST(length(text) AS VARCHAR) || '}' AS labels
FROM benchmark""")
def q_as_labels(spark, sf):
    b = V.table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("prompt"),
                                               F.length("text").alias("n_chars"))
    return TB.as_labels(b, "prompt", "id").select("id", "prompt", "labels")


# ------------------------------------------------------------------ H9 / H10
@register("row_counts", with_ctes(_TRAIN_SQL) + """
SELECT 'before' AS stage, count(*) AS n FROM ok UNION ALL SELECT 'after', count(*) FILTER (WHERE good) FROM ok""")
def q_row_counts(spark, sf):
    from gavel.operators import metrics as M
    raw = _raw_training(spark, sf)
    return M.row_counts(raw, TB.is_training_row(F.col("gold_standard_solution"), F.col("info")))


@register("distinct_imports", r"""
SELECT DISTINCT source, 'import ' || w AS import_line
FROM (SELECT source, unnest(string_split(text, ' ')) AS w FROM documents) WHERE w <> ''""")
def q_distinct_imports(spark, sf):
    from gavel.operators import metrics as M
    d = V.table(spark, sf, "documents")
    imps = F.transform(F.split("text", " "), lambda w: F.when(w == "", "").otherwise(F.concat(F.lit("import "), w)))
    return M.distinct_imports(d.select("source", imps.alias("imps")), ["source"], "imps")


# ------------------------------------------------------------------ A3
@register("read_versions", """
SELECT 'lineitem' AS version, count(*) AS n, sum(l_orderkey)::BIGINT AS keys, sum(l_partkey)::BIGINT AS others FROM lineitem
UNION ALL SELECT 'orders', count(*), sum(o_orderkey)::BIGINT, sum(o_custkey)::BIGINT FROM orders""")
def q_read_versions(spark, sf):
    import os
    from gavel.sources.readers import read_versions
    base, _ = os.path.split(sf.rstrip("/"))
    name = os.path.basename(sf.rstrip("/"))
    df = read_versions(spark, base, [name], "lineitem.parquet").select(F.lit("lineitem").alias("version"), "l_orderkey", "l_partkey")
    df2 = read_versions(spark, base, [name], "orders.parquet").select(F.lit("orders").alias("version"), "o_orderkey", "o_custkey")
    return df.union(df2).groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"), F.sum("l_partkey").alias("others"))


# ------------------------------------------------------------------ C6
_DATASETS = sorted(TB.HUMANEVAL_RUN_LANGUAGE) + ["humaneval_js", "mbpp", "other"]


@register("map_language", f"""
SELECT item_id, dataset,
  coalesce(CASE dataset {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in TB.HUMANEVAL_RUN_LANGUAGE.items())} END,
           row_language) AS run_language,
  split_part(coalesce(CASE dataset {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in TB.HUMANEVAL_EXTRACT_LANGUAGE.items())}
                      END, row_language), '.', 1) AS extract_language
FROM (SELECT item_id, ({'['+', '.join(repr(d) for d in _DATASETS)+']'})[item_id % {len(_DATASETS)} + 1] AS dataset,
             CASE WHEN item_id % 2 = 0 THEN 'python' ELSE 'cpp.x' END AS row_language FROM benchmark)""")
def q_map_language(spark, sf):
    b = V.table(spark, sf, "benchmark")
    ds = F.element_at(F.array(*[F.lit(d) for d in _DATASETS]), (F.col("item_id") % len(_DATASETS) + 1).cast("int"))
    row_lang = F.when(F.col("item_id") % 2 == 0, F.lit("python")).otherwise(F.lit("cpp.x"))
    m = b.select("item_id", ds.alias("dataset"), row_lang.alias("row_language"))
    return m.select("item_id", "dataset",
                    TB.map_language(F.col("dataset"), TB.HUMANEVAL_RUN_LANGUAGE, F.col("row_language"))
                    .alias("run_language"),
                    F.split_part(TB.map_language(F.col("dataset"), TB.HUMANEVAL_EXTRACT_LANGUAGE, F.col("row_language")),
                                 F.lit("."), F.lit(1)).alias("extract_language"))


# ------------------------------------------------------------------ G19
@register("notebook_cells", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS cell_idx, s[i] AS stdout, CASE WHEN i = 2 THEN 'warn' ELSE '' END AS stderr,
       1 AS n_display, CASE WHEN i = 3 THEN 1 ELSE 0 END AS n_error
FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i
      FROM (SELECT doc_id, string_split(text, '. ') AS s FROM documents))""")
def q_notebook_cells(spark, sf):
    from gavel.operators import assembly as A
    d = V.table(spark, sf, "documents")
    sents = F.split("text", r"\. ", -1)
    cells = F.transform(sents, lambda s, i: F.struct(
        s.alias("stdout"), F.when(i == 1, F.lit("warn")).otherwise(F.lit("")).alias("stderr"),
        F.array(F.create_map(F.lit("text/plain"), s)).alias("display"),
        F.when(i == 2, F.array(F.create_map(F.lit("ename"), F.lit("E")))).otherwise(
            F.array().cast("array<map<string,string>>")).alias("error")))
    c = A.explode_cells(d.select("doc_id", cells.alias("cells")), "cells", ["doc_id"])
    return c.select("doc_id", "cell_idx", "stdout", "stderr", F.size("display").alias("n_display"),
                    F.size("error").alias("n_error"))
