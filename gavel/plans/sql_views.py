"""The fixture views of ``fixtures.py`` as DuckDB CTEs, for the oracle SQL."""

from __future__ import annotations

from gavel.functions.text import PY_WHITESPACE


def sql_chars(chars: str) -> str:
    """A string literal built with chr() so control characters survive any client."""
    return "(" + " || ".join(f"chr({ord(ch)})" for ch in chars) + ")"


WS = sql_chars(PY_WHITESPACE)


def py_strip_sql(x: str) -> str:
    return f"trim({x}, {WS})"


SAMPLES_ALL = """
samples AS (
  SELECT l_partkey AS problem_id, p_brand AS category, split_part(p_type, ' ', 1) AS dataset,
         CAST(row_number() OVER (PARTITION BY l_partkey
              ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS sample_idx,
         l_returnflag <> 'R' AS accepted
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""

RUNS = """
runs0 AS (
  SELECT l_orderkey AS submission_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS case_idx,
         l_partkey % 7 <> 0 AS passed,
         'Finished' AS compile_state,
         CASE WHEN l_partkey % 31 = 0 THEN 1 ELSE 0 END AS compile_return_code,
         CASE WHEN l_partkey % 31 = 0 THEN 'compile error' ELSE '' END AS compile_stderr,
         CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 23 = 0 THEN 'TimeLimitExceeded'
              WHEN l_partkey % 29 = 0 THEN 'Error' ELSE 'Finished' END AS run_state,
         l_partkey, l_quantity
  FROM lineitem),
runs AS (
  SELECT submission_id, case_idx, passed, compile_state, compile_return_code, compile_stderr, run_state,
         CASE WHEN run_state = 'Finished' THEN (CASE WHEN l_partkey % 17 = 0 THEN 1 ELSE 0 END) END AS return_code,
         CASE WHEN run_state = 'Error' THEN 'runner lost part ' || CAST(l_partkey AS VARCHAR) ELSE '' END AS run_stderr,
         l_quantity / 10 AS execution_time
  FROM runs0)
"""

RUN_STATUS = """
runs_st AS (
  SELECT *,
    CASE WHEN compile_state = 'Error' THEN 'SandboxError' WHEN run_state = 'Error' THEN 'SandboxError'
         WHEN compile_state = 'TimeLimitExceeded' OR run_state = 'TimeLimitExceeded' THEN 'Failed'
         WHEN coalesce(compile_return_code, 0) <> 0 OR coalesce(return_code, 0) <> 0 THEN 'Failed'
         ELSE 'Success' END AS status,
    CASE WHEN compile_state = 'Error' THEN coalesce(compile_stderr, '')
         WHEN run_state = 'Error' THEN coalesce(run_stderr, '') ELSE '' END AS message
  FROM runs)
"""

RUN_SUMMARY = """
runs_sum AS (
  SELECT *,
    CASE WHEN compile_state IS NULL AND run_state IS NULL THEN
           (CASE WHEN status = 'Success' THEN 'Success' WHEN status = 'Failed' THEN 'Failed' ELSE 'Invalid' END)
         WHEN run_state IS NULL THEN
           (CASE WHEN compile_state = 'TimeLimitExceeded' THEN 'CompileTimeout'
                 WHEN compile_return_code IS NULL THEN 'Invalid'
                 WHEN compile_return_code <> 0 THEN 'CompileFailed' ELSE 'Invalid' END)
         WHEN run_state = 'TimeLimitExceeded' THEN 'RunTimeout'
         WHEN return_code IS NULL THEN 'Invalid'
         WHEN return_code <> 0 THEN 'RunFailed'
         ELSE 'Success' END AS summary
  FROM runs_st)
"""

SUBMISSIONS = """
subs AS (SELECT o_orderkey AS submission_id, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders)
"""

CUT = """
ff AS (SELECT submission_id, min(case_idx) AS first_fail FROM runs WHERE NOT passed GROUP BY 1),
kept AS (SELECT r.* FROM runs r LEFT JOIN ff USING (submission_id)
         WHERE ff.first_fail IS NULL OR r.case_idx <= ff.first_fail)
"""


def completions_sql() -> str:
    return r"""
completions AS (
  SELECT doc_id, lang,
    (CASE WHEN doc_id % 5 = 0 THEN 'think ' || chr(10) || '</think>' || chr(10) ELSE '' END) ||
    (CASE WHEN doc_id % 13 = 0 THEN 'def f(): ' || text
          WHEN doc_id % 11 = 0 THEN '```python' || chr(10) || text
          ELSE 'pre' || chr(10) || '```' ||
               (CASE doc_id % 4 WHEN 0 THEN 'python' WHEN 1 THEN 'js' WHEN 2 THEN 'c++' ELSE '' END) ||
               chr(10) || text || chr(10) || '```' || chr(10) || 'post' ||
               (CASE WHEN doc_id % 3 = 0 THEN chr(10) || '```py' || chr(10) || 'x=' || CAST(doc_id AS VARCHAR)
                     || chr(10) || '```' ELSE '' END)
     END) AS completion
  FROM documents)
"""


STDOUT_PAIRS = r"""
pairs AS (
  SELECT doc_id AS case_id, text AS expected,
    CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN lower(text) WHEN 2 THEN text || chr(10) || 'extra line'
         WHEN 3 THEN 'x' || text ELSE chr(10) || text || '  ' END AS actual,
    'Success' AS status
  FROM documents)
"""

NUMERIC_PAIRS = r"""
npairs AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS expected,
    CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,4)) +
      (CASE l_partkey % 4 WHEN 0 THEN CAST(0 AS DECIMAL(18,4)) WHEN 1 THEN CAST(0.01 AS DECIMAL(18,4))
            WHEN 2 THEN CAST(10 AS DECIMAL(18,4)) ELSE CAST(0.0001 AS DECIMAL(18,4)) END) AS DECIMAL(18,4)) AS VARCHAR)
      AS actual,
    'Success' AS status
  FROM lineitem)
"""
