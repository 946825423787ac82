"""Phase 7 plans: run-log windows (batch twins and live replays), endpoints, deadlines."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from gavel.operators import judging as J
from gavel.operators import metrics as M
from gavel.plans import fixtures as V
from gavel.plans import sql_views as S
from gavel.plans.registry import register, with_ctes
from gavel.streaming import live as L

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _log(spark, sf):
    return L.as_run_log(V.table(spark, sf, "events"))


def _stream_log(spark, sf):
    return L.as_run_log(L.read_run_log(spark, sf, "events.parquet"))


def _fmt(c):
    return F.date_format(c, TS_FMT)


# ------------------------------------------------------------------ S1
ERROR_RATE_SQL = f"""
SELECT strftime(time_bucket(INTERVAL '5 minutes', ts), {DUCK_TS}) AS window_start, count(*) AS n,
       count(*) FILTER (WHERE event_type = 'error') AS n_error,
       round(count(*) FILTER (WHERE event_type = 'error') / count(*), 9) AS error_rate
FROM events GROUP BY 1"""


def _error_rate_out(df):
    return df.select(_fmt("window_start").alias("window_start"), "n", "n_error",
                     F.round("error_rate", 9).alias("error_rate"))


@register("error_rate", ERROR_RATE_SQL)
def q_error_rate(spark, sf):
    return _error_rate_out(L.live_verdict_rate(_log(spark, sf)))


def _closed(sql: str, end: str, delay: str) -> str:
    """The rows of ``sql`` whose end the last watermark has passed."""
    return f"""SELECT * FROM ({sql}) WHERE strptime({end}, {DUCK_TS}) <= (SELECT max(ts) FROM events) - INTERVAL '{delay}'"""


@register("live_error_rate", _closed(ERROR_RATE_SQL, "window_start", "15 minutes"))
def q_live_error_rate(spark, sf):
    return _error_rate_out(L.run_to_table(L.live_verdict_rate(_stream_log(spark, sf)), "live_error_rate"))


# ------------------------------------------------------------------ S3
RPM = 1
REQUEST_RATE_SQL = f"""
WITH w AS (SELECT user_id AS endpoint, time_bucket(INTERVAL '30 seconds', ts) AS ws FROM events
           UNION ALL
           SELECT user_id, time_bucket(INTERVAL '30 seconds', ts) - INTERVAL '30 seconds' FROM events)
SELECT endpoint, strftime(ws, {DUCK_TS}) AS window_start, count(*) AS n, count(*) > {RPM} AS over_limit
FROM w GROUP BY endpoint, ws"""


def _rate_out(df):
    return df.select("endpoint", _fmt("window_start").alias("window_start"), "n", "over_limit")


@register("request_rate", REQUEST_RATE_SQL)
def q_request_rate(spark, sf):
    return _rate_out(L.live_request_rate(_log(spark, sf), RPM))


@register("live_request_rate", _closed(REQUEST_RATE_SQL, "window_start", "3 minutes"))
def q_live_request_rate(spark, sf):
    return _rate_out(L.run_to_table(L.live_request_rate(_stream_log(spark, sf), RPM), "live_request_rate"))


# ------------------------------------------------------------------ S4
@register("dedupe", f"""
SELECT user_id AS endpoint, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       arg_min(event_id, ts) AS event_id, strftime(min(ts), {DUCK_TS}) AS ts
FROM events GROUP BY 1, 2""")
def q_dedupe(spark, sf):
    first = L.first_seen(_log(spark, sf).select("endpoint", "k", "event_id", "ts"), ["endpoint", "k"])
    return first.select("endpoint", "k", "event_id", _fmt("ts").alias("ts"))


@register("live_dedupe", f"""
SELECT user_id AS endpoint, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       arg_min(event_id, ts) AS event_id, strftime(min(ts), {DUCK_TS}) AS ts
FROM events GROUP BY 1, 2""")
def q_live_dedupe(spark, sf):
    out = L.run_to_table(L.live_dedupe(_stream_log(spark, sf), ["endpoint", "k"]), "live_dedupe")
    first = F.when(F.col("ts").isNotNull(), F.col("event_id"))  # no row without a time is the earliest
    return out.select("endpoint", "k", first.alias("event_id"), _fmt("ts").alias("ts"))


# ------------------------------------------------------------------ S2
@register("live_bad_cases", """
SELECT event_id, user_id AS endpoint, strftime(ts, '%Y-%m-%d') AS dt FROM events WHERE event_type = 'error'""")
def q_live_bad_cases(spark, sf):
    out = L.run_to_table(L.live_bad_cases(_stream_log(spark, sf)), "live_bad_cases")
    return out.select("event_id", "endpoint", "dt")


# ------------------------------------------------------------------ S5
SESSIONS_SQL = f"""
WITH e AS (SELECT user_id AS endpoint, ts, event_type = 'error' AS is_error,
                  lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL '30 minutes' THEN 1 ELSE 0 END)
                OVER (PARTITION BY endpoint ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT endpoint, strftime(min(ts), {DUCK_TS}) AS session_start,
       strftime(max(ts) + INTERVAL '30 minutes', {DUCK_TS}) AS session_end,
       count(*) AS n, count(*) FILTER (WHERE is_error) AS n_error
FROM s GROUP BY endpoint, sid"""


def _sessions_out(df):
    return df.select("endpoint", _fmt("session_start").alias("session_start"),
                     _fmt("session_end").alias("session_end"), "n", "n_error")


@register("sessions", SESSIONS_SQL)
def q_sessions(spark, sf):
    return _sessions_out(L.sessions(_log(spark, sf)))


# ------------------------------------------------------------------ H6 / A8
@register("endpoint_stats", """
SELECT user_id AS endpoint, count(*) FILTER (WHERE event_type <> 'error') AS completed,
       count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) AS tasks,
       round(count(*) * 100.0 / (SELECT count(*) FROM events), 9) AS percent
FROM events GROUP BY 1""")
def q_endpoint_stats(spark, sf):
    t = _log(spark, sf).select("endpoint", (~F.col("is_error")).alias("ok"))
    r = M.endpoint_stats(t)
    return r.select("endpoint", "completed", "failed", "tasks", F.round("percent", 9).alias("percent"))


@register("requests_per_endpoint", """
SELECT c_custkey AS endpoint, count(e.user_id) AS n
FROM customer LEFT JOIN events e ON c_custkey = e.user_id GROUP BY 1""")
def q_requests_per_endpoint(spark, sf):
    endpoints = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("endpoint"))
    return M.requests_per_endpoint(_log(spark, sf), endpoints)


# ------------------------------------------------------------------ G13
DEADLINE_S = 6.0


@register("deadline", with_ctes(S.RUNS) + f"""
SELECT submission_id, case_idx,
  CASE WHEN case_idx * 1.0 + execution_time > {DEADLINE_S} THEN false ELSE passed END AS passed,
  CASE WHEN case_idx * 1.0 + execution_time > {DEADLINE_S} THEN 'SandboxError' ELSE 'Finished' END AS status,
  CASE WHEN case_idx * 1.0 + execution_time > {DEADLINE_S} THEN 'Total Timeout' ELSE '' END AS message
FROM runs""")
def q_deadline(spark, sf):
    r = V.runs(spark, sf).select("submission_id", "case_idx", "passed", "execution_time",
                                 F.lit("Finished").alias("status"), F.lit("").alias("message"))
    r = r.withColumn("started", F.col("case_idx") * 1.0).withColumn("finished",
                                                                      F.col("started") + F.col("execution_time"))
    return J.apply_deadline(r, DEADLINE_S).select("submission_id", "case_idx", "passed", "status", "message")


@register("live_sessions", _closed(SESSIONS_SQL, "session_end", "1 hour"))
def q_live_sessions(spark, sf):
    return _sessions_out(L.run_to_table(L.live_sessions(_stream_log(spark, sf)), "live_sessions"))


# ------------------------------------------------------------------ S5
CASES, TOTAL_TIMEOUT_H = 4, 6


@register("live_deadline", f"""
WITH e AS (SELECT CAST(user_id AS VARCHAR) || ' ' || strftime(ts, '%Y-%m-%d') AS submission, CAST(event_id % {CASES} AS INTEGER) AS case_idx,
                  event_type <> 'error' AS passed, ts FROM events),
f AS (SELECT submission, min(ts) AS first FROM e GROUP BY 1
      HAVING min(ts) + INTERVAL '{TOTAL_TIMEOUT_H} hours' < (SELECT max(ts) FROM events) - INTERVAL '10 minutes'),
d AS (SELECT e.submission, case_idx, arg_min(passed, ts) AS passed FROM e JOIN f ON e.submission = f.submission
      WHERE ts <= first + INTERVAL '{TOTAL_TIMEOUT_H} hours' GROUP BY 1, 2),
c AS (SELECT submission, CAST(unnest(range({CASES})) AS INTEGER) AS case_idx FROM f)
SELECT c.submission, c.case_idx, coalesce(d.passed, false) AS passed, CASE WHEN d.passed IS NULL THEN 'SandboxError' ELSE 'Finished' END AS status,
       CASE WHEN d.passed IS NULL THEN 'Total Timeout' ELSE '' END AS message
FROM c LEFT JOIN d ON c.submission = d.submission AND c.case_idx = d.case_idx""")
def q_live_deadline(spark, sf):
    """A day's events of a user are a submission of four cases."""
    log = _stream_log(spark, sf).select(
        F.concat_ws(" ", F.col("endpoint").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("submission"),
        (F.col("event_id") % CASES).cast("int").alias("case_idx"), (~F.col("is_error")).alias("passed"), "ts")
    return L.run_to_table(L.live_deadline(log, CASES, timedelta(hours=TOTAL_TIMEOUT_H)), "live_deadline")
