"""Driver queries for pacing, progress and sessions (WIN1-WIN6) over ``pages`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.operators.sessions import (fetch_plan, progress, session_ledger, session_registry,
                                           session_summary, sessionize)
from pagewright.plans import sqlparts as S
from pagewright.plans.catalog import register
from pagewright.sources.tables import table

MAX_CONCURRENT = 10
DELAY_S = 0.5


@register("fetch_plan", f"""
SELECT page_id, {S.host('url')} AS host,
       CAST(row_number() OVER (PARTITION BY {S.host('url')} ORDER BY page_id) AS BIGINT) AS rn,
       CAST((row_number() OVER (PARTITION BY {S.host('url')} ORDER BY page_id) - 1) % {MAX_CONCURRENT} AS INTEGER) AS lane,
       CAST(((row_number() OVER (PARTITION BY {S.host('url')} ORDER BY page_id) - 1) // {MAX_CONCURRENT}) * {DELAY_S} AS DOUBLE) AS start_s
FROM pages
""")
def fetch_plan_q(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", U.host("url").alias("host"))
    plan = fetch_plan(pages, MAX_CONCURRENT, DELAY_S)
    return plan.select("page_id", "host", F.col("rn").cast("long").alias("rn"), "lane", "start_s")


@register("progress_running", """
SELECT user_id, event_id,
       CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS done,
       CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS total
FROM events
""")
def progress_running(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    p = progress(ev, "user_id", "ts", "event_id")
    return p.select("user_id", "event_id", F.col("done").cast("long").alias("done"),
                    F.col("total").cast("long").alias("total"))


@register("idle_sessions", """
WITH e AS (
  SELECT user_id, event_id, epoch_us(ts) AS t,
         lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_t
  FROM events
),
s AS (
  SELECT *, sum(CASE WHEN prev_t IS NULL OR t - prev_t >= 1800000000 THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no
  FROM e
)
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(t) AS first_us, max(t) AS last_us,
       max(t) + 1800000000 AS end_us, CAST(count(*) AS BIGINT) AS n_events
FROM s GROUP BY 1, 2
""")
def idle_sessions_q(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    s = session_summary(sessionize(ev, "user_id", "ts", "event_id"), "user_id", "ts")
    return s.select("user_id", F.col("session_no").cast("long").alias("session_no"), "first_us", "last_us",
                    "end_us", "n_events")


def _session_id():
    return F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"),
                    (F.get_json_object("props", "$.k").cast("int") % 16).cast("string"))


SID_SQL = "'u' || user_id || '-' || (CAST(json_extract(props, '$.k') AS INTEGER) % 16)"


@register("session_state", f"""
WITH e AS (SELECT {SID_SQL} AS session_id, event_type, epoch_us(ts) AS t FROM events),
now AS (SELECT max(t) AS now_us FROM e),
d AS (SELECT session_id, min(t) FILTER (WHERE event_type = 'signup') AS declared_us,
             max(t) FILTER (WHERE event_type <> 'signup') AS last_used_us
      FROM e GROUP BY 1)
SELECT session_id,
       CASE WHEN last_used_us IS NULL THEN 'declared'
            WHEN (now_us - last_used_us) / 1000000.0 > 1800 THEN 'expired' ELSE 'live' END AS state,
       CAST(round_even(CASE WHEN last_used_us IS NULL THEN (now_us - declared_us) ELSE (now_us - last_used_us) END
                       / 1000000.0 / 60.0, 0) AS BIGINT) AS minutes
FROM d, now
""")
def session_state(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "props",
                                               F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))
    ev = ev.withColumn("session_id", _session_id())
    now_us = ev.agg(F.max("ts_us")).first()[0]  # the clock: one scalar
    ids = ev.groupBy("session_id").agg(F.min(F.when(F.col("event_type") == "signup", F.col("ts_us"))).alias("declared_us"))
    uses = ev.filter(F.col("event_type") != "signup").select("session_id", "ts_us")
    return session_registry(ids, uses, now_us)


@register("session_ledger", f"""
WITH a AS (
  SELECT {SID_SQL} AS session_id, ts, event_id,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'destroy' ELSE 'use' END AS action
  FROM events
),
l AS (SELECT *, lag(action) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS prev FROM a),
f AS (SELECT *, prev IS NOT NULL AND prev <> 'destroy' AS alive_before FROM l)
SELECT session_id,
       CAST(count(*) FILTER (WHERE action = 'create' AND NOT alive_before) AS BIGINT) AS created,
       CAST(count(*) FILTER (WHERE action = 'create' AND alive_before) AS BIGINT) AS refused_duplicates,
       CAST(count(*) FILTER (WHERE action = 'destroy' AND alive_before) AS BIGINT) AS destroyed,
       CAST(count(*) FILTER (WHERE action = 'destroy' AND NOT alive_before) AS BIGINT) AS not_found,
       arg_max(action, (ts, event_id)) <> 'destroy' AS alive
FROM f GROUP BY 1
""")
def session_ledger_q(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "props")
    act = ev.select(_session_id().alias("session_id"), "ts", F.col("event_id").alias("seq"),
                    F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "purchase", "destroy")
                    .otherwise("use").alias("action"))
    return session_ledger(act)
