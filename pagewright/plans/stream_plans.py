"""Driver queries for Structured Streaming (STR1-STR5): each runs a file-source stream to
completion (availableNow) into a sink under the shared checkpoint folder and returns the sink.
Oracles are the batch-equivalent SQL; windowed and session results are compared for the windows
the final watermark (max event time in ms minus one minute) has closed."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.operators.patterns import BUILTIN_PATTERNS, resolve_patterns
from pagewright.plans import sqlparts as S
from pagewright.plans.activity_plans import SID_SQL, _session_id
from pagewright.plans.catalog import register
from pagewright.plans.fetch_results import FETCH_LOG_SQL
from pagewright.plans.pattern_plans import _oracle
from pagewright.sources.fetchlog import fetch_url
from pagewright.streaming import streams as ST
from pagewright.streaming.registry import registry_stream

WM_US = "((floor(epoch_us((SELECT max(ts) FROM events)) / 1000) - 60000) * 1000)"


@register("stream_results", f"""
WITH {S.ANCHORS_CTE.strip()}
SELECT p.page_id, {S.title('p.html')} AS title, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links
FROM pages p LEFT JOIN (SELECT page_id, count(*) AS n FROM links_k GROUP BY 1) l ON l.page_id = p.page_id
""")
def stream_results(spark, sf_dir):
    out = ST.page_results_stream(ST.stream_table(spark, sf_dir, "pages"))
    return out.select("page_id", "title", "n_links")


@register("stream_heartbeat", f"""
SELECT epoch_us(time_bucket(INTERVAL 15 SECOND, ts)) AS window_start_us, CAST(count(*) AS BIGINT) AS n,
       max(epoch_us(ts)) AS last_us
FROM events GROUP BY 1
HAVING epoch_us(time_bucket(INTERVAL 15 SECOND, ts)) + 15000000 <= {WM_US}
""")
def stream_heartbeat(spark, sf_dir):
    out = ST.heartbeat(ST.stream_table(spark, sf_dir, "events"))
    return out.select(F.unix_micros("window.start").alias("window_start_us"), "n",
                      F.unix_micros("last_ts").alias("last_us"))


@register("stream_dedup", f"""
WITH {FETCH_LOG_SQL.strip()}
SELECT DISTINCT url FROM fl
""")
def stream_dedup(spark, sf_dir):
    ev = ST.stream_table(spark, sf_dir, "events")
    return ST.each_url_once(ev.select(fetch_url().alias("url"), "ts")).select("url")


@register("stream_sessions", f"""
WITH e AS (
  SELECT user_id, event_id, epoch_us(ts) AS t,
         lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_t
  FROM events
),
s AS (
  SELECT *, sum(CASE WHEN prev_t IS NULL OR t - prev_t >= 1800000000 THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn
  FROM e
)
SELECT user_id, min(t) AS first_us, max(t) + 1800000000 AS end_us, CAST(count(*) AS BIGINT) AS n_events
FROM s GROUP BY user_id, sn
HAVING max(t) + 1800000000 <= {WM_US}
""")
def stream_sessions(spark, sf_dir):
    out = ST.idle_sessions(ST.stream_table(spark, sf_dir, "events"))
    return out.select("user_id", F.unix_micros("session_window.start").alias("first_us"),
                      F.unix_micros("session_window.end").alias("end_us"), "n_events")


_STREAM_SPECS = [(n, BUILTIN_PATTERNS[n]) for n in BUILTIN_PATTERNS]


@register("stream_patterns", f"SELECT doc_id, label, value FROM ({_oracle('documents', 'doc_id', 'text', _STREAM_SPECS)})")
def stream_patterns(spark, sf_dir):
    specs = resolve_patterns(spark, list(BUILTIN_PATTERNS))
    out = ST.stream_patterns(ST.stream_table(spark, sf_dir, "documents"), specs)
    return out.select("doc_id", "label", "value")


# One step per action of a session, then one at the watermark; `before`: its last use when the action comes.
TTL_US = 1_800_000_000


@register("stream_session_registry", f"""
WITH RECURSIVE wm AS (SELECT CAST({WM_US} AS BIGINT) AS us),
act AS (
  SELECT {SID_SQL} AS session_id, epoch_us(ts) AS t, event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'destroy' ELSE 'use' END AS action
  FROM events
),
due AS (
  SELECT act.* FROM act, wm WHERE t < us
  UNION ALL SELECT DISTINCT session_id, us, NULL, NULL FROM act, wm
),
seqd AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY t, action IS NULL, seq) AS i FROM due),
step(session_id, i, t, seq, action, lapsed, lives, last) AS (
  SELECT DISTINCT session_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), FALSE, CAST(NULL AS BIGINT) FROM seqd
  UNION ALL
  SELECT s.session_id, s.i, s.t, s.seq, s.action,
         CASE WHEN s.t - p.last > {TTL_US} THEN p.last + {TTL_US} END,
         coalesce(s.t - p.last <= {TTL_US}, FALSE),
         CASE WHEN s.action = 'destroy' OR s.action IS NULL THEN NULL
              WHEN s.action = 'create' AND s.t - p.last <= {TTL_US} THEN p.last ELSE s.t END
  FROM step p JOIN seqd s ON s.session_id = p.session_id AND s.i = p.i + 1
)
SELECT session_id, seq, t AS ts_us,
       CASE action WHEN 'create' THEN CASE WHEN lives THEN 'duplicate' ELSE 'created' END
                   WHEN 'destroy' THEN CASE WHEN lives THEN 'destroyed' ELSE 'not_found' END ELSE 'used' END AS decision
FROM step WHERE action IS NOT NULL
UNION ALL SELECT session_id, NULL, lapsed, 'expired' FROM step WHERE lapsed IS NOT NULL
""")
def stream_session_registry(spark, sf_dir):
    ev = ST.stream_table(spark, sf_dir, "events")
    action = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "purchase", "destroy").otherwise("use")
    return registry_stream(ev.select(_session_id().alias("session_id"), "ts", F.col("event_id").alias("seq"), action.alias("action")))
