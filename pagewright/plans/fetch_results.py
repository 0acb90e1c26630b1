"""Driver queries for batch fetch and result shaping (SRC1, SRC2, RES1-RES12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.operators import results as R
from pagewright.plans.catalog import register
from pagewright.sources.fetchlog import batch_requests, fetch_log
from pagewright.sources.tables import snapshots

NL = "chr(10)"


def _one_line(x: str, limit: int = 200) -> str:
    c = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"(CASE WHEN length({c}) > {limit} THEN substr({c}, 1, {limit - 1}) || '…' ELSE {c} END)"


# The fetch log derived in SQL from events, plus its diagnostics computed row-wise in SQL.
FETCH_LOG_SQL = f"""
ev AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
fl AS (
  SELECT event_id, user_id AS batch_id, k,
         'https://u' || user_id || '.example.org/item/' || k AS url,
         event_type <> 'error' AS success,
         CASE WHEN event_type = 'error' THEN (CASE k % 3 WHEN 1 THEN 429 WHEN 2 THEN 503 END)
              WHEN event_type = 'click' AND value >= 100 THEN 404 ELSE 200 END AS status_code,
         CASE WHEN event_type = 'error' THEN (CASE k % 4 WHEN 0 THEN 'Connection timeout'
              WHEN 1 THEN 'DNS resolution failed' WHEN 2 THEN 'SSL handshake error'
              ELSE 'Blocked by anti-bot protection:' || {NL} || '  status 403' || {NL} || '  see call log' END)
         END AS error_message,
         CASE k % 5 WHEN 0 THEN 'https://u' || user_id || '.example.org/item/' || k || '/login'
                    WHEN 1 THEN 'https://u' || user_id || '.example.org/item/' || k END AS redirected_url,
         CASE WHEN k % 5 = 0 AND k % 2 = 0 THEN 302 END AS redirected_status_code,
         CASE k % 7 WHEN 0 THEN CAST(k * 10 AS VARCHAR) WHEN 1 THEN ' 60' || {NL} || ' seconds ' END AS retry_after,
         k % 6 <> 5 AS has_stats,
         CASE WHEN k % 4 = 3 THEN k % 3 ELSE 0 END AS retries,
         CASE WHEN k % 10 <> 9 THEN k % 3 + 1 END AS attempts,
         k % 8 < 2 AS fallback_used,
         k % 8 = 0 AS fallback_ok
  FROM ev
),
att AS (
  SELECT fl.event_id, r.i, (fl.k + r.i) % 2 = 0 AS blocked,
         CASE (fl.k + r.i) % 3 WHEN 0 THEN 'HTTP 429 Too Many Requests'
              WHEN 1 THEN 'Challenge page' || {NL} || '  detected after load ' || repeat('x', fl.k * 3)
              ELSE '' END AS reason
  FROM fl, range(1, fl.k % 3 + 2) r(i)
  WHERE fl.has_stats
),
att_n AS (SELECT event_id, count(*) AS n_log, count(*) FILTER (WHERE blocked) AS n_blocked FROM att GROUP BY 1),
reasons AS (
  SELECT event_id, r, row_number() OVER (PARTITION BY event_id ORDER BY first_i) AS rn
  FROM (SELECT event_id, {_one_line('reason')} AS r, min(i) AS first_i FROM att WHERE blocked GROUP BY 1, 2)
  WHERE r <> ''
),
reason_txt AS (
  SELECT event_id, string_agg('Blocked by: ' || r, {NL} ORDER BY rn) AS txt, count(*) AS n
  FROM reasons WHERE rn <= 3 GROUP BY 1
),
diag AS (
  SELECT fl.*,
    CASE WHEN redirected_url IS NOT NULL AND redirected_url <> '' AND redirected_url <> url
         THEN 'Redirected to: ' || redirected_url || coalesce(' (HTTP ' || redirected_status_code || ')', '') END AS l_redirect,
    CASE WHEN retry_after IS NOT NULL AND retry_after <> '' THEN 'Retry-After: ' || {_one_line('retry_after', 60)} END AS l_retry,
    has_stats AND (coalesce(a.n_blocked, 0) > 0 OR retries > 0) AS gated,
    'Attempts: ' || coalesce(attempts, coalesce(a.n_log, 0))
      || CASE WHEN retries > 0 THEN ' (' || retries || ' retried after a block)' ELSE '' END
      || CASE WHEN coalesce(a.n_blocked, 0) > 0 THEN ', ' || a.n_blocked || ' blocked' ELSE '' END AS l_attempts,
    rt.txt AS l_reasons, coalesce(rt.n, 0) AS n_reasons,
    CASE WHEN fallback_used THEN 'The plain-HTTP fallback was tried and '
         || CASE WHEN fallback_ok THEN 'succeeded' ELSE 'also failed' END || '.' END AS l_fallback
  FROM fl LEFT JOIN att_n a USING (event_id) LEFT JOIN reason_txt rt USING (event_id)
),
diag_txt AS (
  SELECT *, concat_ws({NL}, l_redirect, l_retry,
                     CASE WHEN gated THEN l_attempts END, CASE WHEN gated THEN l_reasons END,
                     CASE WHEN gated THEN l_fallback END) AS lines,
         (l_redirect IS NOT NULL)::INT + (l_retry IS NOT NULL)::INT
         + CASE WHEN gated THEN 1 + n_reasons + (l_fallback IS NOT NULL)::INT ELSE 0 END AS n_lines
  FROM diag
)"""


@register("failure_diagnostics", f"""
WITH {FETCH_LOG_SQL.strip()}
SELECT event_id, url,
       nullif(regexp_replace(coalesce(error_message, '') || CASE WHEN lines <> '' THEN {NL} || lines ELSE '' END,
                             '^\\s+|\\s+$', '', 'g'), '') AS error,
       CAST(n_lines AS BIGINT) AS n_lines
FROM diag_txt WHERE NOT success
""")
def failure_diagnostics(spark, sf_dir):
    fl = fetch_log(spark, sf_dir).filter(~F.col("success"))
    return fl.select("event_id", "url", R.failure_text(fl).alias("error"),
                     F.size(R.failure_diagnostics(fl)).cast("long").alias("n_lines"))


@register("error_text", f"""
WITH {FETCH_LOG_SQL.strip()}
SELECT event_id,
       'Crawl failed' || {NL} || 'URL: ' || url || {NL} || 'HTTP status: ' || coalesce(CAST(status_code AS VARCHAR), 'None')
       || {NL} || 'Error: ' || coalesce(error_message, 'None') || CASE WHEN lines <> '' THEN {NL} || lines ELSE '' END
       AS error_block
FROM diag_txt WHERE NOT success
""")
def error_text(spark, sf_dir):
    fl = fetch_log(spark, sf_dir).filter(~F.col("success"))
    return fl.select("event_id", R.format_crawl_error(fl).alias("error_block"))


@register("http_error_pages", f"""
WITH {FETCH_LOG_SQL.strip()}
SELECT {'lower(regexp_extract(url, ' + "'^https?://([^/]*)'" + ', 1))'} AS host,
       CAST(count(*) AS BIGINT) AS n_fetches,
       CAST(count(*) FILTER (WHERE success) AS BIGINT) AS n_success,
       CAST(count(*) FILTER (WHERE success AND status_code >= 400) AS BIGINT) AS n_http_error
FROM fl GROUP BY 1
""")
def http_error_pages(spark, sf_dir):
    fl = fetch_log(spark, sf_dir)
    return fl.groupBy("host").agg(
        F.count(F.lit(1)).cast("long").alias("n_fetches"),
        F.count_if("success").cast("long").alias("n_success"),
        F.count_if(F.col("success") & (F.col("status_code") >= 400)).cast("long").alias("n_http_error"))


REQUESTS_SQL = """
req AS (
  SELECT e.user_id AS batch_id, e.event_id AS seq,
         coalesce(p.url, 'https://missing.example.org/page/' || CAST(json_extract(e.props, '$.k') AS INTEGER)) AS url
  FROM events e LEFT JOIN pages p ON p.page_id = CAST(json_extract(e.props, '$.k') AS INTEGER)
  WHERE e.event_type = 'view'
),
res AS (
  SELECT r.batch_id, r.seq, r.url, p.page_id IS NOT NULL AND p.html IS NOT NULL AS success,
         CAST(length(p.html) AS BIGINT) AS content_chars,
         CASE WHEN p.page_id IS NULL THEN 'No snapshot for URL' END AS error
  FROM req r LEFT JOIN pages p ON p.url = r.url
)"""


def _batch_results(spark, sf_dir):
    snaps = snapshots(spark, sf_dir).select("page_id", "url", "success", "error_message",
                                            F.length("html").cast("long").alias("content_chars"))
    res = R.fetch_requests(batch_requests(spark, sf_dir), snaps)
    return res.select("batch_id", "seq", "url", "success", "content_chars",
                      F.col("error_message").alias("error"))


@register("fetch_batch", f"""
WITH {REQUESTS_SQL.strip()}
SELECT batch_id, CAST(row_number() OVER (PARTITION BY batch_id ORDER BY NOT success, seq) AS BIGINT) AS rank,
       url, success, content_chars, error
FROM res
""")
def fetch_batch(spark, sf_dir):
    res = R.success_first_rank(_batch_results(spark, sf_dir), "batch_id", "seq")
    return res.select("batch_id", "rank", "url", "success", "content_chars", "error")


@register("batch_summary", f"""
WITH {REQUESTS_SQL.strip()}
SELECT batch_id, CAST(count(*) FILTER (WHERE success) AS BIGINT) AS crawled, CAST(count(*) AS BIGINT) AS total
FROM res GROUP BY 1
""")
def batch_summary(spark, sf_dir):
    return R.batch_summary(_batch_results(spark, sf_dir), "batch_id")


def _single_page_sql() -> str:
    from pagewright.plans.content_plans import BLOCKS_CTE
    return f"""
WITH {REQUESTS_SQL.strip()},
{BLOCKS_CTE.strip()},
md AS (
  SELECT page_id, string_agg(md, chr(10) || chr(10) ORDER BY grp, ord) AS raw,
         coalesce(string_agg(md, chr(10) || chr(10) ORDER BY grp, ord) FILTER (WHERE kept), '') AS fit
  FROM blocks_k GROUP BY page_id
)
SELECT r.batch_id, r.seq,
       CASE WHEN r.success THEN coalesce(nullif(md.fit, ''), md.raw, '')
            ELSE 'Crawl failed' || chr(10) || 'URL: ' || r.url || chr(10) || 'HTTP status: None' || chr(10)
                 || 'Error: ' || r.error END AS text
FROM res r LEFT JOIN pages p ON p.url = r.url LEFT JOIN md ON md.page_id = p.page_id
"""


def single_page(spark, sf_dir):
    """SRC2: per request, the page's markdown (fit, else raw) or the formatted error block.

    Only the requested pages are parsed (semi-join before the Python stage).
    """
    from pagewright.operators.blocks import density_prune, fit_or_raw, page_blocks, page_markdown_fit_raw
    from pagewright.operators.parse import html_nodes
    from pagewright.sources.tables import table

    req = batch_requests(spark, sf_dir)
    pages = table(spark, sf_dir, "pages")
    wanted = pages.join(req.select("url").distinct(), "url", "left_semi")
    md = page_markdown_fit_raw(density_prune(page_blocks(html_nodes(wanted, container_text=False))))
    snaps = snapshots(spark, sf_dir).select("page_id", "url", "success", "error_message", "status_code")
    res = R.fetch_requests(req, snaps).join(md, "page_id", "left")
    for c, t in (("redirected_url", "string"), ("redirected_status_code", "int"),
                 ("response_headers", "map<string,string>"), ("crawl_stats", R.STATS_TYPE)):
        res = res.withColumn(c, F.lit(None).cast(t))
    content = fit_or_raw(F.coalesce("fit", F.lit("")), F.col("raw"))
    return res.select("batch_id", "seq", F.when(F.col("success"), content)
                      .otherwise(R.format_crawl_error(res)).alias("text"))


register("single_page", _single_page_sql())(single_page)


def _page_results_sql() -> str:
    from pagewright.plans import sqlparts as S
    from pagewright.plans.content_plans import BLOCKS_CTE
    return f"""
WITH {REQUESTS_SQL.strip()},
{BLOCKS_CTE.strip()},
{S.ANCHORS_CTE.strip()},
md AS (
  SELECT page_id, string_agg(md, chr(10) || chr(10) ORDER BY grp, ord) AS raw,
         coalesce(string_agg(md, chr(10) || chr(10) ORDER BY grp, ord) FILTER (WHERE kept), '') AS fit
  FROM blocks_k GROUP BY page_id
),
lk AS (SELECT page_id, count(*) FILTER (WHERE kind = 'internal') AS n_int,
              count(*) FILTER (WHERE kind = 'external') AS n_ext FROM links_k GROUP BY 1)
SELECT r.batch_id, CAST(row_number() OVER (PARTITION BY r.batch_id ORDER BY NOT r.success, r.seq) AS BIGINT) AS rank,
       r.url, r.success, CASE WHEN r.success THEN {S.title('p.html')} END AS title,
       CAST(length(CASE WHEN r.success THEN coalesce(nullif(md.fit, ''), md.raw, '') END) AS BIGINT) AS markdown_chars,
       CASE WHEN NOT r.success THEN r.error END AS error,
       CAST(CASE WHEN r.success THEN coalesce(lk.n_int, 0) END AS BIGINT) AS n_internal,
       CAST(CASE WHEN r.success THEN coalesce(lk.n_ext, 0) END AS BIGINT) AS n_external,
       CAST(CASE WHEN r.success THEN 0 END AS BIGINT) AS n_tables
FROM res r LEFT JOIN pages p ON p.url = r.url LEFT JOIN md ON md.page_id = p.page_id
     LEFT JOIN lk ON lk.page_id = p.page_id
"""


def page_results_q(spark, sf_dir):
    """PageResult rows for a batch crawl with links and tables requested (SRC1, PRJ1, PRJ5, PRJ13,
    RES1, RES3); only the requested pages are parsed."""
    from pagewright.operators.blocks import density_prune, fit_or_raw, page_blocks, page_markdown_fit_raw
    from pagewright.operators.parse import parsed_nodes
    from pagewright.sources.tables import table

    req = batch_requests(spark, sf_dir)
    pages = table(spark, sf_dir, "pages")
    wanted = pages.join(req.select("url").distinct(), "url", "left_semi")
    nodes = parsed_nodes(wanted, container_text=False)
    md = page_markdown_fit_raw(density_prune(page_blocks(nodes)))
    snaps = snapshots(spark, sf_dir).select("page_id", "url", "success", "error_message", "status_code")
    res = R.fetch_requests(req, snaps).join(md, "page_id", "left") \
        .withColumn("markdown", fit_or_raw(F.coalesce("fit", F.lit("")), F.col("raw")))
    res = R.success_first_rank(res, "batch_id", "seq")
    out = R.page_results(res, nodes, include_links=True, include_tables=True)
    return out.select("batch_id", "rank", "url", "success", "title",
                      F.length("markdown").cast("long").alias("markdown_chars"), "error",
                      F.size("links.internal").cast("long").alias("n_internal"),
                      F.size("links.external").cast("long").alias("n_external"),
                      F.size("tables").cast("long").alias("n_tables"))


register("page_results", _page_results_sql())(page_results_q)
