"""Result shaping (RES1-RES15, SRC1, SRC2): failure diagnostics, error text, ordering, summaries.

All diagnostics are native higher-order-function expressions over the snapshot row; no UDFs.
Input columns used: ``url, success, status_code, error_message, redirected_url,
redirected_status_code, response_headers map<string,string>, crawl_stats struct<attempts,
retries, proxies_used array<struct<proxy,status_code,blocked,reason>>, fallback_fetch_used,
resolved_by>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.text import one_line, strip
from pagewright.operators import prefix

# Message formats of the diagnostics.
REDIRECT_FMT = "Redirected to: "
RETRY_AFTER_FMT = "Retry-After: "
ATTEMPTS_FMT = "Attempts: "
BLOCKED_BY_FMT = "Blocked by: "
FALLBACK_FMT = "The plain-HTTP fallback was tried and "
MISSING_SNAPSHOT = "No snapshot for URL"
STATS_TYPE = ("struct<attempts:int,retries:int,proxies_used:array<struct<proxy:string,status_code:int,"
              "blocked:boolean,reason:string>>,fallback_fetch_used:boolean,resolved_by:string>")


def redirect_line(url: Column, redirected: Column, code: Column) -> Column:
    """RES4: only when redirected_url is non-empty and differs from the requested URL."""
    suffix = F.when(code.isNotNull(), F.concat(F.lit(" (HTTP "), code.cast("string"), F.lit(")"))) \
        .otherwise(F.lit(""))
    return F.when(redirected.isNotNull() & (redirected != "") & (redirected != url),
                  F.concat(F.lit(REDIRECT_FMT), redirected, suffix))


def retry_after_line(headers: Column) -> Column:
    """RES5: first header whose lower-cased name is retry-after, one-lined to 60."""
    hits = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == "retry-after")
    value = F.try_element_at(hits, F.lit(1))["value"]
    return F.when(value.isNotNull() & (value != ""), F.concat(F.lit(RETRY_AFTER_FMT), one_line(value, 60)))


def stats_lines(stats: Column) -> Column:
    """RES6-RES8 as an array of lines (empty when quiet)."""
    log = F.coalesce(stats["proxies_used"], F.array().cast(
        "array<struct<proxy:string,status_code:int,blocked:boolean,reason:string>>"))
    blocked = F.filter(log, lambda a: F.coalesce(a["blocked"], F.lit(False)))
    retries = F.coalesce(stats["retries"], F.lit(0))
    total = F.coalesce(stats["attempts"], F.size(log))
    n_blocked = F.size(blocked)
    detail = F.concat(
        F.lit(ATTEMPTS_FMT), total.cast("string"),
        F.when(retries > 0, F.concat(F.lit(" ("), retries.cast("string"), F.lit(" retried after a block)")))
        .otherwise(F.lit("")),
        F.when(n_blocked > 0, F.concat(F.lit(", "), n_blocked.cast("string"), F.lit(" blocked")))
        .otherwise(F.lit("")))
    reasons = F.slice(F.array_distinct(F.filter(
        F.transform(blocked, lambda a: one_line(F.coalesce(a["reason"], F.lit("")))),
        lambda r: r != "")), 1, 3)
    reason_lines = F.transform(reasons, lambda r: F.concat(F.lit(BLOCKED_BY_FMT), r))
    outcome = F.when(stats["resolved_by"] == "fallback_fetch", F.lit("succeeded")).otherwise(F.lit("also failed"))
    fallback = F.when(F.coalesce(stats["fallback_fetch_used"], F.lit(False)),
                      F.array(F.concat(F.lit(FALLBACK_FMT), outcome, F.lit("."))))\
        .otherwise(F.array().cast("array<string>"))
    gated = (n_blocked > 0) | (retries > 0)
    return F.when(stats.isNotNull() & gated, F.concat(F.array(detail), reason_lines, fallback)) \
        .otherwise(F.array().cast("array<string>"))


def failure_diagnostics(df: DataFrame) -> Column:
    """RES4-RES8: array of diagnostic lines, in the fixed order redirect, retry-after, stats."""
    first = F.filter(F.array(
        redirect_line(F.col("url"), F.col("redirected_url"), F.col("redirected_status_code")),
        retry_after_line(F.col("response_headers"))), lambda x: x.isNotNull())
    return F.concat(first, stats_lines(F.col("crawl_stats")))


def failure_text(df: DataFrame) -> Column:
    """RES3: message + diagnostics joined by newline, stripped, NULL when empty."""
    joined = F.array_join(F.concat(F.array(F.coalesce(F.col("error_message"), F.lit(""))),
                                   failure_diagnostics(df)), "\n")
    t = strip(joined)
    return F.when(t == "", F.lit(None)).otherwise(t)


def format_crawl_error(df: DataFrame) -> Column:
    """RES10: the four fixed lines plus diagnostics (NULL values print as 'None')."""
    head = F.array(
        F.lit("Crawl failed"),
        F.concat(F.lit("URL: "), F.col("url")),
        F.concat(F.lit("HTTP status: "), F.coalesce(F.col("status_code").cast("string"), F.lit("None"))),
        F.concat(F.lit("Error: "), F.coalesce(F.col("error_message"), F.lit("None"))))
    return F.array_join(F.concat(head, failure_diagnostics(df)), "\n")


def success_first_rank(df: DataFrame, batch_col: str, seq_col: str, out: str = "rank") -> DataFrame:
    """RES1: stable success-first position within each batch (skew-safe, exact)."""
    failed = (~F.col("success")).cast("int")
    return prefix.row_number(df, [batch_col], [failed, seq_col], out=out)


def batch_summary(df: DataFrame, batch_col: str) -> DataFrame:
    """RES2: crawled = successes, total = attempts."""
    return df.groupBy(batch_col).agg(
        F.count_if(F.col("success")).cast("long").alias("crawled"),
        F.count(F.lit(1)).cast("long").alias("total"))


def fetch_requests(requests: DataFrame, snapshots: DataFrame) -> DataFrame:
    """SRC1: every request yields one row; a URL without a snapshot is a failure row.

    Duplicate snapshot URLs would multiply requests, so snapshots are reduced to one row per
    URL first (the latest ``page_id`` wins) - after a semi-join to the requested URLs, so only
    requested snapshots are shuffled (a small request set is broadcast by AQE).
    """
    wanted = requests.select("url").distinct()
    snap = snapshots.join(wanted, "url", "left_semi")
    snap = snap.groupBy("url").agg(F.max_by(F.struct(*[c for c in snapshots.columns if c != "url"]),
                                            "page_id").alias("s")).select("url", "s.*")
    out = requests.join(snap, "url", "left")
    return out.withColumn("success", F.coalesce(F.col("success"), F.lit(False))) \
        .withColumn("error_message", F.when(F.col("page_id").isNull(), F.lit(MISSING_SNAPSHOT))
                    .otherwise(F.col("error_message")))


def page_results(results: DataFrame, nodes: DataFrame | None = None, include_content: bool = True,
                 include_links: bool = False, include_tables: bool = False) -> DataFrame:
    """PRJ1, PRJ5, PRJ13, RES1, RES3: the per-page result shape.

    ``results`` holds one fetch outcome per row (``url, success, status_code, error_message``,
    optional ``page_id, depth, parent_url, markdown`` and diagnostic columns). ``nodes`` is the
    node table of the fetched pages. Links and tables are built only when requested (their
    branches are not planned otherwise); NULL means not requested, an empty array means
    requested and none found; failure rows always carry NULL payloads and no content.
    """
    from pagewright.operators.project import links_struct, page_links, page_metadata
    from pagewright.operators.tables import page_tables

    cols = set(results.columns)
    out = results
    for c, t in (("depth", "int"), ("parent_url", "string"), ("markdown", "string"),
                 ("redirected_url", "string"), ("redirected_status_code", "int"),
                 ("response_headers", "map<string,string>"), ("crawl_stats", STATS_TYPE)):
        if c not in cols:
            out = out.withColumn(c, F.lit(None).cast(t))
    ok = F.col("success")
    if nodes is not None:
        out = out.join(page_metadata(nodes), "page_id", "left")
    else:
        out = out.withColumn("title", F.lit(None).cast("string")).withColumn("description", F.lit(None).cast("string"))
    if include_links:
        if nodes is None:
            raise ValueError("include_links needs the node table")
        pages = results.filter(ok).select("page_id", "url").distinct()   # a page requested twice links once
        out = out.join(links_struct(page_links(nodes, pages)), "page_id", "left")
        empty = F.struct(F.array().cast("array<struct<href:string,text:string,title:string>>").alias("internal"),
                         F.array().cast("array<struct<href:string,text:string,title:string>>").alias("external"))
        out = out.withColumn("links", F.when(ok, F.coalesce("links", empty)))
    else:
        out = out.withColumn("links", F.lit(None).cast(
            "struct<internal:array<struct<href:string,text:string,title:string>>,"
            "external:array<struct<href:string,text:string,title:string>>>"))
    tbl_type = "array<struct<headers:array<string>,rows:array<array<string>>,caption:string>>"
    if include_tables:
        if nodes is None:
            raise ValueError("include_tables needs the node table")
        item = F.struct("table_no", F.struct("headers", "rows", "caption").alias("t"))
        t = page_tables(nodes).groupBy("page_id").agg(
            F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]).alias("tables"))
        out = out.join(t, "page_id", "left").withColumn(
            "tables", F.when(ok, F.coalesce("tables", F.array().cast(tbl_type))))
    else:
        out = out.withColumn("tables", F.lit(None).cast(tbl_type))
    markdown = F.when(ok & F.lit(include_content), F.coalesce("markdown", F.lit("")))
    error = F.when(~ok, failure_text(out))
    return out.select("url", "success", "status_code", F.when(ok, F.col("title")).alias("title"),
                      F.when(ok, F.col("description")).alias("description"), markdown.alias("markdown"),
                      error.alias("error"), "depth", "parent_url", "links", "tables",
                      *[c for c in ("page_id", "batch_id", "seq", "rank") if c in cols])
