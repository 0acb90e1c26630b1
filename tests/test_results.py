"""Result shaping (RES1-RES10) on the fixture shapes of FIXTURES F1/F4."""


from pagewright.operators import results as R

STATS = ("struct<attempts:int,retries:int,proxies_used:array<struct<proxy:string,status_code:int,"
         "blocked:boolean,reason:string>>,fallback_fetch_used:boolean,resolved_by:string>")
SCHEMA = (f"url string, success boolean, status_code int, error_message string, redirected_url string, "
          f"redirected_status_code int, response_headers map<string,string>, crawl_stats {STATS}")


def _row(url="https://x.test/p", success=False, status=None, msg="Connection timeout", redir=None, rcode=None,
         headers=None, stats=None):
    return (url, success, status, msg, redir, rcode, headers, stats)


def _diag(spark, *rows):
    df = spark.createDataFrame(list(rows), SCHEMA)
    return [(r.t, r.lines) for r in df.select(R.failure_text(df).alias("t"),
                                              R.failure_diagnostics(df).alias("lines")).collect()]


def _attempt(blocked, reason="HTTP 429"):
    return ("p1", 429, blocked, reason)


def test_clean_and_missing_stats_are_quiet(spark):
    clean = (1, 0, [_attempt(False)], False, None)
    got = _diag(spark, _row(stats=clean), _row(stats=None))
    assert got == [("Connection timeout", []), ("Connection timeout", [])]


def test_blocked_twice_dedupes_reasons(spark):
    stats = (2, 1, [_attempt(True), _attempt(True)], False, None)
    (text, lines), = _diag(spark, _row(stats=stats))
    assert lines == ["Attempts: 2 (1 retried after a block), 2 blocked", "Blocked by: HTTP 429"]
    assert text.startswith("Connection timeout\nAttempts: 2")


def test_blocked_no_retries_and_distinct_reasons(spark):
    stats = (1, 0, [_attempt(True, "a"), _attempt(True, "b"), _attempt(True, "a")], False, None)
    (_, lines), = _diag(spark, _row(stats=stats))
    assert lines == ["Attempts: 1, 3 blocked", "Blocked by: a", "Blocked by: b"]


def test_long_reason_one_lined(spark):
    reason = "line one\n   line two " + "x" * 500
    (_, lines), = _diag(spark, _row(stats=(1, 0, [_attempt(True, reason)], False, None)))
    assert "\n" not in lines[1] and len(lines[1]) < 250 and lines[1].endswith("…")


def test_fallback_and_attempts_fallback_to_log_length(spark):
    stats = (None, 0, [_attempt(True), _attempt(False)], True, None)
    (_, lines), = _diag(spark, _row(stats=stats))
    assert lines[0] == "Attempts: 2, 1 blocked"
    assert lines[-1] == "The plain-HTTP fallback was tried and also failed."


def test_redirect_and_retry_after(spark):
    got = _diag(spark,
                _row(redir="https://x.test/login", rcode=200),
                _row(redir="https://x.test/p", rcode=301),
                _row(headers={"Retry-After": "120"}),
                _row(headers={"Content-Type": "text/html"}))
    assert got[0][1] == ["Redirected to: https://x.test/login (HTTP 200)"]
    assert got[1][1] == [] and got[3][1] == []
    assert got[2][1] == ["Retry-After: 120"]


def test_error_block_and_empty_message(spark):
    df = spark.createDataFrame([_row(msg=None, status=None)], SCHEMA)
    r = df.select(R.format_crawl_error(df).alias("b"), R.failure_text(df).alias("t")).first()
    assert r.b == "Crawl failed\nURL: https://x.test/p\nHTTP status: None\nError: None"
    assert r.t is None


def test_success_first_stable_order_and_summary(spark):
    df = spark.createDataFrame([(1, 1, False), (1, 2, True), (1, 3, False), (2, 1, True)],
                               "batch long, seq long, success boolean")
    ranked = R.success_first_rank(df, "batch", "seq")
    got = [(r.batch, r.seq, r["rank"]) for r in ranked.orderBy("batch", "rank").collect()]
    assert got == [(1, 2, 1), (1, 1, 2), (1, 3, 3), (2, 1, 1)]
    s = {r.batch: (r.crawled, r.total) for r in R.batch_summary(df, "batch").collect()}
    assert s == {1: (1, 3), 2: (1, 1)}


def test_fetch_requests_keeps_failures(spark):
    req = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    snaps = spark.createDataFrame([(1, "a", True, None)], "page_id long, url string, success boolean, error_message string")
    out = R.fetch_requests(req, snaps)
    got = sorted((r.url, r.success, r.error_message) for r in out.collect())
    assert got == [("a", True, None), ("a", True, None), ("b", False, "No snapshot for URL")]


def test_page_results_payload_flags(spark):
    from pagewright.operators.parse import html_nodes

    pages = spark.createDataFrame([(1, "https://x.test/a", "<html><head><title>A</title></head><body>"
                                    "<a href='/b'>b</a><table><tr><td>1</td></tr></table></body></html>")],
                                  "page_id long, url string, html string")
    res = spark.createDataFrame([(1, "https://x.test/a", True, 200, None, "md"),
                                 (None, "https://x.test/z", False, None, "Connection refused", None)],
                                "page_id long, url string, success boolean, status_code int, "
                                "error_message string, markdown string")
    nodes = html_nodes(pages)
    on = {r.url: r for r in R.page_results(res, nodes, include_links=True, include_tables=True).collect()}
    off = {r.url: r for r in R.page_results(res, nodes).collect()}
    ok, bad = on["https://x.test/a"], on["https://x.test/z"]
    assert ok.title == "A" and ok.markdown == "md" and len(ok.links.internal) == 1
    assert ok.tables == []                      # requested, none scored as data
    assert bad.links is None and bad.tables is None and bad.markdown is None
    assert bad.error == "Connection refused" and ok.error is None
    assert off["https://x.test/a"].links is None and off["https://x.test/a"].tables is None
    no_content = R.page_results(res, nodes, include_content=False).filter("success").first()
    assert no_content.markdown is None
