"""Traversal (TRV1-TRV11, FIXTURES F7) checked against a brute-force BFS on a fixture graph."""

from collections import deque

import pytest

from pagewright.operators.traverse import CrawlSpec, crawl, keyword_score, start_note

S = "https://docs.example.com/"
EDGES = [
    (S, S + "a", 1), (S, "https://api.example.com/x", 2), (S, "https://unrelated.test/u", 3),
    (S, "https://ads.example.com/ad", 4), (S + "a", S + "b", 1), (S + "a", S, 2),          # cycle back
    (S + "b", S + "docs/c", 1), (S + "b", "https://docs.example.com/missing", 2),          # dangling
    ("https://api.example.com/x", "https://api.example.com:8080/p", 1),                    # explicit port
    ("https://unrelated.test/u", "https://unrelated.test/v", 1),
    (S + "docs/c", S + "docs/d", 1), (S + "docs/d", S + "docs/e", 1), (S + "docs/e", S + "docs/f", 1),
]
PAGES = sorted({e[0] for e in EDGES} | {e[1] for e in EDGES} - {"https://docs.example.com/missing"})


def _inputs(spark):
    edges = spark.createDataFrame(EDGES, "src string, dst string, pos int")
    snaps = spark.createDataFrame([(u, True) for u in PAGES], "url string, success boolean")
    return edges, snaps


def _brute_bfs(start, max_depth, keep):
    out, seen, q = {start: 0}, {start}, deque([start])
    while q:
        u = q.popleft()
        if out[u] >= max_depth or u not in PAGES:
            continue
        for s, d, _ in sorted((e for e in EDGES if e[0] == u), key=lambda e: e[2]):
            if d not in seen and keep(d):
                seen.add(d)
                out[d] = out[u] + 1
                q.append(d)
    return out


def _run(spark, **kw):
    edges, snaps = _inputs(spark)
    spec = CrawlSpec(start_url=S, **kw)
    return {r.url: r for r in crawl(spark, edges, snaps, spec).collect()}


def test_bfs_depth_is_shortest_path_and_dangling_is_failure(spark):
    got = _run(spark, max_depth=10, max_pages=1000, scope="any")
    want = _brute_bfs(S, 10, lambda d: True)
    assert {u: r.depth for u, r in got.items()} == want
    assert got["https://docs.example.com/missing"].success is False
    assert got[S].parent_url is None and got[S + "b"].parent_url == S + "a"


def test_same_domain_scope_includes_subdomains(spark):
    got = _run(spark, max_depth=10, max_pages=1000, scope="same-domain")
    assert "https://api.example.com/x" in got and "https://unrelated.test/u" not in got
    assert set(got) == set(_run(spark, max_depth=10, max_pages=1000, scope="same-origin"))


@pytest.mark.parametrize("n", [1, 3, 5])
def test_budget_exact_and_shallowest_first(spark, n):
    got = _run(spark, max_depth=10, max_pages=n, scope="any")
    assert len(got) == n
    assert max(r.depth for r in got.values()) <= sorted(_brute_bfs(S, 10, lambda d: True).values())[n - 1]


def test_allow_block_and_port(spark):
    got = _run(spark, max_depth=10, max_pages=1000, allowed_domains=["example.com"],
               blocked_domains=["ads.example.com"])
    assert "https://api.example.com/x" in got and "https://ads.example.com/ad" not in got
    assert "https://unrelated.test/u" not in got
    assert "https://api.example.com:8080/p" not in got          # explicit port != bare host
    only_api = _run(spark, max_depth=10, max_pages=1000, allowed_domains=["api.example.com"])
    assert set(only_api) == {S, "https://api.example.com/x"}     # start bypasses filters


def test_include_glob_and_conjunction(spark):
    got = _run(spark, max_depth=10, max_pages=1000, scope="any", include_pattern="/docs/*",
               allowed_domains=["example.com"])
    assert set(got) == {S}   # '/' of children fails the path glob, so nothing is followed


def test_start_note(spark):
    assert start_note(spark, CrawlSpec(S, allowed_domains=["github.com"])).startswith(
        S + " is outside allowed_domains")
    assert start_note(spark, CrawlSpec(S, allowed_domains=["example.com"])) is None
    assert start_note(spark, CrawlSpec(S)) is None


def test_refusals(spark):
    edges, snaps = _inputs(spark)
    with pytest.raises(ValueError, match="unknown scope 'same_domain': choose one of any, same-domain"):
        crawl(spark, edges, snaps, CrawlSpec(S, scope="same_domain"))
    with pytest.raises(ValueError, match="unknown strategy 'BFS'"):
        crawl(spark, edges, snaps, CrawlSpec(S, strategy="BFS"))


def test_best_first_prefers_relevant_pages(spark):
    got = _run(spark, max_depth=10, max_pages=4, strategy="best-first", relevance_keywords=["docs"],
               scope="any", batch_size=1)
    assert len(got) == 4
    # the 'docs' path is taken before unrelated shallow pages would be
    assert S + "a" in got or S + "docs/c" in got
    sc = spark.createDataFrame([("https://x/Docs/API",)], "u string").select(
        keyword_score(__import__("pyspark.sql.functions", fromlist=["col"]).col("u"), ["docs", "api", "zzz"])).first()[0]
    assert abs(sc - 2 / 3) < 1e-9


def _regdom(url):
    host = url.split("://", 1)[1].split("/", 1)[0].split(":")[0].lower()
    return ".".join(host.split(".")[-2:])


def _brute_best_first(keywords, max_pages, max_depth, batch):
    kws = sorted({k.lower() for k in keywords})

    def score(u):
        return sum(k in u.lower() for k in kws) / len(kws)

    def expand(rows, blocked):
        best = {}
        for url, depth, key in rows:
            if url not in PAGES:          # failed fetch: no links followed
                continue
            for s, d, pos in EDGES:
                if s == url and d not in blocked:
                    k = key + (int(_regdom(d) != _regdom(s)), pos)
                    if d not in best or k < best[d][1]:
                        best[d] = (depth + 1, k)
        return {d: (dep, k, score(d)) for d, (dep, k) in best.items()}

    crawled = {S: 0}
    pool = expand([(S, 0, ())], {S})
    while len(crawled) < max_pages and pool:
        take = min(batch, max_pages - len(crawled))
        chosen = sorted(pool.items(), key=lambda kv: (-kv[1][2], kv[1][0], kv[1][1]))[:take]
        for url, (dep, _, _) in chosen:
            crawled[url] = dep
        rest = {u: v for u, v in pool.items() if u not in crawled}
        deeper = [(u, dep, k) for u, (dep, k, _) in chosen if dep < max_depth]
        new = expand(deeper, set(crawled) | set(rest))
        pool = {**rest, **new}
    return crawled


@pytest.mark.parametrize("keywords,max_pages,max_depth,batch", [
    (["docs", "x"], 6, 10, 2), (["api", "unrelated"], 8, 10, 3), (["docs"], 9, 2, 1)])
def test_best_first_equals_brute_force(spark, keywords, max_pages, max_depth, batch):
    got = _run(spark, max_depth=max_depth, max_pages=max_pages, strategy="best-first",
               relevance_keywords=keywords, scope="any", batch_size=batch)
    want = _brute_best_first(keywords, max_pages, max_depth, batch)
    assert {u: r.depth for u, r in got.items()} == want
