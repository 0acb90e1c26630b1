"""Crawls over random graphs with cycles, shared children and failed pages, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from pagewright.operators import traverse
from pagewright.operators.traverse import NO_KEYWORDS_NOTE, CrawlSpec, crawl, ranking_note
from pagewright.session import bucketed

WORDS = ["docs", "api", "news", "x"]


def _graph(seed, n=60):
    rnd = random.Random(seed)
    urls = [f"https://h{k % 3}.test/{rnd.choice(WORDS)}/{rnd.choice(WORDS)}/{k}" for k in range(n)]
    edges = [(a, rnd.choice(urls), pos) for a in urls for pos in range(rnd.randint(0, 4))]
    return urls, edges + edges[:5], {u: rnd.random() > 0.15 or u == urls[0] for u in urls[:-4]}  # the last ones have no snapshot


def _brute(urls, edges, ok, max_depth, band):
    """Every round takes all waiting pages of the best band; one parent each, by the least key."""
    domain = lambda u: u.split("/")[2]
    found, waiting = {urls[0]: (0, None, ())}, {urls[0]}
    while waiting:
        best = max(map(band, waiting))
        taken = {u for u in waiting if band(u) == best}
        waiting -= taken
        new = {}
        for a, b, pos in edges:
            if a in taken and ok.get(a, False) and found[a][0] < max_depth and b not in found:
                entry = ((*found[a][2], int(domain(a) != domain(b)), pos), found[a][0] + 1, a)
                new[b] = min(new.get(b, entry), entry)
        found.update({u: (depth, parent, key) for u, (key, depth, parent) in new.items()})
        waiting |= set(new)
    return {u: (depth, parent, ok.get(u, False)) for u, (depth, parent, _) in found.items()}


def _crawl(spark, urls, edges, ok, **kw):
    e = spark.createDataFrame(edges, "src string, dst string, pos int")
    s = spark.createDataFrame(list(ok.items()), "url string, success boolean")
    rows = crawl(spark, e, s, CrawlSpec(urls[0], scope="any", max_pages=None, **kw)).collect()
    assert len({r.url for r in rows}) == len(rows)
    return rows


@pytest.mark.parametrize("seed,max_depth", [(1, 30), (2, 3)])
def test_breadth_first(spark, seed, max_depth):
    urls, edges, ok = _graph(seed)
    got = _crawl(spark, urls, edges, ok, max_depth=max_depth)
    assert {r.url: (r.depth, r.parent_url, r.success) for r in got} == _brute(urls, edges, ok, max_depth, lambda u: 0)


@pytest.mark.parametrize("seed,max_depth,keywords", [(3, 30, ["docs", "API"]), (4, 7, ["docs", "api", "news"]), (5, 30, [])])
def test_best_first_over_the_whole_graph(spark, seed, max_depth, keywords):
    urls, edges, ok = _graph(seed)
    low = {k.lower() for k in keywords}
    got = _crawl(spark, urls, edges, ok, max_depth=max_depth, strategy="best-first", relevance_keywords=keywords)
    want = _brute(urls, edges, ok, max_depth, lambda u: sum(k in u for k in low))
    assert {r.url: (r.depth, r.parent_url, r.success) for r in got} == want and len(want) > 15
    assert all(abs(r.score - sum(k in r.url for k in low) / (len(low) or 1)) < 1e-12 for r in got)


def test_notes():
    assert ranking_note(CrawlSpec("u", strategy="best-first")) == NO_KEYWORDS_NOTE
    assert ranking_note(CrawlSpec("u", strategy="best-first", relevance_keywords=[""])) == NO_KEYWORDS_NOTE
    assert ranking_note(CrawlSpec("u", strategy="best-first", relevance_keywords=["a"])) is None
    assert ranking_note(CrawlSpec("u")) is None


def test_a_level_does_not_move_the_edges(spark):
    """The plan of a level reads the edges and the pages found in their buckets: no exchange above those scans."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        urls, edges, ok = _graph(6)
        links = bucketed(spark.createDataFrame(edges, "src string, dst string, pos int"), "edges", "src")
        queue = traverse._Queue(spark, 1)
        queue.add(spark.createDataFrame([(urls[0], 0, None, [], True)], "url string, depth int, parent_url string, key array<int>, success boolean"), 0, F.lit(0))
        level = traverse._expand(queue.best(), links.rows(), CrawlSpec(urls[0], scope="any"), queue.table.rows().select("url"))
        plan = level._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for i, line in enumerate(lines):
        if "FileScan" in line:
            assert "Bucketed: true" in line
            above, at = [], depth(line)
            for up in reversed(lines[:i]):
                if depth(up) < at:
                    at = depth(up)
                    above.append(up)
            nearest_join = next(k for k, up in enumerate(above) if "Join" in up)
            assert not any("Exchange" in up for up in above[:nearest_join]), line
    links.closed()
