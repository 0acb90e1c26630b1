"""Driver queries for link-graph traversal (TRV1-TRV11) over the derived site graph.

Oracles: the same graph derived in SQL and walked with ``WITH RECURSIVE``. The first graph is a
forest - every page has at most one in-edge - so its walk needs no visited set; the budgeted
crawl keeps the first rows by (depth, position path). The second one has cycles, shared children and
failed pages; its walks carry the visited set and the queue from one iteration to the next.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.operators.traverse import CrawlSpec, crawl, depth_summary, ranking_note
from pagewright.plans import sqlparts as S
from pagewright.plans.catalog import register
from pagewright.sources.graph import first_page_url, site_graph, web_graph, web_outcomes
from pagewright.sources.tables import snapshots, table

MAX_DEPTH = 6


def _graph_sql(filter_sql: str = "TRUE") -> str:
    return f"""
WITH RECURSIVE
pg AS (SELECT page_id, url, {S.host('url')} AS host FROM pages),
rk AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r FROM pg),
firsts AS (SELECT host, url, lead(host) OVER (ORDER BY host) AS next_host FROM rk WHERE r = 1),
edges AS (
  SELECT a.url AS src, b.url AS dst, 1 AS pos FROM rk a JOIN rk b ON a.host = b.host AND b.r = 2 * a.r
  UNION ALL SELECT a.url, b.url, 2 FROM rk a JOIN rk b ON a.host = b.host AND b.r = 2 * a.r + 1
  UNION ALL SELECT f.url, g.url, 3 FROM firsts f JOIN firsts g ON g.host = f.next_host
),
e2 AS (
  SELECT src, dst, pos,
         CASE WHEN coalesce({S.regdom(S.host('dst'))}, '') <> coalesce({S.regdom(S.host('src'))}, '') THEN 1 ELSE 0 END AS is_ext
  FROM edges
),
start AS (SELECT url FROM firsts ORDER BY host LIMIT 1),
walk(url, depth, parent_url, key) AS (
  SELECT url, 0, CAST(NULL AS VARCHAR), CAST([] AS INTEGER[]) FROM start
  UNION ALL
  SELECT e.dst, w.depth + 1, w.url, list_concat(w.key, [e.is_ext, e.pos])
  FROM walk w JOIN e2 e ON e.src = w.url
  WHERE w.depth < {MAX_DEPTH} AND ({filter_sql.replace('URL', 'e.dst')})
)"""


def _start(spark, sf_dir):
    return first_page_url(spark, sf_dir)


def _run(spark, sf_dir, **kw):
    spec = CrawlSpec(start_url=_start(spark, sf_dir), max_depth=MAX_DEPTH, **kw)
    res = crawl(spark, site_graph(spark, sf_dir), snapshots(spark, sf_dir), spec)
    return res, spec


def _out(res):
    return res.select("url", F.col("depth").cast("long").alias("depth"), "parent_url")


@register("bfs_levels", _graph_sql() + """
SELECT url, CAST(depth AS BIGINT) AS depth, parent_url FROM walk
""")
def bfs_levels(spark, sf_dir):
    res, _ = _run(spark, sf_dir, max_pages=None, scope="any")
    return _out(res)


@register("bfs_budget", _graph_sql() + """
SELECT url, CAST(depth AS BIGINT) AS depth, parent_url FROM (SELECT * FROM walk ORDER BY depth, key LIMIT 10)
""")
def bfs_budget(spark, sf_dir):
    res, _ = _run(spark, sf_dir, max_pages=10, scope="any")
    return _out(res)


@register("crawl_depth_summary", _graph_sql() + """
SELECT CAST(depth AS BIGINT) AS depth, CAST(count(*) AS BIGINT) AS pages FROM walk GROUP BY 1
""")
def crawl_depth_summary(spark, sf_dir):
    res, _ = _run(spark, sf_dir, max_pages=None, scope="any")
    return depth_summary(res).select(F.col("depth").cast("long").alias("depth"), "pages")


START_DOM = f"(SELECT {S.regdom(S.host('url'))} FROM start)"


@register("scope_filters", _graph_sql(f"{S.regdom(S.host('URL'))} = {START_DOM}") + """
SELECT url, CAST(depth AS BIGINT) AS depth, parent_url FROM walk
""")
def scope_filters(spark, sf_dir):
    res, _ = _run(spark, sf_dir, max_pages=None, scope="same-domain")
    return _out(res)


ALLOWED = ["example.org"]
BLOCKED = ["spam-farm.example.org"]


def _dk(u: str) -> str:
    return f"lower(regexp_replace(regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''))"


_DOMAIN_SQL = (f"(({_dk('URL')} = 'example.org' OR ends_with({_dk('URL')}, '.example.org')) AND NOT "
               f"({_dk('URL')} = 'spam-farm.example.org' OR ends_with({_dk('URL')}, '.spam-farm.example.org')))")


@register("domain_filters", _graph_sql(_DOMAIN_SQL) + f"""
SELECT url, CAST(depth AS BIGINT) AS depth, parent_url,
       CASE WHEN (SELECT {_DOMAIN_SQL.replace('URL', 'url')} FROM start) THEN NULL
            ELSE (SELECT url FROM start)
                 || ' is outside allowed_domains: it was read as the start, its own site''s other pages were left out.'
       END AS note
FROM walk
""")
def domain_filters(spark, sf_dir):
    from pagewright.operators.traverse import start_note
    res, spec = _run(spark, sf_dir, max_pages=None, allowed_domains=ALLOWED, blocked_domains=BLOCKED)
    note = start_note(spark, spec)
    return _out(res).withColumn("note", F.lit(note).cast("string"))


@register("glob_filters", _graph_sql("URL LIKE '%/en/%' AND NOT (URL LIKE '%page=2%')") + """
SELECT url, CAST(depth AS BIGINT) AS depth, parent_url FROM walk
""")
def glob_filters(spark, sf_dir):
    res, _ = _run(spark, sf_dir, max_pages=None, scope="any", include_pattern="*/en/*",
                  exclude_pattern="*page=2*")
    return _out(res)


def _web_sql() -> str:
    """The graph with cycles, its outcomes and its start, as tables ``edges``, ``outcome`` and ``start``."""
    return f"""
WITH RECURSIVE
pg AS (SELECT page_id, url, {S.host('url')} AS host, html IS NOT NULL AND page_id % 11 <> 7 AS success FROM pages),
rk AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r, count(*) OVER (PARTITION BY host) AS n FROM pg),
outcome AS (SELECT url, bool_or(success) AS success FROM pg GROUP BY url),
firsts AS (SELECT url, row_number() OVER (ORDER BY host) - 1 AS h, count(*) OVER () AS hosts FROM rk WHERE r = 1),
hop AS (SELECT host, url AS src, 2 * r AS t, 1 AS pos FROM rk UNION ALL SELECT host, url, 2 * r + 1, 2 FROM rk
  UNION ALL SELECT host, url, r // 2, 3 FROM rk WHERE r > 1
  UNION ALL SELECT host, url, 7 * r % n + 1, 4 FROM rk WHERE 7 * r % n + 1 <> r),
plain AS (SELECT src, rk.url AS dst, pos FROM hop JOIN rk ON rk.host = hop.host AND rk.r = hop.t
  UNION ALL SELECT f.url, g.url, 5 FROM firsts f JOIN firsts g ON g.h = (2 * f.h + 1) % f.hosts WHERE f.url <> g.url
  UNION ALL SELECT f.url, g.url, 6 FROM firsts f JOIN firsts g ON g.h = (2 * f.h + 2) % f.hosts WHERE f.url <> g.url),
edges AS (SELECT src, dst, pos, CASE WHEN coalesce({S.regdom(S.host('dst'))}, '') <> coalesce({S.regdom(S.host('src'))}, '') THEN 1 ELSE 0 END AS is_ext FROM plain),
start AS (SELECT rk.url, success FROM rk JOIN firsts ON firsts.url = rk.url WHERE h = 0 AND r = 1)"""


WEB_DEPTH = 12


def _visit_sql(take: str, band: str = "0") -> str:
    """Rounds with a visited set: each iteration carries all pages found, and adds what the ones taken link to."""
    return _web_sql() + f""",
found(it, url, depth, parent_url, key, success, band, done) AS (
  SELECT 0, url, 0, CAST(NULL AS VARCHAR), CAST([] AS BIGINT[]), success, {band.replace('URL', 'url')}, FALSE FROM start
  UNION ALL
  SELECT * FROM (
    WITH taken AS (SELECT * FROM found WHERE NOT done AND {take}),
    cand AS (SELECT e.dst AS url, t.depth + 1 AS depth, t.url AS parent_url, list_concat(t.key, [e.is_ext, e.pos]) AS key
      FROM taken t JOIN edges e ON e.src = t.url WHERE t.success AND t.depth < {WEB_DEPTH} AND e.dst NOT IN (SELECT url FROM found)),
    fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY key) AS k FROM cand) WHERE k = 1)
    SELECT it + 1, url, depth, parent_url, key, success, band, done OR url IN (SELECT url FROM taken) FROM found
    WHERE EXISTS (SELECT 1 FROM found WHERE NOT done)
    UNION ALL
    SELECT (SELECT max(it) FROM found) + 1, f.url, f.depth, f.parent_url, f.key, coalesce(o.success, FALSE), {band.replace('URL', 'f.url')}, FALSE
    FROM fresh f LEFT JOIN outcome o ON o.url = f.url)
)"""


KEYWORDS = ["en", "blog", "shop"]
_BAND = " + ".join(f"CAST(contains(lower(URL), '{k}') AS INTEGER)" for k in KEYWORDS)
_LAST = "WHERE it = (SELECT max(it) FROM found)"


def _web(spark, sf_dir, **kw):
    spec = CrawlSpec(start_url=_start(spark, sf_dir), max_depth=WEB_DEPTH, scope="any", **kw)
    return crawl(spark, web_graph(spark, sf_dir), web_outcomes(spark, sf_dir), spec), spec


@register("bfs_cyclic", _visit_sql("TRUE") + f"""
SELECT url, CAST(depth AS BIGINT) AS depth, parent_url, success FROM found {_LAST}
""")
def bfs_cyclic(spark, sf_dir):
    """Breadth-first over a graph with cycles, shared children and failed pages."""
    res, _ = _web(spark, sf_dir, max_pages=None)
    return res.select("url", F.col("depth").cast("long").alias("depth"), "parent_url", "success")


@register("best_first", _visit_sql("band = (SELECT max(band) FROM found WHERE NOT done)", _BAND) + f"""
SELECT url, CAST(depth AS BIGINT) AS depth, parent_url, round(band / {len(KEYWORDS)}.0, 6) AS score, success,
       CAST(NULL AS VARCHAR) AS note FROM found {_LAST}
""")
def best_first(spark, sf_dir):
    """Best-first over the whole graph: every round takes all waiting pages of the best score."""
    res, spec = _web(spark, sf_dir, max_pages=None, strategy="best-first", relevance_keywords=KEYWORDS)
    return res.select("url", F.col("depth").cast("long").alias("depth"), "parent_url", F.round("score", 6).alias("score"),
                      "success", F.lit(ranking_note(spec)).cast("string").alias("note"))


@register("best_first_no_keywords", _visit_sql("band = (SELECT max(band) FROM found WHERE NOT done)") + f"""
SELECT url, CAST(depth AS BIGINT) AS depth, parent_url, CAST(0 AS DOUBLE) AS score,
       'best-first has no relevance_keywords to rank pages by: every page scores alike, so the order is that of bfs.' AS note FROM found {_LAST}
""")
def best_first_no_keywords(spark, sf_dir):
    res, spec = _web(spark, sf_dir, max_pages=None, strategy="best-first")
    return res.select("url", F.col("depth").cast("long").alias("depth"), "parent_url", "score", F.lit(ranking_note(spec)).alias("note"))


@register("best_first_budget")
def best_first_budget(spark, sf_dir):
    """The page budget of a best-first crawl; its batches are verified against brute force in tests."""
    res, _ = _run(spark, sf_dir, max_pages=15, strategy="best-first", scope="any",
                  relevance_keywords=["en", "blog"])
    return res.select("url", F.col("depth").cast("long").alias("depth"), "parent_url",
                      F.round("score", 6).alias("score"))


# Suffix rules of every kind (a caller brings the whole public list as a table).
SUFFIX_RULES = ["com", "org", "net", "io", "github.io", "sg", "com.sg", "uk", "co.uk", "*.ck", "!www.ck",
                "jp", "*.kawasaki.jp", "!city.kawasaki.jp", "test", "blogspot.com"]
_HOSTS = ["foo.com.sg", "com.sg", "a.github.io", "github.io", "x.ck", "b.x.ck", "www.ck", "sub.www.ck", "ck", "shop.kawasaki.jp",
          "a.shop.kawasaki.jp", "city.kawasaki.jp", "hall.city.kawasaki.jp", "Sub.Example.CO.UK.", "10.1.2.3", "localhost", "a..b", "x.unlisted"]
_NAMED = ", ".join(f"({i}, '{h}')" for i, h in enumerate(_HOSTS))


@register("registrable_domains", f"""
WITH rules AS (SELECT unnest({SUFFIX_RULES}) AS rule),
hosts AS (
  SELECT s_suppkey AS key, CASE WHEN v.host = 'localhost' OR v.host LIKE '10.%' THEN v.host ELSE 's' || s_suppkey || '.' || v.host END AS host
  FROM supplier JOIN (VALUES {_NAMED}) v(i, host) ON v.i = s_suppkey % {len(_HOSTS)}
  UNION ALL SELECT -1 - v.i, v.host FROM (VALUES {_NAMED}) v(i, host)
  UNION ALL SELECT 1000000 + page_id, {S.host('url')} FROM pages),
lab AS (SELECT key, host, rtrim(lower(host), '.') AS h, string_split(rtrim(lower(host), '.'), '.') AS l FROM hosts),
ok AS (SELECT *, list_contains(l, '') OR regexp_full_match(h, '[0-9]+([.][0-9]+){{3}}') AS bad FROM lab),
ends AS (SELECT key, len(l) AS m, unnest(range(1, len(l) + 1)) AS n, l FROM ok WHERE NOT bad),
hit AS (SELECT key, max(n - 1) FILTER (WHERE rule = '!' || array_to_string(l[m - n + 1:], '.')) AS exc,
    max(n) FILTER (WHERE rule = array_to_string(l[m - n + 1:], '.') OR n > 1 AND rule = '*.' || array_to_string(l[m - n + 2:], '.')) AS ruled
  FROM ends LEFT JOIN rules ON rule IN ('!' || array_to_string(l[m - n + 1:], '.'), array_to_string(l[m - n + 1:], '.'), '*.' || array_to_string(l[m - n + 2:], '.'))
  GROUP BY key),
s AS (SELECT ok.key, host, h, l, bad, CASE WHEN NOT bad THEN coalesce(exc, ruled, 1) END AS k FROM ok LEFT JOIN hit ON hit.key = ok.key)
SELECT key, host, CASE WHEN NOT bad THEN array_to_string(l[len(l) - k + 1:], '.') END AS public_suffix,
  CASE WHEN NOT bad AND len(l) > k THEN array_to_string(l[len(l) - k:], '.')
       WHEN bad AND NOT list_contains(l, '') THEN h END AS registrable
FROM s
""")
def registrable_domains(spark, sf_dir):
    """Longest match in a suffix table with wildcards and exceptions."""
    from pagewright.operators.domains import with_registrable
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    named = F.element_at(F.array(*[F.lit(h) for h in _HOSTS]), (F.col("s_suppkey") % len(_HOSTS) + 1).cast("int"))
    hosts = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.when(
        (named == "localhost") | named.startswith("10."), named).otherwise(F.concat(F.lit("s"), "s_suppkey", F.lit("."), named)).alias("host"))
    hosts = hosts.unionByName(spark.createDataFrame([(-1 - i, h) for i, h in enumerate(_HOSTS)], "key long, host string"))
    hosts = hosts.unionByName(table(spark, sf_dir, "pages").select((F.col("page_id") + 1000000).alias("key"), U.host("url").alias("host")))
    return with_registrable(hosts, F.col("host"), rules)
