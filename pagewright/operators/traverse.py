"""Link-graph traversal (TRV1-TRV11): breadth-first and best-first crawls as iterative joins.

The edges and the fetch outcomes are written once, hash-bucketed by the URL that the joins use. The
pages found so far are a third bucketed table, which is visited set and queue at once: its folders
are ``(band, round)``, the score band of a page and the round that found it. A round takes all rows
of the best band that no round has taken (breadth-first: one band, so the last level), joins them
with the edges bucket by bucket, and what moves is only the new links on their way to the bucket of
their target, where the ``left_anti`` join with the pages found, one parent per new URL (``min_by`` on the
order key) and the join with the fetch outcomes follow in place. A round is one job, which appends
its rows and counts them by band (``observe``); the driver holds those counts only. The queue is
never rewritten, and a lost executor reads the rounds so far from the table.

Frontier order (TRV10) is a lexicographic array key: parent key ++ [is_external, pos], so
"internal before external, then page order" holds level by level without any global window.
Budget (TRV2): the frontier is cut to the remaining success budget by key order; the final
result is sorted by (depth, key) and cut to ``max_pages`` rows so the shallowest survive. A
best-first crawl with a budget takes ``batch_size`` pages a round, best score first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.functions.validate import check_choice
from pagewright.operators.ranking import top_k
from pagewright.session import BucketedTable, bucketed, cut_lineage

SCOPES = ["same-domain", "same-origin", "any"]
STRATEGIES = ["bfs", "best-first"]
NO_KEYWORDS_NOTE = "best-first has no relevance_keywords to rank pages by: every page scores alike, so the order is that of bfs."
START_NOTE_FMT = "{url} is outside allowed_domains: it was read as the start, its own site's other pages were left out."


@dataclass
class CrawlSpec:
    start_url: str
    max_depth: int = 3
    max_pages: int | None = 100  # None: no page budget
    scope: str = "same-domain"
    strategy: str = "bfs"
    relevance_keywords: list[str] | None = None
    include_pattern: str | None = None
    exclude_pattern: str | None = None
    allowed_domains: list[str] | None = None
    blocked_domains: list[str] | None = None
    batch_size: int = 10

    def validate(self) -> None:
        check_choice("scope", self.scope, SCOPES)          # exact match, not normalised
        check_choice("strategy", self.strategy, STRATEGIES)
        if (self.max_pages is not None and self.max_pages < 1) or self.max_depth < 0:
            raise ValueError("max_pages must be >= 1 and max_depth >= 0")


def _domain_key(url: Column) -> Column:
    """Lower-cased netloc without userinfo (keeps an explicit port, so it won't match a bare host)."""
    return F.lower(F.regexp_replace(U.netloc(url), r"^.*@", ""))


def link_filter(spec: CrawlSpec, dst: Column) -> Column:
    """TRV4-TRV8: scope (unless an allow-list widens the pool), globs, allow/block lists; AND-ed."""
    preds: list[Column] = []
    include_external = spec.scope == "any" or bool(spec.allowed_domains)
    if not include_external:
        start_dom = U.registrable_domain(U.host(F.lit(spec.start_url)))
        preds.append(U.registrable_domain(U.host(dst)) == start_dom)
    if spec.include_pattern is not None:
        preds.append(U.glob_match(dst, spec.include_pattern))
    if spec.exclude_pattern is not None:
        preds.append(~U.glob_match(dst, spec.exclude_pattern))
    if spec.allowed_domains:
        preds.append(U.domain_matches(_domain_key(dst), spec.allowed_domains))
    if spec.blocked_domains:
        preds.append(~U.domain_matches(_domain_key(dst), spec.blocked_domains))
    out = F.lit(True)
    for p in preds:
        out = out & F.coalesce(p, F.lit(False))
    return out


def start_note(spark: SparkSession, spec: CrawlSpec) -> str | None:
    """TRV9: note when the allow/block lists would reject the start URL (allow-list present)."""
    if not spec.allowed_domains:
        return None
    ok = F.lit(True)
    dk = _domain_key(F.lit(spec.start_url))
    ok = ok & U.domain_matches(dk, spec.allowed_domains)
    if spec.blocked_domains:
        ok = ok & ~U.domain_matches(dk, spec.blocked_domains)
    accepted = spark.range(1).select(ok.alias("ok")).first()[0]
    return None if accepted else START_NOTE_FMT.format(url=spec.start_url)


def ranking_note(spec: CrawlSpec) -> str | None:
    """Note when a best-first crawl has nothing to rank by."""
    return NO_KEYWORDS_NOTE if spec.strategy == "best-first" and not _keywords(spec.relevance_keywords) else None


def _keywords(keywords: list[str] | None) -> list[str]:
    return sorted({k.lower() for k in (keywords or []) if k})


def keyword_score(url: Column, keywords: list[str] | None) -> Column:
    """2.13-e: fraction of distinct lower-cased keywords occurring in lower(url)."""
    kws = _keywords(keywords)
    return (keyword_hits(url, keywords) / F.lit(float(len(kws) or 1))).cast("double")


def keyword_hits(url: Column, keywords: list[str] | None) -> Column:
    """The score band of a URL: how many of the distinct keywords it holds."""
    kws = _keywords(keywords)
    if not kws:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(k) for k in kws]), lambda k: F.lower(url).contains(k))), F.lit(0))


def _fetch(level: DataFrame, snapshots: DataFrame) -> DataFrame:
    snap = snapshots.select(F.col("url").alias("_u"), F.col("success").alias("_s"))
    return snap.join(level, level["url"] == snap["_u"], "right") \
        .withColumn("success", F.coalesce(F.col("_s"), F.lit(False))).drop("_u", "_s")


def _expand(frontier: DataFrame, edges: DataFrame, spec: CrawlSpec, visited: DataFrame) -> DataFrame:
    """Candidates one hop from the successful frontier, filtered, unvisited, one parent each."""
    src = frontier.filter("success").select(F.col("url").alias("src"), F.col("key").alias("pkey"), "depth")
    e = edges.select("src", "dst", "pos")
    cand = e.join(src, "src")
    is_ext = (F.coalesce(U.registrable_domain(U.host(F.col("dst"))), F.lit("")) !=
              F.coalesce(U.registrable_domain(U.host(F.col("src"))), F.lit(""))).cast("int")
    cand = cand.filter(link_filter(spec, F.col("dst"))).select(
        F.col("dst").alias("url"), F.col("src").alias("parent_url"), (F.col("depth") + 1).alias("depth"),
        F.concat("pkey", F.array(is_ext, F.col("pos").cast("int"))).alias("key"))
    cand = cand.join(visited, "url", "left_anti")
    best = cand.groupBy("url").agg(F.min_by(F.struct("parent_url", "depth", "key"), "key").alias("b"))
    return best.select("url", "b.parent_url", "b.depth", "b.key")


class _Queue:
    """Pages found, in folders by score band and round: visited set, bucket queue and result."""

    def __init__(self, spark: SparkSession, bands: int):
        self.table = BucketedTable(spark, "crawled", "url", ("band", "round"))
        self.bands, self.waiting = bands, {}

    def add(self, pages: DataFrame, round_: int, band: Column) -> tuple[int, int]:
        """Append the pages a round has found: ``(rows, successes)``, from the write itself."""
        seen = Observation()
        pages = pages.select("url", "depth", "parent_url", "key", "success", band.cast("int").alias("band"), F.lit(round_).alias("round"))
        pages = pages.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("success").alias("ok"),
                              *[F.count_if(F.col("band") == b).alias(f"b{b}") for b in range(self.bands)])
        self.table.append(pages)
        got = seen.get
        for b in range(self.bands):
            if got[f"b{b}"]:
                self.waiting.setdefault(b, []).append(round_)
        return got["n"], got["ok"]

    def best(self) -> DataFrame | None:
        """All waiting rows of the best band; they wait no longer."""
        if not self.waiting:
            return None
        band = max(self.waiting)
        rounds = self.waiting.pop(band)
        return self.table.rows().filter((F.col("band") == band) & F.col("round").isin(*rounds))


def crawl(spark: SparkSession, edges: DataFrame, snapshots: DataFrame, spec: CrawlSpec) -> DataFrame:
    """Result rows ``(url, depth, parent_url, success, score, key)``; at most max_pages rows, if given."""
    spec.validate()
    links = bucketed(edges.select("src", "dst", "pos"), "edges", "src")
    fetched = bucketed(snapshots.groupBy("url").agg(F.max("success").alias("success")), "outcomes", "url")
    start = spark.range(1).select(F.lit(spec.start_url).alias("url"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent_url"),
                                  F.array().cast("array<int>").alias("key"))
    first = _fetch(start, fetched.rows())  # depth 0 bypasses every filter (TRV9)
    by_score = spec.strategy == "best-first"
    if by_score and spec.max_pages is not None:
        out = _best_batches(links.rows(), fetched.rows(), cut_lineage(first), spec)
    else:
        out = _best_bands(links.rows(), fetched.rows(), first, spec)
    links.closed()
    fetched.closed()
    if spec.max_pages is not None and not by_score:
        return top_k(out, ["depth", "key"], spec.max_pages)
    return out


def _best_bands(links: DataFrame, fetched: DataFrame, first: DataFrame, spec: CrawlSpec) -> DataFrame:
    """Rounds over whole bands: breadth-first levels, or best-first over the whole graph."""
    spark, by_score = links.sparkSession, spec.strategy == "best-first"
    band = keyword_hits(F.col("url"), spec.relevance_keywords) if by_score else F.lit(0)
    queue = _Queue(spark, len(_keywords(spec.relevance_keywords)) + 1 if by_score else 1)
    _, n_success = queue.add(first, 0, band)
    round_ = 0
    while (frontier := queue.best()) is not None:
        remaining = None if spec.max_pages is None else spec.max_pages - n_success
        if remaining is not None and remaining <= 0:
            break
        frontier = frontier.filter(F.col("depth") < spec.max_depth)
        new = _fetch(_expand(frontier, links, spec, queue.table.rows().select("url")), fetched)
        if remaining is not None:  # frontier cut to the remaining budget, in frontier order
            new = top_k(cut_lineage(new), ["key"], remaining)
        round_ += 1
        n_success += queue.add(new, round_, band)[1]
    score = keyword_score(F.col("url"), spec.relevance_keywords) if by_score else F.lit(None).cast("double")
    return queue.table.closed().select("url", "depth", "parent_url", "success", score.alias("score"), "key")


def _best_batches(links: DataFrame, fetched: DataFrame, level: DataFrame, spec: CrawlSpec) -> DataFrame:
    """Best-first with a page budget: a scored pool of found URLs, the best ``batch_size`` a round."""
    score = lambda c: keyword_score(c, spec.relevance_keywords)
    visited = level.select("url")
    pool = cut_lineage(_expand(level, links, spec, visited).withColumn("score", score(F.col("url"))))
    results, n_rows = [level.withColumn("score", score(F.col("url")))], 1
    while n_rows < spec.max_pages:
        take = min(spec.batch_size, spec.max_pages - n_rows)
        batch = pool.orderBy(F.desc("score"), "depth", "key").limit(take)
        batch = cut_lineage(_fetch(batch, fetched))  # at most batch_size rows
        got = batch.count()
        if got == 0:
            break
        results.append(batch)
        n_rows += got
        visited = visited.unionByName(batch.select("url"))
        rest = pool.join(batch.select("url"), "url", "left_anti")
        deeper = batch.filter(F.col("depth") < spec.max_depth)
        new = _expand(deeper, links, spec, visited.unionByName(rest.select("url")))
        pool = cut_lineage(rest.unionByName(new.withColumn("score", score(F.col("url")))))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def depth_summary(result: DataFrame) -> DataFrame:
    """TRV11: pages per depth."""
    return result.groupBy("depth").agg(F.count(F.lit(1)).cast("long").alias("pages"))
