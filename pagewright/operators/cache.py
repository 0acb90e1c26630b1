"""Cached or fresh, request by request, and what the cache holds afterwards (SRC8).

Requests for one URL come in an order and each has its own cache mode, so what a request reads depends
on what those before it wrote. That needs no replay in sequence: ``write_only`` stores every page it
fetches, ``enabled`` only into an empty place, the other modes store nothing. So the page that a
request finds is that of

1. the last ``write_only`` request before it that fetched a page, else
2. the cache as it was, else
3. the first ``enabled`` request before it that fetched a page.

Both are one prefix scan (``prefix``) that carries a request's number, not its page, and a URL that
everybody asks for is cut into pieces like any other key. The page is joined by that number.

A page may be its html or a short name of it, such as ``page_digest``: many requests that fetch few
pages then carry 64 characters each, and html is joined only to what is stored or filtered. No join
here is by broadcast: files with few distinct pages are small, and say nothing about the rows in memory.

The cache is a table in folders by a hash of the URL. An upsert rewrites the folders of the URLs it
stores and no other; each row says in which version it was stored, and a version that is written
again replaces itself. The cache holds raw html only: what is read from it is filtered again with the request's settings.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import prefix
from pagewright.operators.blocks import DEFAULT_MIN_WORDS, density_prune, fit_or_raw, page_blocks, page_markdown_fit_raw
from pagewright.operators.config import CACHE_MODES, DEFAULT_CACHE_MODE
from pagewright.operators.parse import html_nodes
from pagewright.session import materialize

URL_FOLDERS = 256
_CACHE = "url string, html string, version long"


def cache_mode(mode: Column) -> Column:
    """The request's mode: trimmed, in lower case, NULL is the default; an unknown one is NULL."""
    m = F.lower(F.trim(F.coalesce(mode, F.lit(DEFAULT_CACHE_MODE))))
    return F.when(m.isin(*CACHE_MODES), m)


def page_digest(html: Column | str = "html") -> Column:
    """The name of a page by its html; NULL without one."""
    return F.sha2(F.col(html) if isinstance(html, str) else html, 256)


def resolve(requests: DataFrame, cache: DataFrame, page: str = "html") -> DataFrame:
    """One row per request, as it is answered.

    ``requests``: ``url, seq, mode, html, status_code`` (unique seq within a URL; ``html`` and ``status_code`` of the
    fetch it would make, html NULL if that fails) and any other columns; ``cache``: ``url, html``.
    Adds ``source`` (cache | fresh | refused for an unknown mode), ``stored_by`` (the seq whose page is
    read from the cache; NULL: from the cache as it was) and ``writes_cache``; ``html`` and ``status_code``
    are those of the answer, without a status when cached. ``page`` names another column, of both, that
    stands for ``html``.
    """
    r = requests.withColumn("mode", cache_mode(F.col("mode")))
    fetched = F.col(page).isNotNull()
    r = r.withColumn("_over", F.when((F.col("mode") == "write_only") & fetched, F.col("seq"))) \
        .withColumn("_fill", F.when((F.col("mode") == "enabled") & fetched, F.col("seq")))
    r = materialize(r, "requests")
    narrow = r.select("url", "seq", "_over", "_fill")
    narrow = prefix.extremes_before(narrow, ["url"], ["seq"], written=False, _last_over=("_over", F.max), _first_fill=("_fill", F.min))
    was = cache.groupBy("url").agg(F.max(page).alias("_was")).where("_was IS NOT NULL")
    d = r.join(narrow.select("url", "seq", "_last_over", "_first_fill").hint("merge"), ["url", "seq"]).join(was.hint("merge"), "url", "left")
    by = F.coalesce("_last_over", F.when(F.col("_was").isNull(), F.col("_first_fill")))
    d = d.withColumn("_by", by)
    reads = F.col("mode").isin("enabled", "read_only") & (F.col("_by").isNotNull() | F.col("_was").isNotNull())
    d = d.withColumn("source", F.when(F.col("mode").isNull(), "refused").when(reads, "cache").otherwise("fresh"))
    cached = F.col("source") == "cache"
    d = d.withColumn("stored_by", F.when(cached, F.col("_by")))
    stored = r.where("_over IS NOT NULL OR _fill IS NOT NULL").select("url", F.col("seq").alias("stored_by"), F.col(page).alias("_stored"))
    d = d.join(stored.hint("merge"), ["url", "stored_by"], "left")
    writes = (F.col("source") == "fresh") & fetched & F.col("mode").isin("enabled", "write_only")
    return d.select(*[c for c in requests.columns if c not in (page, "status_code")], "source", "stored_by",
                    F.coalesce(writes, F.lit(False)).alias("writes_cache"),
                    F.when(cached, F.coalesce("_stored", "_was")).when(F.col("source") == "fresh", F.col(page)).alias(page),
                    F.when(F.col("source") == "fresh", F.col("status_code")).alias("status_code"))


def write_set(resolved: DataFrame, page: str = "html") -> DataFrame:
    """``url, html, seq``: the last page that each URL's requests stored."""
    return resolved.where("writes_cache").groupBy("url").agg(F.max_by(F.struct(page, "seq"), "seq").alias("w")).select("url", f"w.{page}", "w.seq")


def _lying(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{_CACHE}, names int").parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upsert(pages: DataFrame, path: str, version: int, folders: int = URL_FOLDERS) -> None:
    """Store ``url, html`` as of ``version`` in the cache at ``path``; URLs stored later than that stay.

    The number of ``folders`` is the cache's own: every upsert into it names the same.
    """
    spark = pages.sparkSession
    folder = F.pmod(F.xxhash64("url"), F.lit(folders)).cast("int").alias("names")
    new = materialize(pages.where("url IS NOT NULL AND html IS NOT NULL").groupBy("url").agg(F.max("html").alias("html"))
                      .select("url", "html", F.lit(version).cast("long").alias("version"), folder), "cache_writes")
    before = _lying(spark, path)
    if before is not None:
        # only the folders that these URLs fall into are read and written
        near = before.join(new.select("names").distinct(), "names", "left_semi")
        both = near.select("url", "html", "version", "names", F.lit(0).alias("age")).unionByName(new.withColumn("age", F.lit(1)))
        new = both.groupBy("names", "url").agg(F.max_by(F.struct("html", "version"), F.struct("version", "age")).alias("p"))
        new = materialize(new.select("url", "p.html", "p.version", "names"), "cache_merged")
    new.repartition("names").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("names").parquet(path)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """``url, html, version``, one row per URL; empty before the first upsert."""
    found = _lying(spark, path)
    return spark.createDataFrame([], _CACHE) if found is None else found.select("url", "html", "version")


def served(requests: DataFrame, path: str, version: int, folders: int = URL_FOLDERS, pages: DataFrame | None = None) -> DataFrame:
    """The requests answered from the cache at ``path``, which then holds what they stored.

    With ``pages``, ``digest, html``, the requests and the answers have ``digest`` (``page_digest``) instead of ``html``.
    """
    held = read_cache(requests.sparkSession, path)
    if pages is None:
        out = materialize(resolve(requests, held), "served")
        upsert(write_set(out), path, version, folders)
        return out
    out = materialize(resolve(requests, held.select("url", page_digest().alias("digest")), "digest"), "served")
    once = pages.join(write_set(out, "digest").select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(F.max("html").alias("html"))
    upsert(write_set(out, "digest").join(once.hint("merge"), "digest"), path, version, folders)
    return out


def refiltered(resolved: DataFrame, page: str, min_words: str | None = None, pages: DataFrame | None = None) -> DataFrame:
    """``resolved`` with ``content``: the answer's html through the content filter again.

    ``page`` names an integer column that identifies the html, so an answer given often is parsed once.
    With ``min_words``, a column of the requests, the filter runs with each request's own threshold.
    With ``pages``, that column and ``html``, the answers need no html of their own: ``page`` is NULL without one.
    """
    words = F.coalesce(F.col(min_words), F.lit(DEFAULT_MIN_WORDS)) if min_words else F.lit(DEFAULT_MIN_WORDS)
    r = resolved.withColumn("_words", words)
    has = F.col("html" if pages is None else page).isNotNull()
    answered = r.where(has)
    found = answered if pages is None else pages.join(answered.select(page).distinct(), page, "left_semi")
    pages = materialize(found.groupBy(F.col(page).cast("long").alias("_page")).agg(F.max("html").alias("html")), "answered_pages")
    blocks = page_blocks(html_nodes(pages, page_id="_page", container_text=False))
    # a page's blocks once per threshold it is asked with
    asked = answered.select(F.col(page).cast("long").alias("page_id"), "_words").distinct()
    asked = asked.withColumn("_asked", F.xxhash64("page_id", "_words"))
    blocks = density_prune(blocks.join(asked, "page_id").drop("page_id").withColumnRenamed("_asked", "page_id"), F.col("_words"))
    text = page_markdown_fit_raw(blocks).withColumnRenamed("page_id", "_asked")
    r = r.withColumn("_asked", F.when(has, F.xxhash64(F.col(page).cast("long"), "_words")))
    content = fit_or_raw(F.coalesce("fit", F.lit("")), F.col("raw"))
    return r.join(text, "_asked", "left").withColumn("content", F.when(has, content)).drop("_asked", "_words", "fit", "raw")
