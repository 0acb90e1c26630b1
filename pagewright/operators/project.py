"""Per-page projections over the node table (PRJ1, PRJ10, PRJ11, PRJ13).

Every function takes the node table (see ``parse.html_nodes``) plus the page rows it came from,
and returns a plain DataFrame keyed by ``page_id``. Order-sensitive outputs carry an explicit
order column (``pos``) rather than relying on ``collect_list`` order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions import urls as U


def page_metadata(nodes: DataFrame) -> DataFrame:
    """PRJ1: title (first ``title`` element) and meta description, NULL when absent.

    One filtered scan and one per-page aggregation (conditional ``min_by`` on document order).
    """
    is_title = F.col("tag") == "title"
    is_desc = (F.col("tag") == "meta") & (F.lower(F.col("attrs")["name"]) == "description")
    rows = nodes.filter(is_title | is_desc).select(
        "page_id",
        F.when(is_title, F.col("text")).alias("title_text"), F.when(is_title, F.col("pre")).alias("title_pre"),
        F.when(is_desc, F.col("attrs")["content"]).alias("desc_text"), F.when(is_desc, F.col("pre")).alias("desc_pre"))
    agg = rows.groupBy("page_id").agg(F.min_by("title_text", "title_pre").alias("title"),
                                      F.min_by("desc_text", "desc_pre").alias("description"))
    return agg.select("page_id", T.clean_str("title").alias("title"), T.clean_str("description").alias("description"))


def page_links(nodes: DataFrame, pages: DataFrame, number: bool = True) -> DataFrame:
    """PRJ10 + PRJ11: one row per ``<a>`` with a non-blank href, in document order.

    ``kind`` is internal when the resolved URL's registrable domain equals the page's (so
    subdomains are internal; scheme and port are ignored). ``href`` is kept untrimmed;
    ``text``/``title`` are trimmed with blank -> NULL. ``pages`` needs ``page_id, url``.
    """
    a = (nodes.filter((F.col("tag") == "a"))
         .select("page_id", "pre", F.col("attrs")["href"].alias("href"),
                 T.clean_str("text").alias("text"), T.clean_str(F.col("attrs")["title"]).alias("title"))
         .filter(F.col("href").isNotNull() & (T.strip("href") != "")))
    base = pages.select("page_id", F.col("url").alias("page_url"))
    out = a.join(base, "page_id")
    out = out.withColumn("abs_url", U.resolve_url("page_url", "href"))
    page_dom = U.registrable_domain(U.host("page_url"))
    link_dom = U.registrable_domain(U.host("abs_url"))
    out = out.withColumn(
        "kind", F.when(link_dom.isNotNull() & (link_dom == page_dom), "internal").otherwise("external"))
    if number:
        out = out.withColumn("pos", F.row_number().over(Window.partitionBy("page_id").orderBy("pre")))
    else:
        out = out.withColumnRenamed("pre", "pos")
    return out.select("page_id", F.col("page_url").alias("url"), "pos", "kind", "href", "abs_url",
                      "text", "title")


def links_struct(links: DataFrame) -> DataFrame:
    """Nest the long links table back to ``struct<internal:array,external:array>`` per page."""
    item = F.struct("pos", F.struct("href", "text", "title").alias("link"))

    def side(kind):
        arr = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, item)))
        return F.transform(arr, lambda x: x["link"])

    return links.groupBy("page_id").agg(
        F.struct(side("internal").alias("internal"), side("external").alias("external")).alias("links"))


def drop_tags(nodes: DataFrame, tags: list[str]) -> DataFrame:
    """PRJ9 ``excluded_tags``: remove every subtree rooted at one of ``tags``."""
    from pagewright.operators.select import without_subtree
    from pagewright.operators.structure import last

    roots = nodes.filter(F.col("tag").isin(*[t.lower() for t in tags])).select(
        "page_id", F.col("pre").alias("m"), last().alias("m_last"))
    return without_subtree(nodes, roots)


def internal_only(links: DataFrame) -> DataFrame:
    """PRJ9 ``exclude_external_links``."""
    return links.filter(F.col("kind") == "internal")


def page_summary(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """PRJ1 + PRJ10 counts in one pass: ``(page_id, title, description, n_links, n_internal,
    n_external)`` from a single filtered scan of the node table, one join to the page URLs and
    one per-page aggregation (same rules as ``page_metadata`` and ``page_links``)."""
    rows = nodes.filter(F.col("tag").isin("title", "meta", "a")).select(
        "page_id", "pre", "tag", "text", F.col("attrs")["href"].alias("href"),
        F.lower(F.col("attrs")["name"]).alias("meta_name"), F.col("attrs")["content"].alias("meta_content"))
    rows = rows.join(pages.select("page_id", F.col("url").alias("page_url")), "page_id")
    is_link = (F.col("tag") == "a") & F.col("href").isNotNull() & (T.strip("href") != "")
    abs_url = U.resolve_url("page_url", "href")
    link_dom = U.registrable_domain(U.host(abs_url))
    internal = is_link & link_dom.isNotNull() & (link_dom == U.registrable_domain(U.host("page_url")))
    is_title = F.col("tag") == "title"
    is_desc = (F.col("tag") == "meta") & (F.col("meta_name") == "description")
    # per-row work in one projection (whole-stage codegen), the aggregate sees plain columns
    rows = rows.select("page_id", "pre", is_link.alias("is_link"), internal.alias("internal"),
                       F.when(is_title, F.col("text")).alias("title_text"),
                       F.when(is_title, F.col("pre")).alias("title_pre"),
                       F.when(is_desc, F.col("meta_content")).alias("desc_text"),
                       F.when(is_desc, F.col("pre")).alias("desc_pre"))
    agg = rows.groupBy("page_id").agg(
        F.min_by("title_text", "title_pre").alias("title"),
        F.min_by("desc_text", "desc_pre").alias("description"),
        F.count_if("is_link").alias("n_links"),
        F.count_if("internal").alias("n_internal"),
        F.count_if(F.col("is_link") & ~F.col("internal")).alias("n_external"))
    return agg.select("page_id", T.clean_str("title").alias("title"), T.clean_str("description").alias("description"),
                      "n_links", "n_internal", "n_external")
