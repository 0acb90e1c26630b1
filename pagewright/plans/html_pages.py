"""Driver queries over parsed pages: host summary (entry), titles, links, tag histogram."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.operators.parse import html_nodes, parsed_nodes
from pagewright.operators.project import page_links, page_metadata
from pagewright.plans import sqlparts as S
from pagewright.plans.catalog import register
from pagewright.sources.tables import table


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def host_summary_df(spark, sf_dir):
    from pagewright.operators.project import page_summary
    pages = _pages(spark, sf_dir)
    summary = page_summary(html_nodes(pages, container_text=False), pages)
    per_page = pages.select("page_id", U.host("url").alias("host")).join(summary, "page_id", "left")
    return per_page.groupBy("host").agg(
        F.count("*").cast("long").alias("n_pages"),
        F.coalesce(F.sum("n_links"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.sum("n_internal"), F.lit(0)).cast("long").alias("n_internal"),
        F.coalesce(F.sum("n_external"), F.lit(0)).cast("long").alias("n_external"),
        F.coalesce(F.sum(F.length("title")), F.lit(0)).cast("long").alias("title_chars"))


HOST_SUMMARY_SQL = f"""
WITH {S.ANCHORS_CTE.strip()},
per_page AS (
  SELECT p.page_id, {S.host('p.url')} AS host, {S.title('p.html')} AS title,
         coalesce(l.n_links, 0) AS n_links, coalesce(l.n_internal, 0) AS n_internal,
         coalesce(l.n_external, 0) AS n_external
  FROM pages p LEFT JOIN (
    SELECT page_id, count(*) AS n_links, count(*) FILTER (WHERE kind = 'internal') AS n_internal,
           count(*) FILTER (WHERE kind = 'external') AS n_external
    FROM links_k GROUP BY page_id) l ON l.page_id = p.page_id
)
SELECT host, CAST(count(*) AS BIGINT) AS n_pages, CAST(sum(n_links) AS BIGINT) AS n_links,
       CAST(sum(n_internal) AS BIGINT) AS n_internal, CAST(sum(n_external) AS BIGINT) AS n_external,
       CAST(coalesce(sum(length(title)), 0) AS BIGINT) AS title_chars
FROM per_page GROUP BY host
"""

register("host_summary", HOST_SUMMARY_SQL)(host_summary_df)


@register("page_title_lang", f"""
SELECT page_id,
       nullif(regexp_extract(html, '<html[^>]*\\slang="([^"]*)"', 1), '') AS lang,
       {S.title('html')} AS title,
       CAST(CASE WHEN {S.title('html')} IS NULL THEN 0
                 ELSE len(string_split_regex({S.title('html')}, ' ')) END AS BIGINT) AS title_words
FROM pages
""")
def page_title_lang(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    nodes = parsed_nodes(pages, container_text=False)
    lang = (nodes.filter(F.col("tag") == "html").groupBy("page_id")
            .agg(F.min_by(F.col("attrs")["lang"], "pre").alias("lang")))
    meta = page_metadata(nodes)
    out = pages.select("page_id").join(lang, "page_id", "left").join(meta, "page_id", "left")
    return out.select(
        "page_id", F.when(F.col("lang") == "", None).otherwise(F.col("lang")).alias("lang"), "title",
        F.when(F.col("title").isNull(), 0).otherwise(F.size(F.split("title", " "))).cast("long")
        .alias("title_words"))


@register("page_links_resolved", f"""
WITH {S.ANCHORS_CTE.strip()}
SELECT page_id, CAST(pos AS BIGINT) AS pos, kind, href, abs_url, text, title FROM links_k
""")
def page_links_resolved(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    links = page_links(html_nodes(pages, container_text=False), pages)
    return links.select("page_id", F.col("pos").cast("long").alias("pos"), "kind", "href", "abs_url",
                        "text", "title")


@register("link_kind_counts", f"""
WITH {S.ANCHORS_CTE.strip()}
SELECT {S.host('url')} AS host, kind, CAST(count(*) AS BIGINT) AS n_links,
       CAST(count(DISTINCT page_id) AS BIGINT) AS n_pages,
       CAST(count(DISTINCT abs_url) AS BIGINT) AS n_targets
FROM links_k GROUP BY 1, 2
""")
def link_kind_counts(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    links = page_links(html_nodes(pages, container_text=False), pages, number=False)
    return (links.withColumn("host", U.host("url")).groupBy("host", "kind")
            .agg(F.count("*").cast("long").alias("n_links"),
                 F.countDistinct("page_id").cast("long").alias("n_pages"),
                 F.countDistinct("abs_url").cast("long").alias("n_targets")))


@register("tag_histogram", f"""
WITH t AS (
  SELECT unnest(regexp_extract_all({S.no_script('html')}, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag
  FROM pages
  UNION ALL
  SELECT 'script' FROM pages, unnest(regexp_extract_all(html, '<script[\\s>]'))
  UNION ALL
  SELECT 'style' FROM pages, unnest(regexp_extract_all(html, '<style[\\s>]'))
)
SELECT lower(tag) AS tag, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY 1
""")
def tag_histogram(spark, sf_dir):
    nodes = html_nodes(_pages(spark, sf_dir), container_text=False)
    return nodes.groupBy("tag").agg(F.count("*").cast("long").alias("n"))
