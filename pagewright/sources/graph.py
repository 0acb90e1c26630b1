"""Derived link graph over the corpus pages (the real hrefs never point at corpus pages).

Within each host, pages are ranked by ``page_id`` (rank r, 1-based); page r links to pages 2r
(pos 1) and 2r+1 (pos 2) of the same host. Each host's rank-1 page also links (pos 3) to the
rank-1 page of the next host by name. Ranks are computed skew-safe (a host may hold a large
share of all pages) and the next-host relation without a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.operators.prefix import row_number, running_count
from pagewright.operators.ranking import global_row_number, next_in_order
from pagewright.sources.tables import table


def ranked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", U.host("url").alias("host"))
    return row_number(pages, ["host"], ["page_id"], out="r", written=False)


def site_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges ``(src, dst, pos)``."""
    ranked = ranked_pages(spark, sf_dir)
    nodes = ranked.select("host", "r", F.col("url").alias("dst"))
    left = ranked.select("host", F.col("r").alias("pr"), F.col("url").alias("src"))
    kids = []
    for pos, off in ((1, 0), (2, 1)):
        kids.append(left.withColumn("r", F.col("pr") * 2 + off).join(nodes, ["host", "r"])
                    .select("src", "dst", F.lit(pos).alias("pos")))
    firsts = ranked.filter(F.col("r") == 1).select("host", "url")
    nxt = next_in_order(firsts.select("host"), "host", out="next_host")
    cross = (firsts.join(nxt, "host")
             .join(firsts.select(F.col("host").alias("next_host"), F.col("url").alias("dst")), "next_host")
             .select(F.col("url").alias("src"), "dst", F.lit(3).alias("pos")))
    return kids[0].unionByName(kids[1]).unionByName(cross)


def web_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges ``(src, dst, pos)`` of a graph with cycles and shared children.

    Within a host of n pages, page r links to 2r and 2r + 1, back to r div 2 (a cycle), and to
    ``7r mod n + 1`` (often a second in-edge). The first page of the h-th host by name links to the first
    pages of hosts ``2h + 1`` and ``2h + 2``, modulo the number of hosts.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", U.host("url").alias("host"))
    ranked = running_count(pages, ["host"], ["page_id"], out="r", total="n", written=False)
    nodes = ranked.select("host", "r", F.col("url").alias("dst"))
    r = F.col("pr")
    targets = F.array(r * 2, r * 2 + 1, F.when(r > 1, F.floor(r / 2)), F.when(r * 7 % F.col("n") + 1 != r, r * 7 % F.col("n") + 1))
    inside = ranked.select("host", F.col("r").alias("pr"), F.col("url").alias("src"), "n") \
        .select("host", "src", F.posexplode(targets).alias("i", "r")).join(nodes, ["host", "r"]) \
        .select("src", "dst", (F.col("i") + 1).alias("pos"))
    firsts = global_row_number(ranked.filter("r = 1").select("host", "url"), ["host"], out="h").withColumn("h", F.col("h") - 1)
    hosts = F.lit(max(firsts.count(), 1))  # one number
    kids = firsts.select("url", F.posexplode(F.array((F.col("h") * 2 + 1) % hosts, (F.col("h") * 2 + 2) % hosts)).alias("i", "h"))
    across = kids.select(F.col("url").alias("src"), "h", (F.col("i") + 5).alias("pos")) \
        .join(firsts.select("h", F.col("url").alias("dst")), "h").filter("src <> dst").select("src", "dst", "pos")
    return inside.unionByName(across)


def web_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch outcomes ``(url, success)``: every eleventh page fails, so nothing is followed from it."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("url", (F.col("html").isNotNull() & (F.col("page_id") % 11 != 7)).alias("success"))


def first_page_url(spark: SparkSession, sf_dir: str) -> str:
    """Start URL used by the traversal queries: rank-1 page of the first host by name."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", U.host("url").alias("host"))
    return pages.orderBy("host", "page_id").select("url").first()[0]   # distributed top-1
