"""Synthetic sitemap documents rendered from the corpus pages (one index per host).

Per host (pages ranked by page_id, chunks of ``chunk`` ranks):
  * ``https://{host}/sitemap_index.xml`` - sitemaps.org index listing, per chunk c,
    ``sm-a-{c}.xml`` (absolute loc) then ``/sm-b-{c}.xml`` (relative loc), and finally itself;
  * ``sm-a-{c}.xml`` - urlset without namespace: odd ranks;
  * ``sm-b-{c}.xml`` - gzip-compressed urlset in an older namespace: even ranks, each loc wrapped
    in zero-width characters;
  * error roots: ``broken.xml`` (an html page), ``missing.xml`` (fetch error), ``empty.xml``.
Rows per document are bounded by ``chunk``.
"""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from pagewright.functions import urls as U
from pagewright.sources.graph import ranked_pages
from pagewright.sources.synthetic import esc
from pagewright.sources.tables import table

NS_ORG = "http://www.sitemaps.org/schemas/sitemap/0.9"
NS_OLD = "http://www.google.com/schemas/sitemap/0.84"
ZW_OPEN = "\u200b"
ZW_CLOSE = "\ufeff"


@F.pandas_udf(BinaryType())
def _gzip(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else gzip.compress(t.encode("utf-8"), mtime=0))


def _base(host_col: str = "host"):
    return F.concat(F.lit("https://"), F.col(host_col))


def sitemap_docs(spark: SparkSession, sf_dir: str, chunk: int = 1000) -> DataFrame:
    ranked = ranked_pages(spark, sf_dir).withColumn("c", F.floor((F.col("r") - 1) / chunk).cast("long"))
    odd = F.col("r") % 2 == 1
    entry_a = F.concat(F.lit("<url><loc>"), esc(F.col("url")), F.lit("</loc></url>"))
    entry_b = F.concat(F.lit("<url><loc>" + ZW_OPEN), esc(F.col("url")), F.lit(ZW_CLOSE + "</loc></url>"))
    item = F.struct("r", F.when(odd, entry_a).otherwise(entry_b).alias("x"))
    grouped = ranked.groupBy("host", "c", odd.alias("odd")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda v: v["x"]), "").alias("body"))
    cs = F.col("c").cast("string")
    a_docs = grouped.filter("odd").select(
        F.concat(_base(), F.lit("/sm-a-"), cs, F.lit(".xml")).alias("sitemap_url"),
        F.encode(F.concat(F.lit("<urlset>"), F.col("body"), F.lit("</urlset>")), "UTF-8").alias("content"))
    b_docs = grouped.filter(~F.col("odd")).select(
        F.concat(_base(), F.lit("/sm-b-"), cs, F.lit(".xml")).alias("sitemap_url"),
        _gzip(F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="{NS_OLD}">'), F.col("body"),
                       F.lit("</urlset>"))).alias("content"))
    chunks = ranked.select("host", "c").distinct()
    idx_item = F.struct("c", F.concat(
        F.lit("<sitemap><loc>"), _base(), F.lit("/sm-a-"), cs, F.lit(".xml</loc></sitemap>"),
        F.lit("<sitemap><loc>/sm-b-"), cs, F.lit(".xml</loc></sitemap>")).alias("x"))
    idx = chunks.groupBy("host").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(idx_item)), lambda v: v["x"]), "").alias("body"))
    root = F.concat(_base(), F.lit("/sitemap_index.xml"))
    idx_docs = idx.select(root.alias("sitemap_url"), F.encode(F.concat(
        F.lit(f'<sitemapindex xmlns="{NS_ORG}">'), F.col("body"),
        F.lit("<sitemap><loc>"), root, F.lit("</loc></sitemap></sitemapindex>")), "UTF-8").alias("content"))
    firsts = ranked.filter(F.col("r") == 1).select("host", "page_id")
    html = table(spark, sf_dir, "pages").select("page_id", "html")
    broken = firsts.join(html, "page_id").select(
        F.concat(_base(), F.lit("/broken.xml")).alias("sitemap_url"), F.encode("html", "UTF-8").alias("content"))
    empty = firsts.select(F.concat(_base(), F.lit("/empty.xml")).alias("sitemap_url"),
                          F.encode(F.lit(f'<urlset xmlns="{NS_ORG}"></urlset>'), "UTF-8").alias("content"))
    docs = a_docs.unionByName(b_docs).unionByName(idx_docs).unionByName(broken).unionByName(empty) \
        .withColumn("fetch_error", F.lit(None).cast("string"))
    missing = firsts.select(F.concat(_base(), F.lit("/missing.xml")).alias("sitemap_url"),
                            F.lit(None).cast("binary").alias("content"),
                            F.lit("HTTP 404 Not Found").alias("fetch_error"))
    return docs.unionByName(missing).withColumn("final_url", F.col("sitemap_url"))


def sitemap_roots(spark: SparkSession, sf_dir: str, with_errors: bool = False) -> DataFrame:
    hosts = table(spark, sf_dir, "pages").select(U.host("url").alias("host")).distinct()
    names = ["/sitemap_index.xml"] + (["/broken.xml", "/missing.xml", "/empty.xml"] if with_errors else [])
    roots = None
    for n in names:
        r = hosts.select(F.concat(_base(), F.lit(n)).alias("root"))
        roots = r if roots is None else roots.unionByName(r)
    return roots
