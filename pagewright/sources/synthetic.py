"""Synthetic pages rendered from relational tables (the test pages have no tables, product
cards, external links or code). Each builder groups a *bounded* number of rows per page
(``rows_per_page``), renders html with native string functions and returns
``(page_id, url, html)`` - so the oracle can compare extraction results with the source rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.sources.tables import table


def esc(c: Column) -> Column:
    """Minimal html escaping of text content."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _paged(rows: DataFrame, page_col: Column, order_col: str, fragment: Column) -> DataFrame:
    """Concatenate row fragments per page in ``order_col`` order (groups are bounded).

    The pages are parsed next, which costs far more than their bytes suggest: a named number of
    partitions keeps the pages spread over the tasks (the groups reuse it, no further shuffle).
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("page_id", page_col).repartition(tasks, "page_id").groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order_col), fragment.alias("f")))),
                                 lambda x: x["f"]), "").alias("body"))


def product_pages(spark: SparkSession, sf_dir: str, rows_per_page: int = 10) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                                               "p_retailprice")
    k = F.col("p_partkey")
    price = F.when(k % 7 != 0, F.concat(F.lit('<span class="price">$'),
                                        F.format_string("%.2f", F.col("p_retailprice")), F.lit("</span>")))
    card = F.concat(
        F.lit('<div class="card"><h2 class="name">'), esc(F.col("p_name")), F.lit("</h2>"),
        F.coalesce(price, F.lit("")),
        F.lit('<a href="/part/'), k.cast("string"), F.lit('" title="'), esc(F.col("p_brand")), F.lit('">view</a>'),
        F.lit('<ul class="tags"><li>'), esc(F.col("p_type")), F.lit("</li><li>size "),
        F.col("p_size").cast("string"), F.lit("</li></ul></div>"))
    pages = _paged(part, F.floor(k / rows_per_page).cast("long"), "p_partkey", card)
    pid = F.col("page_id").cast("string")
    html = F.concat(F.lit("<!DOCTYPE html><html><head><title>Parts "), pid,
                    F.lit('</title><meta name="description" content="Catalogue page '), pid,
                    F.lit('"></head><body><div class="list">'), F.col("body"), F.lit("</div></body></html>"))
    return pages.select("page_id", F.concat(F.lit("https://parts.example.com/page/"), pid).alias("url"),
                        html.alias("html"))


def customer_table_pages(spark: SparkSession, sf_dir: str, rows_per_page: int = 50) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    row = F.concat(F.lit("<tr><td>"), F.col("c_custkey").cast("string"), F.lit("</td><td>"), esc(F.col("c_name")),
                   F.lit("</td><td>"), esc(F.col("c_mktsegment")), F.lit("</td><td>"),
                   F.col("c_nationkey").cast("string"), F.lit("</td></tr>"))
    pages = _paged(cust, F.floor(F.col("c_custkey") / rows_per_page).cast("long"), "c_custkey", row)
    pid = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<html><body><table role=\"presentation\"><tr><td>menu</td></tr></table>"),
        F.lit("<table><caption>Customers "), pid, F.lit("</caption><thead><tr><th>Key</th><th>Name</th>"
                                                        "<th>Segment</th><th>Nation</th></tr></thead><tbody>"),
        F.col("body"), F.lit("</tbody></table></body></html>"))
    return pages.select("page_id", F.concat(F.lit("https://crm.example.com/customers/"), pid).alias("url"),
                        html.alias("html"))


def supplier_link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = F.col("s_suppkey")
    ks = k.cast("string")
    shop = F.concat(F.lit("shop"), (k % 5).cast("string"))
    url = F.concat(F.lit("https://www."), shop, F.lit(".example.com/s/"), ks)
    html = F.concat(
        F.lit("<html><head><title>"), esc(F.col("s_name")), F.lit("</title></head><body><nav>"),
        F.lit('<a href="/same/'), ks, F.lit('">Same</a>'),
        F.lit('<a href="https://api.'), shop, F.lit('.example.com/x">  Sub  </a>'),
        F.lit('<a href="https://other'), (k % 3).cast("string"), F.lit('.test/y" title=" ">Other</a>'),
        F.lit('<a href="../up/'), ks, F.lit('"> </a>'),
        F.lit('<a name="anchor">no href</a>'),
        F.lit('<a href="  ">blank</a>'),
        F.lit('<a href="http://'), shop, F.lit('.example.com:8080/p" title=" Port page ">Port</a>'),
        F.lit("</nav></body></html>"))
    return sup.select(k.alias("page_id"), url.alias("url"), html.alias("html"))


def code_pages(spark: SparkSession, sf_dir: str, rows_per_page: int = 10) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey").cast("string")
    name = esc(F.col("p_name"))
    frag = F.concat(
        F.lit("<article><p>Note "), k, F.lit(".</p><pre><code>SELECT "), k, F.lit(" FROM parts</code></pre>"),
        F.lit("<p>The part "), name, F.lit(" is listed here together with "), name, F.lit(" again.</p></article>"))
    pages = _paged(part, F.floor(F.col("p_partkey") / rows_per_page).cast("long"), "p_partkey", frag)
    pid = F.col("page_id").cast("string")
    html = F.concat(F.lit("<html><body>"), F.col("body"), F.lit("</body></html>"))
    return pages.select("page_id", F.concat(F.lit("https://code.example.com/"), pid).alias("url"),
                        html.alias("html"))


def nested_list_pages(spark: SparkSession, sf_dir: str, rows_per_page: int = 10) -> DataFrame:
    """Every part as a list inside a list, ``1 + p_size % 5`` deep, its name in the innermost item."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    levels = F.sequence(F.lit(1), (F.col("p_size") % 5 + 1).cast("int"))
    key = F.col("p_partkey").cast("string")
    opened = F.array_join(F.transform(levels, lambda i: F.concat(
        F.lit('<ul><li data-level="'), i.cast("string"), F.lit('" data-key="'), key, F.lit('">'))), "")
    closed = F.array_join(F.transform(levels, lambda i: F.lit("</li></ul>")), "")
    frag = F.concat(F.lit("<section>"), opened, F.lit("<b> "), esc(F.col("p_name")), F.lit(" </b><i>x</i><b>second</b>"),
                    closed, F.lit("</section>"))
    pages = _paged(part, F.floor(F.col("p_partkey") / rows_per_page).cast("long"), "p_partkey", frag)
    pid = F.col("page_id").cast("string")
    return pages.select("page_id", F.concat(F.lit("https://lists.example.com/"), pid).alias("url"),
                        F.concat(F.lit("<html><body>"), F.col("body"), F.lit("</body></html>")).alias("html"))
