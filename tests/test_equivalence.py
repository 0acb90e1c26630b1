"""Fast paths equal their general counterparts on the test pages and documents."""

from pyspark.sql import functions as F

from conftest import SF
from pagewright.operators.blocks import bm25, bm25_within
from pagewright.operators.parse import html_nodes
from pagewright.operators.project import page_links, page_metadata, page_summary
from pagewright.sources.tables import table


def test_bm25_in_row_equals_join_based(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")) \
        .select("doc_id", (F.col("i") + 1).cast("long").alias("no"), "line").filter(F.trim("line") != "")
    a = bm25(lines, "doc_id", "no", "line", "the tion ment")
    blocks = F.filter(F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        (i + 1).cast("long").alias("no"), line.alias("text"))), lambda x: F.trim(x["text"]) != "")
    b = bm25_within(docs.select("doc_id", blocks.alias("b")), "doc_id", "b", "the tion ment")
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "no", "score").collect())
    assert key(a) == key(b) and len(key(a)) > 0


def test_page_summary_equals_metadata_and_links(spark):
    pages = table(spark, SF, "pages")
    nodes = html_nodes(pages, container_text=False)
    s = {r.page_id: (r.title, r.description, r.n_links, r.n_internal, r.n_external)
         for r in page_summary(nodes, pages).collect()}
    meta = {r.page_id: (r.title, r.description) for r in page_metadata(nodes).collect()}
    links = page_links(nodes, pages, number=False).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "internal").alias("i"))
    lk = {r.page_id: (r.n, r.i, r.n - r.i) for r in links.collect()}
    for pid, (title, desc, n, i, e) in s.items():
        assert (title, desc) == meta.get(pid, (None, None))
        assert (n, i, e) == lk.get(pid, (0, 0, 0))
