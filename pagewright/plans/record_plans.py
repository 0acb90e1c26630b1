"""Driver queries for record extraction, tables, link classification and code preservation
(EXT1-EXT8, PRJ1, PRJ3, PRJ10-PRJ12) over the test pages and over synthetic pages rendered
from relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.operators.blocks import density_prune, page_blocks
from pagewright.operators.extract import extract_records
from pagewright.operators.parse import html_nodes, parsed_nodes
from pagewright.operators.project import page_links, page_metadata
from pagewright.operators.tables import page_tables
from pagewright.plans import sqlparts as S
from pagewright.plans.catalog import register
from pagewright.sources.synthetic import (code_pages, customer_table_pages, nested_list_pages, product_pages,
                                          supplier_link_pages)
from pagewright.sources.tables import table

NAV_CSS = {"name": "nav", "baseSelector": "nav li", "fields": [
    {"name": "label", "selector": "a", "type": "text"},
    {"name": "href", "selector": "a", "type": "attribute", "attribute": "href"}]}
NAV_XPATH = {"name": "nav", "baseSelector": "//nav//li", "fields": [
    {"name": "label", "selector": ".//a", "type": "text"},
    {"name": "href", "selector": "//a", "type": "attribute", "attribute": "href"}]}

NAV_SQL = f"""
WITH items AS (
  SELECT page_id, unnest(m) AS li, generate_subscripts(m, 1) AS ord
  FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1), '(?s)<li>.*?</li>') AS m
        FROM pages)
)
SELECT page_id, CAST(ord AS BIGINT) AS item_no,
       nullif({S.collapse(S.unescape(S.strip_tags("regexp_extract(li, '(?s)<a[^>]*>(.*?)</a>', 1)")))}, '') AS label,
       {S.unescape("regexp_extract(li, '<a\\s[^>]*href=\"([^\"]*)\"', 1)")} AS href
FROM items
"""


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@register("css_nav_records", NAV_SQL)
def css_nav_records(spark, sf_dir):
    return extract_records(parsed_nodes(_pages(spark, sf_dir)), NAV_CSS, "css")


@register("xpath_nav_records", NAV_SQL)
def xpath_nav_records(spark, sf_dir):
    return extract_records(parsed_nodes(_pages(spark, sf_dir)), NAV_XPATH, " XPath ")


FIELD_TYPES = {"name": "article", "baseSelector": "article", "fields": [
    {"name": "title", "selector": "h1", "type": "text", "transform": "lowercase"},
    {"name": "lead", "selector": "p", "type": "regex", "pattern": "^([^ ]+)"},
    {"name": "missing", "selector": "table", "type": "text", "default": "none"},
    {"name": "raw_h1", "selector": "h1", "type": "textt"},
    {"name": "rx_raw", "selector": "h1", "type": "regex"},
    {"name": "paras", "selector": "p", "type": "nested_list",
     "fields": [{"name": "bold", "selector": "b", "type": "text"}]}]}


@register("css_field_types", f"""
WITH src AS (SELECT page_id, regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS art FROM pages),
segs AS (SELECT page_id, art, list_slice(string_split(art, '<p>'), 2, len(string_split(art, '<p>'))) AS ps FROM src)
SELECT page_id, CAST(1 AS BIGINT) AS item_no,
       lower({S.collapse(S.unescape(S.strip_tags("regexp_extract(art, '(?s)<h1>(.*?)</h1>', 1)")))}) AS title,
       regexp_extract({S.collapse(S.unescape(S.strip_tags("replace(ps[1], '<br>', ' ')")))}, '^([^ ]+)', 1) AS lead,
       'none' AS missing,
       regexp_extract(art, '(?s)<h1>.*?</h1>') AS raw_h1,
       regexp_extract(art, '(?s)<h1>.*?</h1>') AS rx_raw,
       CAST(len(ps) AS BIGINT) AS n_paras,
       CAST(len(list_filter(ps, lambda s: s LIKE '%<b>%')) AS BIGINT) AS n_bold
FROM segs
""")
def css_field_types(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    rec = extract_records(parsed_nodes(pages), FIELD_TYPES, "css", pages_html=pages.select("page_id", "html"))
    return rec.select("page_id", "item_no", "title", "lead", "missing", "raw_h1", "rx_raw",
                      F.size("paras").cast("long").alias("n_paras"),
                      F.size(F.filter("paras", lambda x: x["bold"].isNotNull())).cast("long").alias("n_bold"))


PART_SCHEMA = {"name": "parts", "baseSelector": "div.card", "fields": [
    {"name": "name", "selector": "h2.name", "type": "text"},
    {"name": "price", "selector": ".price", "type": "text", "default": "n/a"},
    {"name": "href", "selector": "a", "type": "attribute", "attribute": "href"},
    {"name": "brand", "selector": "a", "type": "attribute", "attribute": "title"},
    {"name": "tags", "selector": "ul.tags li", "type": "list", "fields": [{"name": "t", "type": "text"}]}]}


@register("css_part_records", """
SELECT p_partkey // 10 AS page_id,
       CAST(row_number() OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey) AS BIGINT) AS item_no,
       p_name AS name,
       CASE WHEN p_partkey % 7 <> 0 THEN '$' || printf('%.2f', p_retailprice) ELSE 'n/a' END AS price,
       '/part/' || p_partkey AS href, p_brand AS brand, CAST(2 AS BIGINT) AS n_tags,
       p_type || '|size ' || p_size AS tag_text,
       'Parts ' || (p_partkey // 10) AS page_title, 'Catalogue page ' || (p_partkey // 10) AS description
FROM part
""")
def css_part_records(spark, sf_dir):
    pages = product_pages(spark, sf_dir)
    nodes = parsed_nodes(pages)
    rec = extract_records(nodes, PART_SCHEMA, "css")
    meta = page_metadata(nodes)
    return rec.join(meta, "page_id", "left").select(
        "page_id", "item_no", "name", "price", "href", "brand",
        F.size("tags").cast("long").alias("n_tags"),
        F.array_join(F.transform("tags", lambda x: x["t"]), "|").alias("tag_text"),
        F.col("title").alias("page_title"), "description")


SIZE_XPATH = {"name": "sizes",
              "baseSelector": "//li[starts-with(text(),'size ') and not(contains(.,'/')) or @data-note='a/b and c']",
              "fields": [
                  {"name": "partkey", "selector": "../..//a/@href", "type": "regex", "pattern": "/part/([0-9]+)"},
                  {"name": "kind", "selector": "./preceding-sibling::li/text()", "type": "text", "transform": "uppercase"},
                  {"name": "size", "selector": ".", "type": "regex", "pattern": "([0-9]+)$"},
                  {"name": "brand", "selector": "../preceding-sibling::a[contains(@href,'/part/') or @rel='next']/@title",
                   "type": "text", "transform": "lowercase"}]}


@register("xpath_axis_records", """
SELECT p_partkey // 10 AS page_id,
       CAST(row_number() OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey) AS BIGINT) AS item_no,
       CAST(p_partkey AS VARCHAR) AS partkey, upper(p_type) AS kind, CAST(p_size AS VARCHAR) AS size,
       lower(p_brand) AS brand
FROM part
""")
def xpath_axis_records(spark, sf_dir):
    """Parent, preceding-sibling and text predicates, ``or``/``not``, values through type and transform."""
    return extract_records(parsed_nodes(product_pages(spark, sf_dir)), SIZE_XPATH, "xpath")


LATER_CSS = {"name": "later", "baseSelector": "div.card:not(:first-child)", "fields": [
    {"name": "name", "selector": "h2:not(.price, [hidden])", "type": "text"},
    {"name": "size", "selector": "li:last-child", "type": "text"}]}


@register("css_pseudo_records", """
SELECT page_id, CAST(rn - 1 AS BIGINT) AS item_no, name, size
FROM (SELECT p_partkey // 10 AS page_id, p_name AS name, 'size ' || p_size AS size,
             row_number() OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey) AS rn FROM part)
WHERE rn > 1
""")
def css_pseudo_records(spark, sf_dir):
    """``:not()`` of one and of several compounds, ``:last-child``."""
    return extract_records(parsed_nodes(product_pages(spark, sf_dir)), LATER_CSS, "css")


ITEM_XPATH = {"name": "items", "baseSelector": "//li", "fields": [
    {"name": "level", "selector": "./@data-level", "type": "text"},
    {"name": "name", "selector": ".//b[position()<=1][not(normalize-space()='second')]", "type": "text"},
    {"name": "above", "selector": "ancestor::li[1]/@data-level", "type": "text", "default": "none"},
    {"name": "outermost", "selector": "ancestor-or-self::li[last()]/@data-key", "type": "text"},
    {"name": "leaf", "selector": "self::li[count(ul)=0]/@data-key", "type": "text", "default": "no"}]}


@register("nested_list_records", """
WITH d AS (SELECT p_partkey, p_name, 1 + p_size % 5 AS deep, unnest(range(1, 2 + p_size % 5)) AS level FROM part)
SELECT p_partkey // 10 AS page_id,
       CAST(row_number() OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey, level) AS BIGINT) AS item_no,
       CAST(level AS VARCHAR) AS level, p_name AS name,
       CASE WHEN level > 1 THEN CAST(level - 1 AS VARCHAR) ELSE 'none' END AS above, CAST(p_partkey AS VARCHAR) AS outermost,
       CASE WHEN level = deep THEN CAST(p_partkey AS VARCHAR) ELSE 'no' END AS leaf
FROM d
""")
def nested_list_records(spark, sf_dir):
    """Records inside records: ``ancestor`` axes, ``position()``, ``last()`` and ``count()``."""
    return extract_records(parsed_nodes(nested_list_pages(spark, sf_dir)), ITEM_XPATH, "xpath")


ODD_CSS = {"name": "odd", "baseSelector": "div.card:nth-child(2n+1)", "fields": [
    {"name": "name", "selector": "h2:first-of-type", "type": "text"},
    {"name": "size", "selector": "ul > li:nth-of-type(even)", "type": "text"},
    {"name": "kind", "selector": "li:nth-child(odd)", "type": "text"}]}


@register("css_position_records", """
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY rn) AS BIGINT) AS item_no, name, size, kind
FROM (SELECT p_partkey // 10 AS page_id, p_name AS name, 'size ' || p_size AS size, p_type AS kind,
             row_number() OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey) AS rn FROM part)
WHERE rn % 2 = 1
""")
def css_position_records(spark, sf_dir):
    """``:nth-child(an+b)``, ``odd``, ``even`` and the of-type positions."""
    return extract_records(parsed_nodes(product_pages(spark, sf_dir)), ODD_CSS, "css")


@register("html_tables", """
SELECT c_custkey // 50 AS page_id, CAST(1 AS BIGINT) AS table_no,
       CAST(row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey) AS BIGINT) AS row_no,
       CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment,
       CAST(c_nationkey AS VARCHAR) AS nation, 'Customers ' || (c_custkey // 50) AS caption,
       'Key|Name|Segment|Nation' AS headers,
       5 + CASE WHEN count(*) OVER (PARTITION BY c_custkey // 50) >= 2 THEN 1 ELSE 0 END AS score
FROM customer
""")
def html_tables(spark, sf_dir):
    pages = customer_table_pages(spark, sf_dir)
    t = page_tables(parsed_nodes(pages, container_text=False))
    rows = t.select("page_id", F.col("table_no").cast("long").alias("table_no"), "caption",
                    F.array_join("headers", "|").alias("headers"), "score",
                    F.posexplode("rows").alias("i", "r"))
    return rows.select("page_id", "table_no", (F.col("i") + 1).cast("long").alias("row_no"),
                       F.col("r")[0].alias("key"), F.col("r")[1].alias("name"), F.col("r")[2].alias("segment"),
                       F.col("r")[3].alias("nation"), "caption", "headers", "score")


@register("link_split_synthetic", """
WITH s AS (SELECT s_suppkey AS k, 'shop' || (s_suppkey % 5) AS shop FROM supplier),
slots AS (
  SELECT k, 1 AS pos, 'internal' AS kind, '/same/' || k AS href, 'https://www.' || shop || '.example.com/same/' || k AS abs_url,
         'Same' AS text, NULL AS title FROM s
  UNION ALL SELECT k, 2, 'internal', 'https://api.' || shop || '.example.com/x', 'https://api.' || shop || '.example.com/x', 'Sub', NULL FROM s
  UNION ALL SELECT k, 3, 'external', 'https://other' || (k % 3) || '.test/y', 'https://other' || (k % 3) || '.test/y', 'Other', NULL FROM s
  UNION ALL SELECT k, 4, 'internal', '../up/' || k, 'https://www.' || shop || '.example.com/up/' || k, NULL, NULL FROM s
  UNION ALL SELECT k, 5, 'internal', 'http://' || shop || '.example.com:8080/p', 'http://' || shop || '.example.com:8080/p', 'Port', 'Port page' FROM s
)
SELECT k AS page_id, CAST(pos AS BIGINT) AS pos, kind, href, abs_url, text, CAST(title AS VARCHAR) AS title FROM slots
""")
def link_split_synthetic(spark, sf_dir):
    pages = supplier_link_pages(spark, sf_dir)
    links = page_links(html_nodes(pages, container_text=False), pages)
    return links.select("page_id", F.col("pos").cast("long").alias("pos"), "kind", "href", "abs_url", "text",
                        "title")


@register("code_kept", """
SELECT p_partkey // 10 AS page_id, CAST(3 * count(*) AS BIGINT) AS n_blocks, CAST(2 * count(*) AS BIGINT) AS n_kept,
       CAST(count(*) AS BIGINT) AS n_code_kept,
       CAST(sum(12 + 2 * len(string_split(p_name, ' '))) AS BIGINT) AS kept_words
FROM part GROUP BY 1
""")
def code_kept(spark, sf_dir):
    b = density_prune(page_blocks(html_nodes(code_pages(spark, sf_dir), container_text=False)))
    return b.groupBy("page_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_blocks"),
        F.count_if("kept").cast("long").alias("n_kept"),
        F.count_if(F.col("kept") & (F.col("tag") == "pre")).cast("long").alias("n_code_kept"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("n_words"))), F.lit(0)).cast("long").alias("kept_words"))


SCOPED = {"name": "bold", "baseSelector": "p", "fields": [{"name": "bold", "selector": "b", "type": "text"}]}


@register("scoped_records", f"""
WITH src AS (SELECT page_id, regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS art FROM pages),
segs AS (
  SELECT page_id, unnest(ps) AS seg, generate_subscripts(ps, 1) AS o
  FROM (SELECT page_id, list_slice(string_split(art, '<p>'), 2, len(string_split(art, '<p>'))) AS ps FROM src)
)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY o) AS BIGINT) AS item_no,
       {S.collapse(S.unescape(S.strip_tags("replace(regexp_extract(seg, '(?s)<b>(.*)$', 1), '<br>', ' ')")))} AS bold
FROM segs WHERE seg LIKE '%<b>%'
""")
def scoped_records(spark, sf_dir):
    """EXT5: the page is narrowed to ``article`` (always CSS) before the schema runs."""
    return extract_records(parsed_nodes(_pages(spark, sf_dir)), SCOPED, "css", css_selector="article")
