"""Driver queries for blocks, markdown, pruning, BM25 and scoping (PRJ2-PRJ9).

The oracles cut the page template apart with regexes (nav items, the ad box, the article
heading, paragraphs split on ``<p>``, the footer) - independent of our parser and tree rules.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.operators.blocks import (density_prune, fit_or_raw, page_blocks,
                                         page_markdown, page_markdown_fit_raw)
from pagewright.operators.parse import html_nodes, parsed_nodes
from pagewright.operators.project import page_links, page_metadata
from pagewright.operators.select import request_nodes, select_css, subtree, without_subtree
from pagewright.plans import sqlparts as S
from pagewright.plans.catalog import register
from pagewright.sources.tables import table

NL2 = "chr(10) || chr(10)"


def _text(x: str) -> str:
    return f"nullif({S.collapse(S.unescape(S.strip_tags(f'replace({x}, ' + chr(39) + '<br>' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')')))}, '')"


BLOCKS_CTE = f"""
src AS (
  SELECT page_id, url, html, regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS art FROM pages
),
raw_blocks AS (
  SELECT page_id, 1 AS grp, o AS ord, 'li' AS tag, outer_html, 0.0 AS tw FROM (
    SELECT page_id, unnest(m) AS outer_html, generate_subscripts(m, 1) AS o
    FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li>.*?</li>') AS m FROM src))
  UNION ALL
  SELECT page_id, 2, 1, 'div', regexp_extract(html, '(?s)<div class="ad">.*?</div>'), 0.5 FROM src
  UNION ALL
  SELECT page_id, 3, 1, 'h1', regexp_extract(art, '(?s)<h1>.*?</h1>'), 1.0 FROM src
  UNION ALL
  SELECT page_id, 4, o, 'p', '<p>' || seg, 1.0 FROM (
    SELECT page_id, unnest(parts) AS seg, generate_subscripts(parts, 1) AS o
    FROM (SELECT page_id, list_slice(string_split(art, '<p>'), 2, len(string_split(art, '<p>'))) AS parts FROM src))
  UNION ALL
  SELECT page_id, 5, 1, 'footer', regexp_extract(html, '(?s)<footer>.*?</footer>'), 0.0 FROM src
),
blocks0 AS (
  SELECT page_id, grp, ord, tag, tw, {_text('outer_html')} AS text, length(outer_html) AS html_len,
         coalesce(list_sum(list_transform(regexp_extract_all(outer_html, '(?s)<a\\s[^>]*>(.*?)</a>', 1),
                  lambda x: length(coalesce({_text('x')}, '')))), 0) AS link_text_len
  FROM raw_blocks WHERE outer_html <> ''
),
blocks AS (
  SELECT *, length(text) AS text_len, len(string_split(text, ' ')) AS n_words,
         0.4 * length(text) / greatest(html_len, 1) + 0.3 * (1 - link_text_len / greatest(length(text), 1)) + 0.3 * tw AS score,
         CASE WHEN tag = 'h1' THEN '# ' || text WHEN tag = 'li' THEN '- ' || text ELSE text END AS md
  FROM blocks0 WHERE text IS NOT NULL
),
blocks_k AS (SELECT *, score >= 0.48 AND n_words >= 10 AS kept FROM blocks)"""


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@register("body_paragraphs", f"""
WITH {BLOCKS_CTE.strip()}
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY ord) AS BIGINT) AS block_no, text,
       CAST(n_words AS BIGINT) AS n_words, CAST(text_len AS BIGINT) AS text_len
FROM blocks WHERE tag = 'p'
""")
def body_paragraphs(spark, sf_dir):
    blocks = page_blocks(html_nodes(_pages(spark, sf_dir), container_text=False)).filter(F.col("tag") == "p")
    w = Window.partitionBy("page_id").orderBy("pre")
    return blocks.select("page_id", F.row_number().over(w).cast("long").alias("block_no"), "text",
                         F.col("n_words").cast("long").alias("n_words"),
                         F.col("text_len").cast("long").alias("text_len"))


@register("pruned_blocks", f"""
WITH {BLOCKS_CTE.strip()}
SELECT page_id, CAST(count(*) AS BIGINT) AS n_blocks, CAST(count(*) FILTER (WHERE kept) AS BIGINT) AS n_kept,
       CAST(coalesce(sum(n_words) FILTER (WHERE kept), 0) AS BIGINT) AS kept_words,
       CAST(coalesce(sum(text_len) FILTER (WHERE kept), 0) AS BIGINT) AS kept_chars,
       CAST(count(*) FILTER (WHERE tag = 'li' AND kept) AS BIGINT) AS kept_nav_items
FROM blocks_k GROUP BY page_id
""")
def pruned_blocks(spark, sf_dir):
    b = density_prune(page_blocks(html_nodes(_pages(spark, sf_dir), container_text=False)))
    return b.groupBy("page_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_blocks"),
        F.count_if("kept").cast("long").alias("n_kept"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("n_words"))), F.lit(0)).cast("long").alias("kept_words"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("text_len"))), F.lit(0)).cast("long").alias("kept_chars"),
        F.count_if(F.col("kept") & (F.col("tag") == "li")).cast("long").alias("kept_nav_items"))


@register("fit_or_raw", f"""
WITH {BLOCKS_CTE.strip()},
md AS (
  SELECT page_id, string_agg(md, {NL2} ORDER BY grp, ord) AS raw,
         coalesce(string_agg(md, {NL2} ORDER BY grp, ord) FILTER (WHERE kept), '') AS fit
  FROM blocks_k GROUP BY page_id
)
SELECT p.page_id,
       CASE WHEN coalesce(md.fit, '') <> '' THEN 'fit' WHEN md.raw IS NOT NULL THEN 'raw' ELSE 'empty' END AS source,
       coalesce(nullif(md.fit, ''), md.raw, '') AS content
FROM pages p LEFT JOIN md ON md.page_id = p.page_id
""")
def fit_or_raw_q(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    blocks = density_prune(page_blocks(html_nodes(pages, container_text=False)))
    out = pages.select("page_id").join(page_markdown_fit_raw(blocks), "page_id", "left")
    fit_c = F.coalesce(F.col("fit"), F.lit(""))
    return out.select(
        "page_id",
        F.when(fit_c != "", "fit").when(F.col("raw").isNotNull(), "raw").otherwise("empty").alias("source"),
        fit_or_raw(fit_c, F.col("raw")).alias("content"))


BM25_QUERY = "the tion ment"


def _doc_lines_sql() -> str:
    return """
lines AS (
  SELECT doc_id, CAST(generate_subscripts(ls, 1) AS BIGINT) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
),
blk AS (SELECT * FROM lines WHERE trim(line) <> ''),
tok AS (SELECT doc_id, line_no, list_filter(string_split_regex(lower(line), '[^\\p{L}\\p{N}]+'), lambda t: t <> '') AS toks FROM blk),
lens AS (SELECT doc_id, line_no, len(toks) AS dl FROM tok),
stats AS (SELECT doc_id, count(*) AS n_blocks, avg(dl) AS avgdl FROM lens GROUP BY 1),
hits AS (SELECT doc_id, line_no, unnest(toks) AS term FROM tok),
tf AS (SELECT doc_id, line_no, term, count(*) AS tf FROM hits WHERE term IN ('the', 'tion', 'ment') GROUP BY 1, 2, 3),
dfs AS (SELECT doc_id, term, count(*) AS df FROM tf GROUP BY 1, 2),
sc AS (
  SELECT tf.doc_id, tf.line_no,
         sum(ln(1 + (s.n_blocks - d.df + 0.5) / (d.df + 0.5)) * tf.tf * 2.5
             / (tf.tf + 1.5 * (0.25 + 0.75 * l.dl / s.avgdl))) AS score
  FROM tf JOIN dfs d USING (doc_id, term) JOIN lens l USING (doc_id, line_no) JOIN stats s USING (doc_id)
  GROUP BY 1, 2
)"""


@register("bm25_blocks", f"""
WITH {_doc_lines_sql().strip()}
SELECT doc_id, line_no, round(score, 6) AS score FROM sc WHERE score >= 1.0
""")
def bm25_blocks(spark, sf_dir):
    from pagewright.operators.blocks import bm25_within
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # a document is one row: its non-blank lines become blocks inside the row (no shuffle)
    lines = F.filter(F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        (i + 1).cast("long").alias("no"), line.alias("text"))), lambda x: F.trim(x["text"]) != "")
    out = bm25_within(docs.select("doc_id", lines.alias("blocks")), "doc_id", "blocks", BM25_QUERY)
    return out.select("doc_id", F.col("no").alias("line_no"), "score")


# -- scoping (css_selector vs target_elements vs excluded_selector) ------------------------

SCOPE_SQL = f"""
WITH {BLOCKS_CTE.strip()},
{S.ANCHORS_CTE.strip()},
art_md AS (SELECT page_id, string_agg(md, {NL2} ORDER BY grp, ord) AS md FROM blocks WHERE grp IN (3, 4) GROUP BY 1),
nonav_md AS (SELECT page_id, string_agg(md, {NL2} ORDER BY grp, ord) AS md FROM blocks WHERE grp <> 1 GROUP BY 1),
art_links AS (
  SELECT page_id, count(*) AS n FROM (
    SELECT page_id, unnest(regexp_extract_all(art, '<a\\s[^>]*href="[^"]*[^" ][^"]*"')) FROM src) GROUP BY 1),
all_links AS (SELECT page_id, count(*) AS n FROM links_k GROUP BY 1),
nonav_links AS (
  SELECT page_id, count(*) AS n FROM (
    SELECT page_id, unnest(regexp_extract_all(regexp_replace({S.no_script('html')}, '(?s)<nav[^>]*>.*?</nav>', '', 'g'),
                                              '<a\\s[^>]*href="[^"]*[^" ][^"]*"')) FROM pages) GROUP BY 1)
"""


def _scoped(spark, sf_dir, mode: str):
    pages = _pages(spark, sf_dir)
    nodes = parsed_nodes(pages, container_text=False)
    if mode == "css_selector":
        scoped = subtree(nodes, select_css(nodes, "article"))
        meta_nodes, link_nodes, block_nodes = scoped, scoped, scoped
    elif mode == "target_elements":
        scoped = subtree(nodes, select_css(nodes, "article"))
        meta_nodes, link_nodes, block_nodes = nodes, nodes, scoped
    else:
        kept = without_subtree(nodes, select_css(nodes, "nav"))
        meta_nodes, link_nodes, block_nodes = kept, kept, kept
    meta = page_metadata(meta_nodes)
    n_links = page_links(link_nodes, pages, number=False).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n_links"))
    md = page_markdown(page_blocks(block_nodes), "markdown")
    out = pages.select("page_id").join(meta, "page_id", "left").join(n_links, "page_id", "left") \
        .join(md, "page_id", "left")
    return out.select("page_id", "title", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      "markdown")


@register("scope_article", SCOPE_SQL + """
SELECT p.page_id, CAST(NULL AS VARCHAR) AS title, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links, m.md AS markdown
FROM pages p LEFT JOIN art_md m USING (page_id) LEFT JOIN art_links l USING (page_id)
""")
def scope_article(spark, sf_dir):
    return _scoped(spark, sf_dir, "css_selector")


@register("target_article", SCOPE_SQL + f"""
SELECT p.page_id, {S.title('p.html')} AS title, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links, m.md AS markdown
FROM pages p LEFT JOIN art_md m USING (page_id) LEFT JOIN all_links l USING (page_id)
""")
def target_article(spark, sf_dir):
    return _scoped(spark, sf_dir, "target_elements")


@register("exclude_nav", SCOPE_SQL + f"""
SELECT p.page_id, {S.title('p.html')} AS title, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links, m.md AS markdown
FROM pages p LEFT JOIN nonav_md m USING (page_id) LEFT JOIN nonav_links l USING (page_id)
""")
def exclude_nav(spark, sf_dir):
    return _scoped(spark, sf_dir, "excluded_selector")


@register("request_scopes", f"""
WITH {BLOCKS_CTE.strip()},
r AS (SELECT page_id, k, (page_id + k) % 4 AS setting FROM pages, (SELECT unnest([0, 1]) AS k)),
md AS (
  SELECT r.page_id, k, string_agg(md, {NL2} ORDER BY grp, ord) AS markdown FROM r JOIN blocks b ON b.page_id = r.page_id
  WHERE setting = 0 OR setting = 1 AND grp IN (3, 4) OR setting = 2 AND grp <> 1 OR setting = 3 AND grp NOT IN (1, 5)
  GROUP BY 1, 2)
SELECT 2 * r.page_id + k AS request_id, page_id, markdown FROM r LEFT JOIN md USING (page_id, k)
""")
def request_scopes(spark, sf_dir):
    """Requests with different selectors, answered in one plan (two requests a page, four settings)."""
    pages = _pages(spark, sf_dir)
    setting = (F.col("page_id") + F.col("k")) % 4
    requests = pages.select("page_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select(
        (F.col("page_id") * 2 + F.col("k")).alias("request_id"), "page_id",
        F.when(setting == 1, "article").alias("css_selector"),
        F.when(setting == 2, "nav").when(setting == 3, "nav, footer").alias("excluded_selector"))
    nodes = request_nodes(parsed_nodes(pages, container_text=False), requests, ["article", "nav", "nav, footer"])
    md = page_markdown(page_blocks(nodes), "markdown").withColumnRenamed("page_id", "request_id")
    return requests.join(md, "request_id", "left").select("request_id", "page_id", "markdown")


# -- page options (excluded_tags, only_text, exclude_external_links) -------------------------

@register("page_options", f"""
WITH {BLOCKS_CTE.strip()},
{S.ANCHORS_CTE.strip()},
md AS (SELECT page_id, string_agg(text, {NL2} ORDER BY grp, ord) AS md FROM blocks WHERE grp NOT IN (1, 5) GROUP BY 1),
kept_links AS (
  SELECT page_id, count(*) AS n FROM (
    SELECT page_id, unnest(regexp_extract_all(
      regexp_replace(regexp_replace({S.no_script('html')}, '(?s)<nav[^>]*>.*?</nav>', '', 'g'),
                     '(?s)<footer[^>]*>.*?</footer>', '', 'g'),
      '<a\\s[^>]*href="[^"]*[^" ][^"]*"')) FROM pages) GROUP BY 1)
SELECT p.page_id, m.md AS markdown, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links
FROM pages p LEFT JOIN md m USING (page_id) LEFT JOIN kept_links l USING (page_id)
""")
def page_options(spark, sf_dir):
    from pagewright.operators.project import drop_tags, internal_only
    pages = _pages(spark, sf_dir)
    nodes = drop_tags(parsed_nodes(pages, container_text=False), ["nav", "footer"])
    md = page_markdown(page_blocks(nodes), "markdown", only_text=True)
    n_links = internal_only(page_links(nodes, pages, number=False)).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n_links"))
    out = pages.select("page_id").join(md, "page_id", "left").join(n_links, "page_id", "left")
    return out.select("page_id", "markdown", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


# -- content filter choice: query -> BM25 (PRJ4); profile word threshold -> pruning (SRC9) ----

FIT_QUERY = "the and ing"


@register("query_fit_markdown", f"""
WITH {BLOCKS_CTE.strip()},
tok AS (SELECT page_id, grp, ord, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '') AS toks
        FROM blocks),
lens AS (SELECT page_id, grp, ord, len(toks) AS dl FROM tok),
stats AS (SELECT page_id, count(*) AS n_blocks, avg(dl) AS avgdl FROM lens GROUP BY 1),
hits AS (SELECT page_id, grp, ord, unnest(toks) AS term FROM tok),
tf AS (SELECT page_id, grp, ord, term, count(*) AS tf FROM hits WHERE term IN ('the', 'and', 'ing') GROUP BY 1, 2, 3, 4),
dfs AS (SELECT page_id, term, count(*) AS df FROM tf GROUP BY 1, 2),
sc AS (
  SELECT tf.page_id, tf.grp, tf.ord,
         sum(ln(1 + (s.n_blocks - d.df + 0.5) / (d.df + 0.5)) * tf.tf * 2.5
             / (tf.tf + 1.5 * (0.25 + 0.75 * l.dl / s.avgdl))) AS score
  FROM tf JOIN dfs d USING (page_id, term) JOIN lens l USING (page_id, grp, ord) JOIN stats s USING (page_id)
  GROUP BY 1, 2, 3
),
k AS (SELECT b.*, coalesce(sc.score >= 1.0, false) AS kept FROM blocks b LEFT JOIN sc USING (page_id, grp, ord)),
md AS (
  SELECT page_id, string_agg(md, {NL2} ORDER BY grp, ord) AS raw,
         coalesce(string_agg(md, {NL2} ORDER BY grp, ord) FILTER (WHERE kept), '') AS fit
  FROM k GROUP BY page_id
)
SELECT p.page_id,
       CASE WHEN coalesce(md.fit, '') <> '' THEN 'fit' WHEN md.raw IS NOT NULL THEN 'raw' ELSE 'empty' END AS source,
       coalesce(nullif(md.fit, ''), md.raw, '') AS content
FROM pages p LEFT JOIN md ON md.page_id = p.page_id
""")
def query_fit_markdown(spark, sf_dir):
    """PRJ4: with a query, BM25 over each page's blocks replaces density pruning."""
    from pagewright.operators.blocks import fit_filter
    pages = _pages(spark, sf_dir)
    blocks = fit_filter(page_blocks(parsed_nodes(pages, container_text=False)), query=FIT_QUERY)
    out = pages.select("page_id").join(page_markdown_fit_raw(blocks), "page_id", "left")
    fit_c = F.coalesce(F.col("fit"), F.lit(""))
    return out.select(
        "page_id",
        F.when(fit_c != "", "fit").when(F.col("raw").isNotNull(), "raw").otherwise("empty").alias("source"),
        fit_or_raw(fit_c, F.col("raw")).alias("content"))


@register("profile_fit", f"""
WITH {BLOCKS_CTE.strip()},
req AS (
  SELECT page_id, CASE regexp_extract(url, '^[a-z]+://[^/]*/([a-z][a-z])/', 1)
                    WHEN 'en' THEN 'default' WHEN 'fr' THEN 'fast' WHEN 'de' THEN 'js_heavy'
                    WHEN 'es' THEN 'stealth' END AS profile
  FROM pages
),
w AS (SELECT page_id, profile, CASE WHEN profile = 'fast' THEN 5 ELSE 10 END AS wct FROM req)
SELECT w.page_id, w.profile, CAST(w.wct AS BIGINT) AS word_count_threshold,
       CAST(count(b.page_id) FILTER (WHERE b.score >= 0.48 AND b.n_words >= w.wct) AS BIGINT) AS n_kept,
       CAST(coalesce(sum(b.n_words) FILTER (WHERE b.score >= 0.48 AND b.n_words >= w.wct), 0) AS BIGINT) AS kept_words
FROM w LEFT JOIN blocks b ON b.page_id = w.page_id
GROUP BY 1, 2, 3
""")
def profile_fit(spark, sf_dir):
    """SRC9 -> PRJ3: each request's merged profile routes word_count_threshold into pruning."""
    from pagewright.operators.config import overlay, profiles_table
    pages = _pages(spark, sf_dir)
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]*/([a-z][a-z])/", 1)
    profile = (F.when(lang == "en", "default").when(lang == "fr", "fast").when(lang == "de", "js_heavy")
               .when(lang == "es", "stealth"))
    req = pages.select("page_id", profile.alias("profile"),
                       F.lit(None).cast("map<string,string>").alias("overrides"))
    req = overlay(req, profiles_table(spark)).select("page_id", "profile", "word_count_threshold")
    blocks = page_blocks(html_nodes(pages, container_text=False)).join(req.select("page_id", "word_count_threshold"), "page_id")
    kept = density_prune(blocks, F.col("word_count_threshold")).filter("kept")
    agg = kept.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_kept"), F.sum("n_words").alias("kept_words"))
    return req.join(agg, "page_id", "left").select(
        "page_id", "profile", F.col("word_count_threshold").cast("long").alias("word_count_threshold"),
        F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"),
        F.coalesce("kept_words", F.lit(0)).cast("long").alias("kept_words"))


# -- settings per request: every request brings its own query or threshold ----------------------

@register("request_queries", f"""
WITH {BLOCKS_CTE.strip()},
r AS (SELECT 2 * page_id + k AS request_id, page_id, (page_id + k) % 4 AS setting, {S.title('html')} AS title
      FROM pages, (SELECT unnest([0, 1]) AS k)),
req AS (SELECT request_id, page_id, CASE setting WHEN 1 THEN title WHEN 3 THEN 'the ' || page_id || ' and ing' END AS query,
               CASE setting WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE 10 END AS wct FROM r),
tok AS (SELECT page_id, grp, ord, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '') AS toks FROM blocks),
stats AS (SELECT page_id, count(*) AS n_blocks, avg(len(toks)) AS avgdl FROM tok GROUP BY 1),
tf AS (SELECT page_id, grp, ord, dl, term, count(*) AS tf FROM (SELECT page_id, grp, ord, len(toks) AS dl, unnest(toks) AS term FROM tok) GROUP BY ALL),
dfs AS (SELECT page_id, term, count(*) AS df FROM tf GROUP BY 1, 2),
q AS (SELECT DISTINCT request_id, page_id, unnest(list_filter(string_split_regex(lower(query), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) AS term FROM req),
sc AS (SELECT request_id, grp, ord, sum(ln(1 + (n_blocks - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS s
       FROM q JOIN tf USING (page_id, term) JOIN dfs USING (page_id, term) JOIN stats USING (page_id) GROUP BY 1, 2, 3),
k AS (SELECT req.request_id, b.grp, b.ord, b.md,
             CASE WHEN trim(req.query) <> '' THEN coalesce(sc.s >= 1.0, FALSE) ELSE b.score >= 0.48 AND b.n_words >= req.wct END AS kept
      FROM req JOIN blocks b USING (page_id) LEFT JOIN sc ON sc.request_id = req.request_id AND sc.grp = b.grp AND sc.ord = b.ord),
md AS (SELECT request_id, string_agg(md, {NL2} ORDER BY grp, ord) AS raw, coalesce(string_agg(md, {NL2} ORDER BY grp, ord) FILTER (WHERE kept), '') AS fit
       FROM k GROUP BY 1)
SELECT request_id, page_id, query, CAST(wct AS BIGINT) AS word_count_threshold,
       CASE WHEN coalesce(fit, '') <> '' THEN 'fit' WHEN raw IS NOT NULL THEN 'raw' ELSE 'empty' END AS source,
       coalesce(nullif(fit, ''), raw, '') AS content
FROM req LEFT JOIN md USING (request_id)
""")
def request_queries(spark, sf_dir):
    """Two requests a page, each with its own query or threshold out of its profile and overrides."""
    from pagewright.operators.config import overlay, profiles_table
    from pagewright.operators.search import request_blocks
    pages = _pages(spark, sf_dir)
    nodes = parsed_nodes(pages, container_text=False)
    setting = (F.col("page_id") + F.col("k")) % 4
    said = F.when(setting == 1, F.col("title")).when(setting == 3, F.concat(F.lit("the "), F.col("page_id").cast("string"), F.lit(" and ing")))
    overrides = F.when(said.isNotNull(), F.create_map(F.lit("query"), said)).when(
        setting == 2, F.create_map(F.lit("word_count_threshold"), F.lit("3")))
    requests = pages.select("page_id").join(page_metadata(nodes), "page_id", "left") \
        .select("page_id", "title", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select(
            (F.col("page_id") * 2 + F.col("k")).alias("request_id"), "page_id",
            F.when(setting == 3, "fast").alias("profile"), overrides.alias("overrides"))
    merged = overlay(requests, profiles_table(spark)).select("request_id", "page_id", "query", "word_count_threshold")
    blocks = request_blocks(page_blocks(nodes), merged)
    md = page_markdown_fit_raw(blocks).withColumnRenamed("page_id", "request_id")
    fit_c = F.coalesce(F.col("fit"), F.lit(""))
    return merged.join(md, "request_id", "left").select(
        "request_id", "page_id", "query", F.col("word_count_threshold").cast("long").alias("word_count_threshold"),
        F.when(fit_c != "", "fit").when(F.col("raw").isNotNull(), "raw").otherwise("empty").alias("source"),
        fit_or_raw(fit_c, F.col("raw")).alias("content"))
