"""Driver queries for pattern extraction over whole pages and whole documents (EXT9-EXT11)."""

from __future__ import annotations

from pagewright.operators.parse import parsed_nodes
from pagewright.operators.patterns import (BUILTIN_PATTERNS, NO_MATCHES_MSG, extract_patterns, located_patterns,
                                           pattern_summary, resolve_patterns)
from pagewright.plans.catalog import register
from pagewright.sources.synthetic import product_pages
from pagewright.sources.tables import table

ALL = list(BUILTIN_PATTERNS)
# Custom patterns of the patterns_custom query (merged with the default built-ins).
CUSTOM = {"license": "(?:Licensed|Released) under the [A-Za-z]+(?: License)?",
          "token_word": "[a-z]+ token"}


def _sql_list(specs):
    return ", ".join(f"('{lbl}', '{rx.replace(chr(39), chr(39) * 2)}')" for lbl, rx in specs)


def _oracle(tbl: str, key: str, text: str, specs) -> str:
    """Independent oracle: one regexp_extract_all per (label, regex) row, unnested with ordinals."""
    parts = []
    for lbl, rx in specs:
        rxs = rx.replace("'", "''")
        parts.append(f"""
  SELECT {key}, '{lbl}' AS label, unnest(m) AS value, generate_subscripts(m, 1) AS pos
  FROM (SELECT {key}, regexp_extract_all({text}, '{rxs}') AS m FROM {tbl})""")
    body = "\n  UNION ALL".join(parts)
    return f"SELECT {key}, label, CAST(pos AS BIGINT) AS pos, value FROM ({body}\n) WHERE value IS NOT NULL"


@register("patterns_pages", _oracle("pages", "page_id", "html", [(n, BUILTIN_PATTERNS[n]) for n in ALL]))
def patterns_pages(spark, sf_dir):
    specs = resolve_patterns(spark, ALL)
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return extract_patterns(pages, "html", ["page_id"], specs)


@register("patterns_documents", _oracle("documents", "doc_id", "text", [(n, BUILTIN_PATTERNS[n]) for n in ALL]))
def patterns_documents(spark, sf_dir):
    specs = resolve_patterns(spark, ALL)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return extract_patterns(docs, "text", ["doc_id"], specs)


@register("patterns_custom", _oracle("documents", "doc_id", "text",
                                     [("email", BUILTIN_PATTERNS["email"]), ("url", BUILTIN_PATTERNS["url"])]
                                     + list(CUSTOM.items())))
def patterns_custom(spark, sf_dir):
    specs = resolve_patterns(spark, None, CUSTOM)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return extract_patterns(docs, "text", ["doc_id"], specs)


@register("pattern_summary", f"""
WITH m AS ({_oracle("pages", "page_id", "html", [("email", BUILTIN_PATTERNS["email"]), ("url", BUILTIN_PATTERNS["url"])])}),
c AS (SELECT page_id, count(*) AS n FROM m GROUP BY 1)
SELECT p.page_id, CAST(coalesce(c.n, 0) AS BIGINT) AS count,
       CASE WHEN coalesce(c.n, 0) = 0 THEN '{NO_MATCHES_MSG}' END AS error
FROM pages p LEFT JOIN c USING (page_id)
""")
def pattern_summary_q(spark, sf_dir):
    """EXT8/EXT10: default patterns (email, url) per page; zero matches carry the no-match error."""
    specs = resolve_patterns(spark, None)
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return pattern_summary(extract_patterns(pages, "html", ["page_id"], specs), pages, "page_id")


@register("scoped_patterns", _oracle("art", "page_id", "html", [(n, BUILTIN_PATTERNS[n]) for n in ALL]).replace(
    "SELECT page_id, label, CAST", "WITH art AS (SELECT page_id, regexp_extract(html, '(?s)<article[^>]*>.*?</article>') AS html FROM pages) "
    "SELECT page_id, label, CAST", 1))
def scoped_patterns(spark, sf_dir):
    """EXT9 with ``css_selector``: every built-in pattern inside ``article`` only."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    found = located_patterns(pages, parsed_nodes(pages, container_text=False), resolve_patterns(spark, ALL), "article")
    return found.select("page_id", "label", "pos", "value")


PLACED = {"price": "[$][0-9]+[.][0-9]{2}", "size": "size [0-9]+", "part": "/part/[0-9]+", "open": "<h2 class"}


@register("pattern_holders", """
WITH m AS (
  SELECT p_partkey, p_partkey // 10 AS page_id, 'price' AS label, '$' || printf('%.2f', p_retailprice) AS value, 'span' AS tag FROM part WHERE p_partkey % 7 <> 0
  UNION ALL SELECT p_partkey, p_partkey // 10, 'size', 'size ' || p_size, 'li' FROM part
  UNION ALL SELECT p_partkey, p_partkey // 10, 'part', '/part/' || p_partkey, 'a' FROM part
  UNION ALL SELECT p_partkey, p_partkey // 10, 'open', '<h2 class', 'h2' FROM part)
SELECT page_id, label, CAST(row_number() OVER (PARTITION BY page_id, label ORDER BY p_partkey) AS BIGINT) AS pos, value, tag FROM m
""")
def pattern_holders(spark, sf_dir):
    """Which element holds each match: texts, attribute values and tags, inside the cards."""
    pages = product_pages(spark, sf_dir)
    specs = resolve_patterns(spark, [], PLACED)
    return located_patterns(pages, parsed_nodes(pages, container_text=False), specs, "div.card").select("page_id", "label", "pos", "value", "tag")
