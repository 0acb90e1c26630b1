"""Text blocks, markdown, density pruning and BM25 (PRJ2-PRJ5, PRJ7, PRJ9).

A *block* is a leaf block element (no block-level descendant) with non-empty text. Block
metrics come from one ``groupBy(page_id, block_pre)`` over the node table: the block row itself
plus the anchors and code elements inside it, so there is no self-join and the parse runs once.

Density pruning (after Kohlschuetter et al. 2010, shallow text features), per block:
``td = text_len / max(html_len,1)``, ``ld = 1 - link_text_len / max(text_len,1)``,
``tw`` = tag weight (0 when any ancestor-or-self is a zero-weight tag, else the weight of the
closest weighted ancestor-or-self, else the default), ``score = 0.4 td + 0.3 ld + 0.3 tw``.
Keep iff inside a preserved tag, or ``score >= threshold and n_words >= min_words``.

BM25 (Robertson and Zaragoza 2009) over the blocks of one document: tokens are lower-cased
runs of letters/digits; ``idf = ln(1 + (N - df + 0.5) / (df + 0.5))``, ``k1 = 1.5``,
``b = 0.75``, length normalised by the document's mean block length.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.operators import structure

# Tag weights of the pruning score.
TAG_WEIGHTS = {
    "article": 1.0, "main": 1.0, "p": 1.0, "h1": 1.0, "h2": 1.0, "h3": 1.0, "h4": 1.0, "h5": 1.0,
    "h6": 1.0, "pre": 1.0, "code": 1.0, "blockquote": 1.0, "table": 1.0,
    "li": 0.6, "td": 0.6, "section": 0.6,
    "div": 0.5,
    "nav": 0.0, "footer": 0.0, "aside": 0.0, "header": 0.0, "form": 0.0,
}
ZERO_WEIGHT_TAGS = ("nav", "footer", "aside", "header", "form")
DEFAULT_WEIGHT = 0.3
PRESERVE_TAGS = ("pre", "code")
PRUNE_THRESHOLD = 0.48
DEFAULT_MIN_WORDS = 10
BM25_K1 = 1.5
BM25_B = 0.75
BM25_MIN_SCORE = 1.0
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def page_blocks(nodes: DataFrame, preserve: tuple[str, ...] = PRESERVE_TAGS) -> DataFrame:
    """``(page_id, pre, tag, text, html_len, link_text_len, has_preserved, zero_weight, weighted, in_preserved, text_len, n_words)``.

    ``pre`` is the document-order key of the block. ``zero_weight`` and ``in_preserved``: the block is
    or is inside such an element; ``weighted``: the closest tag with a weight, the block's own first.
    """
    tag, is_block = F.col("tag"), F.col("pre") == F.col("block_pre")
    rows = nodes.select("page_id", "pre", structure.last().alias("last"), "tag", "block_pre",
                        F.when(is_block, F.col("text")).alias("text"), F.length("text").alias("text_len"),
                        (F.col("end_off") - F.col("start_off")).alias("html_len"))
    # of a block, its own row, its links and its preserved elements matter
    needed = (F.col("block_pre") >= 0) & (is_block | tag.isin("a", *preserve))
    found = structure.enclosing(rows, needed, or_self=True, inside={
        "zero_weight": tag.isin(*ZERO_WEIGHT_TAGS), "in_preserved": tag.isin(*preserve)}, nearest={
        "weighted": (tag.isin(*TAG_WEIGHTS), tag)})
    out = found.groupBy("page_id", "block_pre").agg(
        F.max_by(F.struct("tag", "text", "html_len", "zero_weight", "weighted", "in_preserved"),
                 F.when(is_block, F.lit(1)).otherwise(F.lit(0))).alias("b"),
        F.coalesce(F.sum(F.when((tag == "a") & ~is_block, F.col("text_len"))), F.lit(0)).alias("link_text_len"),
        F.max(tag.isin(*preserve)).alias("has_preserved"))
    out = out.select("page_id", F.col("block_pre").alias("pre"), "b.tag", "b.text", "b.html_len", "link_text_len",
                     "has_preserved", "b.zero_weight", "b.weighted", "b.in_preserved")
    out = out.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    return out.withColumn("text_len", F.length("text")) \
        .withColumn("n_words", F.size(F.split("text", " ")))


def tag_weight(zero: Column, closest: Column) -> Column:
    weights = F.create_map(*[x for k, v in TAG_WEIGHTS.items() for x in (F.lit(k), F.lit(v))])
    return F.when(zero, F.lit(0.0)).otherwise(F.coalesce(F.try_element_at(weights, closest), F.lit(DEFAULT_WEIGHT)))


def density_score(blocks: DataFrame) -> DataFrame:
    td = F.col("text_len") / F.greatest(F.col("html_len"), F.lit(1))
    ld = F.lit(1.0) - F.col("link_text_len") / F.greatest(F.col("text_len"), F.lit(1))
    tw = tag_weight(F.col("zero_weight"), F.col("weighted"))
    return blocks.withColumn("score", F.lit(0.4) * td + F.lit(0.3) * ld + F.lit(0.3) * tw)


def density_prune(blocks: DataFrame, min_words: int | Column | None = None,
                  threshold: float = PRUNE_THRESHOLD) -> DataFrame:
    """PRJ3: adds ``score`` and ``kept`` to the blocks.

    ``min_words`` may be a column, so a per-request ``word_count_threshold`` (profile overlay)
    applies row by row.
    """
    mw = F.lit(DEFAULT_MIN_WORDS) if min_words is None else (
        min_words if isinstance(min_words, Column) else F.lit(min_words))
    scored = density_score(blocks)
    kept = F.col("has_preserved") | F.col("in_preserved") | ((F.col("score") >= threshold) & (F.col("n_words") >= mw))
    return scored.withColumn("kept", kept)


def block_markdown(tag: Column, text: Column, only_text: bool = False) -> Column:
    """Markdown of one block: headings, list items, quotes, fenced pre; plain text otherwise."""
    if only_text:
        return text
    heading = F.regexp_extract(tag, r"^h([1-6])$", 1)
    return (F.when(heading != "", F.concat(F.repeat(F.lit("#"), heading.cast("int")), F.lit(" "), text))
            .when(tag == "li", F.concat(F.lit("- "), text))
            .when(tag == "blockquote", F.concat(F.lit("> "), text))
            .when(tag == "pre", F.concat(F.lit("```\n"), text, F.lit("\n```")))
            .otherwise(text))


def page_markdown(blocks: DataFrame, out: str = "markdown", only_text: bool = False) -> DataFrame:
    """PRJ2: blocks joined by a blank line in document order, one row per page."""
    item = F.struct(F.col("pre"), block_markdown(F.col("tag"), F.col("text"), only_text).alias("md"))
    return blocks.groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["md"]), "\n\n").alias(out))


def page_markdown_fit_raw(blocks: DataFrame, only_text: bool = False) -> DataFrame:
    """PRJ2 + PRJ3 in one aggregation: ``raw`` (all blocks) and ``fit`` (kept blocks) per page."""
    item = F.struct(F.col("pre"), block_markdown(F.col("tag"), F.col("text"), only_text).alias("md"))

    def joined(arr):
        return F.array_join(F.transform(F.array_sort(arr), lambda x: x["md"]), "\n\n")
    return blocks.groupBy("page_id").agg(
        joined(F.collect_list(item)).alias("raw"),
        joined(F.collect_list(F.when(F.col("kept"), item))).alias("fit"))


def fit_or_raw(fit: Column, raw: Column) -> Column:
    """PRJ5: fit if non-empty, else raw, else ''."""
    return F.coalesce(F.when(fit != "", fit), raw, F.lit(""))


# ---------------------------------------------------------------------------------------------
# BM25

def query_terms(query: str) -> list[str]:
    """Tokenise the query on the driver with the same rule as the blocks (tiny, fixed)."""
    seen, out = set(), []
    for t in re.split(r"[^\w]+|_", query.lower()):
        if t and t not in seen:
            seen.add(t)
            out.append(t)
    return out


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


def bm25(blocks: DataFrame, doc_key: str, block_key: str, text_col: str, query: str,
         min_score: float = BM25_MIN_SCORE, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """PRJ4: ``(doc_key, block_key, score)`` for blocks scoring >= min_score (score rounded 6).

    Only query terms are exploded; document statistics are map-side-combined aggregates joined
    back on the document key (AQE splits a hot document on the join side).
    """
    terms = query_terms(query)
    if not terms:
        raise ValueError("query must contain at least one letter or digit")
    toks = blocks.select(doc_key, block_key, tokens(F.col(text_col)).alias("toks"))
    lens = toks.select(doc_key, block_key, F.size("toks").alias("dl"))
    stats = lens.groupBy(doc_key).agg(F.count(F.lit(1)).alias("n_blocks"), F.avg("dl").alias("avgdl"))
    qarr = F.array(*[F.lit(t) for t in terms])
    hits = toks.select(doc_key, block_key, F.explode(F.filter("toks", lambda t: F.array_contains(qarr, t)))
                       .alias("term"))
    tf = hits.groupBy(doc_key, block_key, "term").agg(F.count(F.lit(1)).alias("tf"))
    df_ = tf.groupBy(doc_key, "term").agg(F.count(F.lit(1)).alias("df"))
    j = tf.join(df_, [doc_key, "term"]).join(lens, [doc_key, block_key]).join(stats, doc_key)
    idf = F.log(F.lit(1.0) + (F.col("n_blocks") - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    norm = F.col("tf") + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / F.col("avgdl"))
    part = idf * F.col("tf") * F.lit(k1 + 1.0) / norm
    scores = j.groupBy(doc_key, block_key).agg(F.sum(part).alias("score"))
    return scores.filter(F.col("score") >= min_score) \
        .select(doc_key, block_key, F.round("score", 6).alias("score"))


def fit_filter(blocks: DataFrame, query: str | None = None, min_words: int | Column | None = None,
               min_score: float = BM25_MIN_SCORE) -> DataFrame:
    """PRJ3/PRJ4: the content filter behind fit markdown; adds ``kept``.

    A non-empty ``query`` replaces density pruning entirely: BM25 over the blocks of each page
    (documents = the page's blocks), keep ``score >= min_score``; the pruning threshold and
    word minimum are then unused. Otherwise density pruning with ``min_words``.
    """
    if query is None or not query.strip():
        return density_prune(blocks, min_words)
    # one group per page (bounded by page size), then BM25 inside the row
    per_page = blocks.groupBy("page_id").agg(
        F.collect_list(F.struct(F.col("pre").alias("no"), F.col("text").alias("text"))).alias("_blocks"))
    scores = bm25_within(per_page, "page_id", "_blocks", query, min_score)
    hit = scores.select("page_id", F.col("no").alias("pre"), F.lit(True).alias("_hit"))
    return blocks.join(hit, ["page_id", "pre"], "left") \
        .withColumn("kept", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def bm25_within(df: DataFrame, key: str, blocks_col: str, query: str, min_score: float = BM25_MIN_SCORE,
                k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """BM25 where one row holds a whole document: ``blocks_col`` is ``array<struct<no, text>>``.

    Everything (token arrays, document frequencies, mean block length, scores) is computed with
    higher-order functions inside the row - no shuffle. The query terms are fixed at plan time,
    so their loop is unrolled. Returns ``(key, no, score)`` for blocks with score >= min_score.
    """
    terms = query_terms(query)
    if not terms:
        raise ValueError("query must contain at least one letter or digit")
    toks = F.transform(F.col(blocks_col), lambda x: F.struct(x["no"].alias("no"), tokens(x["text"]).alias("t")))
    d = df.select(key, toks.alias("_b"))
    n = F.size("_b").cast("double")
    # a text without blocks or words has no mean length: its blocks score 0
    avgdl = F.try_divide(F.aggregate(F.col("_b"), F.lit(0.0), lambda acc, x: acc + F.size(x["t"])), n)
    d = d.withColumn("_n", n).withColumn("_avgdl", avgdl)
    for j, term in enumerate(terms):
        df_j = F.size(F.filter("_b", lambda x: F.array_contains(x["t"], term))).cast("double")
        d = d.withColumn(f"_idf{j}", F.log(F.lit(1.0) + (F.col("_n") - df_j + F.lit(0.5)) / (df_j + F.lit(0.5))))

    def score(x):
        dl = F.size(x["t"]).cast("double")
        norm_len = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.coalesce(F.try_divide(dl, F.col("_avgdl")), F.lit(0.0)))
        total = F.lit(0.0)
        for j, term in enumerate(terms):
            tf = F.size(F.filter(x["t"], lambda t: t == term)).cast("double")
            total = total + F.col(f"_idf{j}") * tf * F.lit(k1 + 1.0) / (tf + norm_len)
        return F.struct(x["no"].alias("no"), total.alias("score"))

    scored = d.select(key, F.explode(F.transform("_b", score)).alias("s"))
    return scored.filter(F.col("s.score") >= min_score) \
        .select(key, F.col("s.no").alias("no"), F.round("s.score", 6).alias("score"))
