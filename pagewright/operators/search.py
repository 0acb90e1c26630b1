"""Per-request content filters (PRJ3, PRJ4, SRC9): queries are joined with an inverted index.

``inverted_index`` turns the blocks of all pages into postings ``(page_id, term, pre, tf, dl, df)``
with the page's block count and mean length, one row per term and block, written once. A request
brings its own query and word threshold, which come out of its merged settings as columns; its terms
are exploded and joined on ``(page_id, term)``, so any number of different queries is one plan and
each touches only the postings of its terms. Requests without a query prune by density with their own
threshold. A block's terms are bounded by its page, a request's by its query; a page that many
requests ask for is split by AQE's skew join.

A query without a letter or digit matches no block: the request's fit content is empty and the raw
content holds, as for a query whose words do not occur. NULL and blank queries are no queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.operators.blocks import BM25_B, BM25_K1, BM25_MIN_SCORE, density_prune, tokens
from pagewright.session import materialize


def inverted_index(blocks: DataFrame) -> DataFrame:
    """Postings of ``blocks`` (``page_id, pre, text``) with all that BM25 needs beside the query."""
    page = Window.partitionBy("page_id")
    toks = blocks.select("page_id", "pre", tokens(F.col("text")).alias("toks")).withColumn("dl", F.size("toks"))
    # every key begins with the page: one shuffle, of blocks, serves all
    toks = toks.select("*", F.count(F.lit(1)).over(page).alias("n_blocks"), F.avg("dl").over(page).alias("avgdl"))
    words = toks.select("page_id", "pre", "dl", "n_blocks", "avgdl", F.explode("toks").alias("term"))
    tf = words.groupBy("page_id", "term", "pre", "dl", "n_blocks", "avgdl").agg(F.count(F.lit(1)).alias("tf"))
    return materialize(tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("page_id", "term"))), "postings")


def _bm25(k1: float = BM25_K1, b: float = BM25_B) -> Column:
    idf = F.log(F.lit(1.0) + (F.col("n_blocks") - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    norm = F.col("tf") + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / F.col("avgdl"))
    return idf * F.col("tf") * F.lit(k1 + 1.0) / norm


def asks(query: Column) -> Column:
    """Whether a request has a query at all."""
    return F.coalesce(F.trim(query) != "", F.lit(False))


def request_hits(index: DataFrame, requests: DataFrame, min_score: float = BM25_MIN_SCORE) -> DataFrame:
    """``request_id, pre, score`` of the blocks that answer each request's own ``query``."""
    terms = requests.filter(asks(F.col("query"))).select(
        "request_id", "page_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    found = terms.join(index, ["page_id", "term"]).groupBy("request_id", "pre").agg(F.sum(_bm25()).alias("score"))
    return found.filter(F.col("score") >= min_score).select("request_id", "pre", F.round("score", 6).alias("score"))


def request_blocks(blocks: DataFrame, requests: DataFrame) -> DataFrame:
    """The blocks of every request's page with ``kept`` by the request's own filter.

    ``requests``: ``request_id, page_id, query, word_count_threshold`` (settings merged by
    ``config.overlay``). The result is keyed by request: ``page_id`` holds the request.
    """
    blocks = materialize(blocks, "blocks")  # read by the index and by every request
    hits = request_hits(inverted_index(blocks), requests).select("request_id", "pre", F.lit(True).alias("_hit"))
    asked = requests.select("request_id", "page_id", asks(F.col("query")).alias("_asks"), F.col("word_count_threshold").alias("_words"))
    mine = density_prune(blocks.join(asked, "page_id"), F.col("_words"))
    mine = mine.join(hits, ["request_id", "pre"], "left")
    kept = F.when(F.col("_asks"), F.coalesce("_hit", F.lit(False))).otherwise(F.col("kept"))
    out = mine.withColumn("kept", kept)
    return out.select(*[F.col("request_id").alias(c) if c == "page_id" else c for c in blocks.columns], "kept")
