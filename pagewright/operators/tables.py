"""Data tables from the node table (PRJ12) and the data-table score (2.13-c).

Cells are ``td``/``th`` nodes; their row is the nearest ``tr`` ancestor and their table the
nearest ``table`` ancestor, found in one structural pass per page (``structure.enclosing``). Result
``(page_id, table_no, headers, rows, caption, score)`` with ordered ``collect_list``s.

Score: +2 any th/thead, +1 caption, +1 equal row widths, +1 rows >= 2, +1 cols >= 2,
-3 contains a nested table, -2 ``role=presentation``. Tables scoring >= ``min_score`` are data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.operators import structure

DEFAULT_MIN_SCORE = 4


def _placed(nodes: DataFrame) -> DataFrame:
    """Cells, captions and tables with their nearest table and row, and whether a ``thead`` holds them."""
    tag = F.col("tag")
    rows = nodes.select("page_id", "pre", structure.last().alias("last"), "tag", "text")
    return structure.enclosing(
        rows, tag.isin("td", "th", "caption", "table"), inside={"in_thead": tag == "thead"},
        nearest={"table_pre": (tag == "table", F.col("pre")), "tr_pre": (tag == "tr", F.col("pre"))})


def page_tables(nodes: DataFrame, min_score: int = DEFAULT_MIN_SCORE) -> DataFrame:
    """Scored tables with headers/rows/caption; only tables with score >= min_score.

    Three aggregations in all: cells -> rows keyed by (table, tr); rows -> tables; captions and
    nested tables together keyed by their nearest table. Row and cell order come from ``pre``
    inside ordered ``collect_list``s, so no window is needed.
    """
    tables = nodes.filter(F.col("tag") == "table").select(
        "page_id", F.col("pre").alias("table_pre"),
        F.coalesce(F.lower(F.col("attrs")["role"]) == "presentation", F.lit(False)).alias("presentation"))
    placed = _placed(nodes).filter(F.col("table_pre").isNotNull())
    inner = placed.filter(F.col("tag").isin("table", "caption"))
    is_cap = F.col("tag") == "caption"
    meta = inner.groupBy("page_id", "table_pre").agg(
        F.max(F.col("tag") == "table").alias("has_nested"),
        F.min_by(F.when(is_cap, F.col("text")), F.when(is_cap, F.col("pre"))).alias("caption"))
    cells = placed.filter(F.col("tag").isin("td", "th") & F.col("tr_pre").isNotNull()).select(
        "page_id", "pre", F.coalesce(F.col("text"), F.lit("")).alias("value"),
        ((F.col("tag") == "th") | F.col("in_thead")).alias("is_header"), "table_pre", "tr_pre")
    rows = cells.groupBy("page_id", "table_pre", "tr_pre").agg(
        F.bool_and("is_header").alias("all_header"), F.max("is_header").alias("any_header"),
        F.count(F.lit(1)).alias("width"),
        F.transform(F.array_sort(F.collect_list(F.struct("pre", "value"))), lambda x: x["value"]).alias("vals"))
    stats = rows.groupBy("page_id", "table_pre").agg(
        F.max("any_header").alias("any_th"),
        F.min_by("vals", F.when(F.col("all_header"), F.col("tr_pre"))).alias("headers"),
        F.transform(F.array_sort(F.collect_list(F.when(~F.col("all_header"), F.struct("tr_pre", "vals")))),
                    lambda x: x["vals"]).alias("rows"),
        F.count_if(~F.col("all_header")).alias("n_rows"),
        F.max("width").alias("n_cols"),
        (F.min("width") == F.max("width")).alias("equal_widths"))
    t = tables.join(stats, ["page_id", "table_pre"], "left").join(meta, ["page_id", "table_pre"], "left")
    score = (F.when(F.coalesce(F.col("any_th"), F.lit(False)), 2).otherwise(0)
             + F.when(F.col("caption").isNotNull() & (F.col("caption") != ""), 1).otherwise(0)
             + F.when(F.coalesce(F.col("equal_widths"), F.lit(False)), 1).otherwise(0)
             + F.when(F.coalesce(F.col("n_rows"), F.lit(0)) >= 2, 1).otherwise(0)
             + F.when(F.coalesce(F.col("n_cols"), F.lit(0)) >= 2, 1).otherwise(0)
             - F.when(F.coalesce(F.col("has_nested"), F.lit(False)), 3).otherwise(0)
             - F.when(F.col("presentation"), 2).otherwise(0))
    out = t.withColumn("score", score).filter(F.col("score") >= min_score)
    w = Window.partitionBy("page_id").orderBy("table_pre")   # tables of one page
    out = out.withColumn("table_no", F.row_number().over(w))
    return out.select(
        "page_id", "table_no", "table_pre",
        F.when(F.col("headers").isNull(), F.array().cast("array<string>")).otherwise(F.col("headers")).alias("headers"),
        F.coalesce(F.col("rows"), F.array().cast("array<array<string>>")).alias("rows"),
        F.when(F.trim("caption") == "", None).otherwise(F.col("caption")).alias("caption"),
        F.col("score").cast("int").alias("score"))
