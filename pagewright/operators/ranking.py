"""Exact global ranks without a single-partition window.

Ranks per key are prefix scans (``prefix``); the ranks here are over a whole table: range partitions
on the order, numbered locally, offset by the sizes of the earlier partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import cut_lineage


def global_row_number(df: DataFrame, order_cols: list[str], out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Exact global ``row_number() OVER (ORDER BY order_cols)`` without a single-partition window.

    Range-partition on the ordering (sampled split points), number rows inside each range
    partition, and add the row count of all earlier partitions (a table with one row per
    partition). Ties across a partition boundary cannot occur: equal keys share a range.
    """
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    # written once: the split points are sampled, so a second evaluation could cut elsewhere
    ranged = cut_lineage(df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()), "ranged")
    local = Window.partitionBy("_pid").orderBy(*order_cols)
    ranged = ranged.withColumn("_lrn", F.row_number().over(local))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")  # one row per partition: bounded
            .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_pid", "_lrn", "_off"))


def next_in_order(df: DataFrame, key: str, out: str = "next") -> DataFrame:
    """``lead(key) OVER (ORDER BY key)`` for distinct keys, distributed (see global_row_number)."""
    ranked = global_row_number(df.select(key).distinct(), [key], out="_r")
    nxt = ranked.select((F.col("_r") - 1).alias("_r"), F.col(key).alias(out))
    return ranked.join(nxt, "_r", "left").drop("_r")


def top_k(df: DataFrame, order_cols: list[str], k: int) -> DataFrame:
    """First ``k`` rows by the named columns, from exact distributed ranks (any k)."""
    return global_row_number(df, order_cols, out="_rk").filter(F.col("_rk") <= k).drop("_rk")
