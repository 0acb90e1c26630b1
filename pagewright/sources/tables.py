"""Table loaders: the driver's parquet tables and the snapshot view of ``pages``."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import urls

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


# Text-heavy tables: per-row work is expensive, so a table of a few MB (one row group, one split)
# is spread over the cores. Decided on the plan's file sizes; larger tables have splits enough.
SPREAD_BELOW_BYTES = 64 << 20
_SPREAD = {"pages": "page_id", "documents": "doc_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; column pruning and filters push into the parquet scan."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if name in _SPREAD and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < SPREAD_BELOW_BYTES:
        df = df.repartition(spark.sparkContext.defaultParallelism, _SPREAD[name])
    return df


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages(page_id,url,html)`` as a snapshot table: success = html IS NOT NULL.

    Columns the test data does not carry are NULL (status, headers, crawl stats ...).
    """
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", "url", "html",
        F.col("html").isNotNull().alias("success"),
        F.lit(None).cast("int").alias("status_code"),
        F.lit(None).cast("string").alias("error_message"),
        urls.host("url").alias("host"),
    )
