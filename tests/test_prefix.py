"""Distributed prefix scan: equal to plain windows for sparse, bursty, NULL and hot keys, in even pieces."""

import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.operators import prefix

N = 40_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with a third of all rows, NULL keys, ids sparse over 64 bits, half of the times in one hour."""
    i = F.col("id")
    return spark.range(N).select(
        F.xxhash64("id").alias("seq"), (i * 7919 % 101).alias("v"), i.alias("_piece"),
        F.when(i % 3 == 0, 0).when(i % 5 != 0, i % 300).alias("k"),
        F.when(i % 2 == 0, 5_000_000 + i % 3600).otherwise(i * 700).alias("t"))


def _same(a, b):
    assert a.columns == b.columns or sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.count() == b.count() == N and a.exceptAll(b).isEmpty()


@pytest.mark.parametrize("written", [True, False])
def test_equal_to_windows(skewed, written):
    df, w = skewed, Window.partitionBy("k").orderBy("seq")
    sofar = w.rowsBetween(Window.unboundedPreceding, 0)
    _same(prefix.row_number(df, ["k"], ["seq"], written=written), df.withColumn("rn", F.row_number().over(w).cast("long")))
    _same(prefix.lag(df, ["k"], ["seq"], "v", "v2", written=written), df.withColumn("v2", F.lag("v").over(w)))
    _same(prefix.running_sum(df, ["k"], ["seq"], "v", "s", written=written), df.withColumn("s", F.sum("v").over(sofar)))
    _same(prefix.running_count(df, ["k"], ["seq"], written=written),
          df.withColumn("done", F.count(F.lit(1)).over(sofar)).withColumn("total", F.count(F.lit(1)).over(Window.partitionBy("k"))))


def test_sessions(skewed):
    w = Window.partitionBy("k").orderBy("t", "seq")
    new = (F.col("p").isNull() | (F.col("t") - F.col("p") >= 40)).cast("long")
    want = skewed.withColumn("p", F.lag("t").over(w)) \
        .withColumn("session_no", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("p")
    _same(prefix.sessions(skewed, ["k"], ["t", "seq"], "t", 40, written=False), want)


@pytest.mark.parametrize("order", [["seq"], ["t", "seq"]])
def test_no_task_above_twice_the_median(spark, skewed, order):
    """Rows of each task after the shuffle by key and piece; one key holds a third of them."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = prefix.Pieces(skewed.drop("_piece"), ["k"], order)
    sizes = p.rows.groupBy(F.pmod(F.hash("_key", "_piece"), F.lit(tasks)).alias("task")).count().collect()
    sizes = [r["count"] for r in sizes]
    assert len(sizes) == tasks and max(sizes) <= 2 * statistics.median(sizes)
    largest = p.rows.groupBy("_key", "_piece").count().agg(F.max("count")).first()[0]
    assert largest <= 4 * N / (prefix.PIECES_PER_TASK * tasks)


def test_a_long_list_of_one_root(spark):
    """A sitemap of many pages (one root, array keys) is cut, too."""
    from pagewright.operators.sitemap import ordered_sitemap_urls
    urls = spark.range(20_000).select(F.lit("r").alias("root"), F.array(F.lit(1), (F.col("id") * 3).cast("int")).alias("key"),
                                      F.concat(F.lit("u"), "id").alias("url"))
    got = ordered_sitemap_urls(urls).collect()
    assert {r.pos: r.url for r in got} == {i + 1: f"u{i}" for i in range(20_000)}
    assert prefix.Pieces(urls, ["root"], ["key"]).rows.select("_piece").distinct().count() > 32


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "k string, seq long")
    assert prefix.row_number(empty, ["k"], ["seq"]).collect() == []
    one = spark.createDataFrame([(None, None)], "k string, seq long")
    assert [tuple(r) for r in prefix.row_number(one, ["k"], ["seq"]).collect()] == [(None, None, 1)]
