"""Skew-safe helpers equal the plain single-partition window results (hot key = 1/3 of rows)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.operators import prefix
from pagewright.operators.ranking import global_row_number, next_in_order


def _skewed(spark, n=3000):
    return spark.range(n).select(F.col("id").alias("seq"),
                                 F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("k"),
                                 ((F.col("id") * 7919) % 101).alias("v"))


def test_row_number(spark):
    df = _skewed(spark)
    a = prefix.row_number(df, ["k"], ["seq"], out="rn")
    b = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("seq")))
    assert sorted(a.select("seq", "rn").collect()) == sorted(b.select("seq", "rn").collect())


def test_lag_and_running_sum(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("seq")
    a = prefix.lag(df, ["k"], ["seq"], "v", out="lag")
    a = prefix.running_sum(a, ["k"], ["seq"], "v", out="rs")
    b = df.withColumn("lag", F.lag("v").over(w)).withColumn("rs", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(a.select("seq", "lag", "rs").collect()) == sorted(b.select("seq", "lag", "rs").collect())


def test_global_rank_and_next(spark):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("x"))
    got = [r.rn for r in global_row_number(df, ["x"]).orderBy("x").collect()]
    assert got == list(range(1, 501))
    hosts = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "host string")
    assert {r.host: r.next for r in next_in_order(hosts, "host").collect()} == {"a": "b", "b": "c", "c": None}


def test_top_k_large_path_equals_small_path(spark):
    from pagewright.operators.ranking import top_k
    df = spark.range(2000).select(((F.col("id") * 7919) % 2000).alias("x"), F.col("id"))
    small = [r.x for r in df.orderBy("x").limit(150).collect()]
    large = sorted(r.x for r in top_k(df, ["x"], 150).collect())
    assert sorted(small) == sorted(large) == list(range(150))


def test_rank_with_hashed_and_negative_ids(spark):
    from pyspark.sql import functions as F
    rows = [("a", 1 << 60, True), ("a", -(1 << 62), False), ("a", 5, False), ("a", -7, True), ("b", (1 << 62) + 3, True)]
    df = spark.createDataFrame(rows, "k string, seq long, ok boolean").withColumn("bad", (~F.col("ok")).cast("int"))
    got = prefix.row_number(df, ["k"], ["bad", "seq"], out="rn")
    want = {}
    for k in "ab":
        for n, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: (not r[2], r[1])), 1):
            want[r] = n
    assert {(r.k, r.seq, r.ok): r.rn for r in got.collect()} == want


def test_rank_of_a_sparse_hot_key(spark):
    import random
    rnd = random.Random(3)
    ids = list({rnd.randrange(-(1 << 62), 1 << 62) for _ in range(500)})
    df = spark.createDataFrame([("hot", i) for i in ids], "k string, seq long")
    got = {r.seq: r.rn for r in prefix.row_number(df, ["k"], ["seq"], out="rn").collect()}
    assert got == {v: n for n, v in enumerate(sorted(ids), 1)}
