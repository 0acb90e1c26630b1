"""Public suffix lookup: wildcard and exception rules, clashes, bad hosts, large tables."""

import pytest
from pyspark.sql import functions as F

from pagewright.operators import domains

RULES = ["com", "sg", "com.sg", "github.io", "*.ck", "!www.ck", "jp", "*.kawasaki.jp", "!city.kawasaki.jp", "a.b.c.d", " COM ", ""]
CASES = {
    "foo.com.sg": ("com.sg", "foo.com.sg"), "x.foo.com.sg": ("com.sg", "foo.com.sg"), "com.sg": ("com.sg", None),
    "a.github.io": ("github.io", "a.github.io"), "github.io": ("github.io", None), "other.io": ("io", "other.io"),
    "x.ck": ("x.ck", None), "b.x.ck": ("x.ck", "b.x.ck"), "www.ck": ("ck", "www.ck"), "s.www.ck": ("ck", "www.ck"), "ck": ("ck", None),
    "city.kawasaki.jp": ("kawasaki.jp", "city.kawasaki.jp"), "q.r.kawasaki.jp": ("r.kawasaki.jp", "q.r.kawasaki.jp"),
    "kawasaki.jp": ("jp", "kawasaki.jp"), "z.a.b.c.d": ("a.b.c.d", "z.a.b.c.d"), "b.c.d": ("d", "c.d"),
    "WWW.Example.COM.": ("com", "example.com"), "localhost": ("localhost", None), "10.0.0.1": (None, "10.0.0.1"), "[::1]": (None, "[::1]"),
    "a..b": (None, None), "": (None, None), None: (None, None)}


@pytest.mark.parametrize("limit", [domains.BROADCAST_BYTES, 0])
def test_registrable(spark, monkeypatch, limit):
    monkeypatch.setattr(domains, "BROADCAST_BYTES", limit)
    rules = spark.createDataFrame([(r,) for r in RULES], "rule string")
    df = spark.createDataFrame([(h, "x", 1) for h in CASES], "host string, _labels string, key int")
    got = domains.with_registrable(df, F.col("host"), rules)
    assert got.columns == ["host", "_labels", "key", "public_suffix", "registrable"]
    assert {r.host: (r.public_suffix, r.registrable) for r in got.collect()} == CASES


def test_no_rules(spark):
    df = spark.createDataFrame([("a.b.c",)], "host string")
    got = domains.with_registrable(df, F.col("host"), spark.createDataFrame([], "rule string")).first()
    assert (got.public_suffix, got.registrable) == ("c", "b.c")
