"""URL functions (SC1, SC2, TRV5, TRV6)."""

import pytest
from pyspark.sql import functions as F

from pagewright.functions import urls as U

BASE = "http://host.example.com/a/b/c?q=1#f"
CASES = [
    ("https://other.org/x", "https://other.org/x"),
    ("//cdn.example.net/y", "http://cdn.example.net/y"),
    ("/root", "http://host.example.com/root"),
    ("?z=2", "http://host.example.com/a/b/c?z=2"),
    ("#top", "http://host.example.com/a/b/c?q=1#top"),
    ("", "http://host.example.com/a/b/c?q=1"),
    ("d", "http://host.example.com/a/b/d"),
    ("../d", "http://host.example.com/a/d"),
    ("./d/../e", "http://host.example.com/a/b/e"),
    ("../../../../g", "http://host.example.com/g"),
    ("/für", "http://host.example.com/für"),
    ("mailto:a@b.c", "mailto:a@b.c"),
]


def test_resolve_url(spark):
    df = spark.createDataFrame([(BASE, h) for h, _ in CASES], "base string, href string")
    got = [r[0] for r in df.select(U.resolve_url("base", "href")).collect()]
    assert got == [w for _, w in CASES]


@pytest.mark.parametrize("url,host,dom", [
    ("https://User@Docs.Example.com:8080/x", "docs.example.com", "example.com"),
    ("http://a.b.co.uk/", "a.b.co.uk", "b.co.uk"),
    ("/relative", None, None),
])
def test_host_and_registrable_domain(spark, url, host, dom):
    r = spark.createDataFrame([(url,)], "u string").select(
        U.host("u").alias("h"), U.registrable_domain(U.host("u")).alias("d")).first()
    assert (r.h, r.d) == (host, dom)


def test_glob_and_domain_match(spark):
    df = spark.createDataFrame([("https://x.example.com/docs/a?b",), ("https://x.example.com/api/a",)], "u string")
    got = df.select(U.glob_match("u", "/docs/*").alias("p"), U.glob_match("u", "*api*").alias("f"),
                    U.domain_matches(U.host("u"), ["example.com"]).alias("d")).collect()
    assert [(r.p, r.f, r.d) for r in got] == [(True, False, True), (False, True, True)]
    port = spark.createDataFrame([("example.com:8080",)], "h string")
    assert port.select(U.domain_matches("h", ["example.com"])).first()[0] is False


def test_long_domain_lists(spark):
    hosts = [("a.site7.test",), ("site7.test",), ("xsite7.test",), ("SITE1999.test",), ("test",), (None,), ("",)]
    domains = [f"Site{i}.test" for i in range(2000)]
    got = spark.createDataFrame(hosts, "h string").select(U.domain_matches("h", domains).alias("d")).collect()
    assert [r.d for r in got] == [True, True, False, True, False, False, False]


def test_resolve_white_space_and_dots_in_every_branch(spark):
    from pagewright.functions.text import collapse_ws
    cases = {"\n../c ": "http://h/c", "\t\u00a0/x/./y\r\n": "http://h/x/y", "//g/../x": "http://g/x", "https://g/a/b/../c?q=../z#../f": "https://g/a/c?q=../z#../f",
             "mailto:a/../b@c": "mailto:a/../b@c", "https://g": "https://g", "//g?x": "http://g?x"}
    df = spark.createDataFrame([(h,) for h in cases], "h string")
    got = {r.h: r.u for r in df.select("h", U.resolve_url(F.lit("http://h/a/b"), "h").alias("u")).collect()}
    assert got == cases
    text = "\u00a0 a\u2003\u00a0b\x1c\nc\u3000"
    assert spark.createDataFrame([(text,)], "t string").select(collapse_ws("t")).first()[0] == " ".join(text.split())
