"""Inputs on which one bad row must not end the job."""

import gzip

from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions import urls as U
from pagewright.operators.blocks import bm25_within
from pagewright.operators.config import overlay, profiles_table
from pagewright.operators.parse import html_nodes, parse_html
from pagewright.operators.sinks import read_pages, sink_dir, write_pages
from pagewright.operators.sitemap import parse_sitemaps


def test_marked_sections_are_bogus_comments(spark):
    bad = ["<p>a</p><![foo[x]]><p>b</p>", "<![CDATA[ q ]]><p>c</p>", "<p>d<![x[", "<![", "\0<p>e", "", "<p>f</p><!ENTITY x><p>g"]
    texts = ["".join(e.own[0] if e.own else "" for e in sorted(parse_html(h), key=lambda e: e.pre) if e.tag == "p") for h in bad]
    assert [t[:1] for t in texts] == ["a", "c", "d", "", "e", "", "f"]
    assert texts[0] == "ab" and texts[-1] == "fg"
    pages = spark.createDataFrame(list(enumerate([*bad, None])), "page_id long, html string")
    assert html_nodes(pages).where("tag = 'p'").count() == 7


def test_bad_sitemap_bytes_are_not_xml(spark):
    xml = "<urlset><url><loc>https://x.org/{}</loc></url></urlset>"
    good = gzip.compress(xml.format("ok").encode())
    latin = ('<?xml version="1.0" encoding="ISO-8859-1"?>' + xml.format("caf\xe9")).encode("latin-1")
    docs = [("ok", good), ("cut", good[:-9]), ("bytes", b"\xff\xfe\x00<x"), ("latin", latin),
            ("bom", b"\xef\xbb\xbf" + xml.format("bom").encode()), ("html", b"<html><br></html")]
    df = spark.createDataFrame([(n, n, bytearray(c), None) for n, c in docs],
                               "sitemap_url string, final_url string, content binary, fetch_error string")
    status, entries = parse_sitemaps(df)
    got = {r.sitemap_url: r.status for r in status.collect()}
    assert got == {"ok": "ok", "cut": "not_xml", "bytes": "not_xml", "latin": "ok", "bom": "ok", "html": "not_xml"}
    assert {r.sitemap_url for r in entries.collect()} == {"ok", "latin", "bom"}


def test_bm25_of_wordless_texts(spark):
    df = spark.createDataFrame([(1, []), (2, [(1, "..."), (2, "!")]), (3, [(1, "alpha beta"), (2, "gamma")]), (4, [(1, "")])],
                               "doc_id long, b array<struct<no:int,text:string>>")
    got = [(r.doc_id, r.no) for r in bm25_within(df, "doc_id", "b", "alpha", 0.0001).collect()]
    assert got == [(3, 1)]


def test_override_that_is_no_number_is_reported(spark):
    req = spark.createDataFrame([(1, "default", {"word_count_threshold": "abc"}), (2, "default", {"word_count_threshold": "7"})],
                                "id int, profile string, overrides map<string,string>")
    got = {r.id: (r.word_count_threshold, list(r.ignored_keys)) for r in overlay(req, profiles_table(spark)).collect()}
    assert got[2] == (7, []) and got[1][0] == 10 and "word_count_threshold" in got[1][1]


def test_white_space_and_addresses(spark):
    df = spark.createDataFrame([("\n",), ("\t",), ("\n T \t",), (" \u00a0x",), (None,)], "s string")
    assert [r.c for r in df.select(T.clean_str("s").alias("c")).collect()] == [None, None, "T", "x", None]
    hosts = spark.createDataFrame([("10.0.1.1",), ("192.168.1.1",), ("a.b.example.org",)], "h string")
    assert [r.d for r in hosts.select(U.registrable_domain("h").alias("d")).collect()] == ["10.0.1.1", "192.168.1.1", "example.org"]


def test_second_crawl_adds_to_the_folder(spark):
    out = sink_dir(spark)
    first = [("https://x.org/a", True, "a1", 1), ("https://x.org/b", True, "b1", 2), ("https://x.org/b", True, "b2", 3)]
    second = [("https://x.org/b", True, "b3", 1), ("https://x.org/c", True, "c1", 2), ("https://x.org/d", False, None, 3)]
    for rows in (first, second):
        write_pages(spark.createDataFrame(rows, "url string, success boolean, content string, rank int"), out)
    got = {r.url[-1]: r.content for r in read_pages(spark, out).select("url", F.col("content")).collect()}
    assert got == {"a": "a1", "b": "b3", "c": "c1"}
