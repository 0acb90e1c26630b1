"""Sitemaps (SRC3-SRC7, FIXTURES F6)."""

import gzip

from pagewright.operators.sitemap import crawl_sitemap, expand_sitemaps, maybe_gunzip, ordered_sitemap_urls

DOC_SCHEMA = "sitemap_url string, final_url string, content binary, fetch_error string"
NS = "http://www.sitemaps.org/schemas/sitemap/0.9"


def _docs(spark, docs):
    rows = [(u, fu or u, (c.encode() if isinstance(c, str) else c), err) for u, fu, c, err in docs]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def _expand(spark, roots, docs):
    r = spark.createDataFrame([(x,) for x in roots], "root string")
    return [(x.root, x.url) for x in ordered_sitemap_urls(expand_sitemaps(spark, r, _docs(spark, docs)))
            .orderBy("root", "pos").collect()]


def test_urlset_namespaces_relative_and_zero_width(spark):
    docs = [("https://s.test/a.xml", None, f'<urlset xmlns="{NS}"><url><loc>https://s.test/1</loc></url>'
             f'<url><loc>https://s.test/2</loc></url></urlset>', None),
            ("https://s.test/b.xml", None, '<urlset><url><loc>​ /relative/page ﻿</loc></url></urlset>', None),
            ("https://s.test/c.xml", "https://final.test/dir/c.xml",
             '<urlset xmlns="http://www.google.com/schemas/sitemap/0.84"><url><loc>x</loc></url></urlset>', None)]
    got = _expand(spark, ["https://s.test/a.xml", "https://s.test/b.xml", "https://s.test/c.xml"], docs)
    assert got == [("https://s.test/a.xml", "https://s.test/1"), ("https://s.test/a.xml", "https://s.test/2"),
                   ("https://s.test/b.xml", "https://s.test/relative/page"),
                   ("https://s.test/c.xml", "https://final.test/dir/x")]


def test_index_children_order_self_reference_and_bad_child(spark):
    idx = (f'<sitemapindex xmlns="{NS}"><sitemap><loc>https://s.test/c1.xml</loc></sitemap>'
           f'<sitemap><loc>https://s.test/bad.xml</loc></sitemap><sitemap><loc>https://s.test/index.xml</loc></sitemap>'
           f'<sitemap><loc>https://s.test/c2.xml</loc></sitemap></sitemapindex>')
    docs = [("https://s.test/index.xml", None, idx, None),
            ("https://s.test/c1.xml", None, "<urlset><url><loc>https://s.test/p1</loc></url></urlset>", None),
            ("https://s.test/bad.xml", None, None, "HTTP 500"),
            ("https://s.test/c2.xml", None, gzip.compress(b"<urlset><url><loc>https://s.test/p2</loc></url></urlset>"),
             None)]
    assert _expand(spark, ["https://s.test/index.xml"], docs) == [
        ("https://s.test/index.xml", "https://s.test/p1"), ("https://s.test/index.xml", "https://s.test/p2")]


def test_index_depth_bound(spark):
    docs = [(f"https://s.test/i{d}.xml", None,
             f'<sitemapindex><sitemap><loc>https://s.test/i{d + 1}.xml</loc></sitemap></sitemapindex>', None)
            for d in range(8)]
    docs.append(("https://s.test/i3.xml-leaf", None, "<urlset/>", None))
    assert _expand(spark, ["https://s.test/i0.xml"], docs) == []


def test_gunzip_by_magic_bytes(spark):
    plain = b"<urlset/>"
    truncated = gzip.compress(plain, mtime=0)[:12]
    df = _docs(spark, [("a", None, gzip.compress(plain), None), ("b", None, plain, None),
                       ("c", None, truncated, None)])
    got = {r.sitemap_url: bytes(r.content) for r in maybe_gunzip(df).collect()}
    assert got["a"] == plain and got["b"] == plain and got["c"] == truncated


def test_crawl_sitemap_errors_and_truncation(spark):
    urls = "".join(f"<url><loc>https://s.test/p{i}</loc></url>" for i in range(7))
    docs = [("https://s.test/ok.xml", None, f"<urlset>{urls}</urlset>", None),
            ("https://s.test/html.xml", None, "<!DOCTYPE html><html><body><p>a<p>b</body></html>", None),
            ("https://s.test/empty.xml", None, f'<urlset xmlns="{NS}"></urlset>', None),
            ("https://s.test/down.xml", None, None, "Connection refused")]
    roots = spark.createDataFrame([(d[0],) for d in docs], "root string")
    snaps = spark.createDataFrame([("https://s.test/p0", True)], "url string, success boolean")
    res, summary = crawl_sitemap(spark, roots, _docs(spark, docs), snaps, max_urls=5)
    s = {r.root: r for r in summary.collect()}
    assert (s["https://s.test/ok.xml"].crawled, s["https://s.test/ok.xml"].total) == (1, 5)
    assert s["https://s.test/ok.xml"].note == "7 pages are listed; max_urls keeps the first 5"
    assert s["https://s.test/html.xml"].error == "snapshot of https://s.test/html.xml does not parse as sitemap XML"
    assert s["https://s.test/empty.xml"].error == "sitemap https://s.test/empty.xml lists no page"
    assert s["https://s.test/down.xml"].error == "sitemap https://s.test/down.xml has no readable snapshot: Connection refused"
    assert res.count() == 5


def test_other_encodings(spark):
    body = '<?xml version="1.0" encoding="{}"?><urlset><url><loc>https://s.test/caf\u00e9/{}</loc></url></urlset>'
    utf16 = body.format("UTF-16", "\u4e2d\u6587")
    docs = [("le", None, utf16.encode("utf-16"), None), ("be", None, b"\xfe\xff" + utf16.encode("utf-16-be"), None),
            ("gz", None, gzip.compress(utf16.encode("utf-16")), None), ("win", None, body.format("windows-1252", "\u20ac\u2019").encode("cp1252"), None),
            ("odd", None, b"\xff\xfe<\x00u", None), ("cut", None, b"\xff\xfe\x00\xd8", None)]
    got = dict(_expand(spark, [d[0] for d in docs], docs))
    assert got == {"le": "https://s.test/caf\u00e9/\u4e2d\u6587", "be": "https://s.test/caf\u00e9/\u4e2d\u6587",
                   "gz": "https://s.test/caf\u00e9/\u4e2d\u6587", "win": "https://s.test/caf\u00e9/\u20ac\u2019"}
