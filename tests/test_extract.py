"""Record and pattern extraction (EXT1-EXT13, FIXTURES F8, F9)."""

import pytest

from pagewright.operators.extract import extract_records, extraction_summary
from pagewright.operators.parse import html_nodes, parsed_nodes
from pagewright.operators.patterns import BUILTIN_PATTERNS, extract_patterns, resolve_patterns
from pagewright.operators.select import normalize_selector_type
from pagewright.operators.structured import (GENERIC_PROVIDER_ERROR, chunk_text, empty_structured,
                                             extraction_error, normalize_payload)

ROOMS = """<html><body><ol id="floor2">
<li class="room"><b class="no">2.01</b><i class="use"> Map store </i><a href="plan?r=201" title="North">plan</a>
  <dl><dt>Seats</dt><dd>14</dd><dt>Desks</dt><dd>9</dd></dl><p class="key"><code>K-77</code></p></li>
<li class="room"><b class="no">2.02</b><a href="plan?r=202">plan</a><dl><dt>Seats</dt><dd>3</dd></dl></li>
</ol></body></html>"""


def _pages(spark, html=ROOMS):
    return spark.createDataFrame([(1, "https://house.test/", html)], "page_id long, url string, html string")


CSS = {"name": "rooms", "baseSelector": "li.room", "fields": [
    {"name": "room", "selector": "b.no", "type": "regex", "pattern": "([0-9]+)[.]([0-9]+)", "group": 2},
    {"name": "use", "selector": "i.use", "type": "text", "transform": "uppercase", "default": "free"},
    {"name": "side", "selector": "a", "type": "attribute", "attribute": "title"},
    {"name": "counts", "selector": "dd", "type": "list", "fields": [{"name": "n", "type": "text"}]},
    {"name": "lock", "selector": "p.key", "type": "nested", "fields": [{"name": "code", "selector": "code"}]},
    {"name": "markup", "selector": "b.no", "type": "outer"}]}
XPATH = {"name": "rooms", "baseSelector": "//li[@class='room']", "fields": [
    {"name": "room", "selector": ".//b[@class='no']/text()", "type": "regex", "pattern": "([0-9]+)[.]([0-9]+)", "group": 2},
    {"name": "use", "selector": ".//*[@class='use']", "type": "text", "transform": "uppercase", "default": "free"},
    {"name": "side", "selector": "//a/@title", "type": "text"},
    {"name": "counts", "selector": ".//dd", "type": "list", "fields": [{"name": "n", "type": "text"}]},
    {"name": "lock", "selector": ".//p[contains(@class,'key')]", "type": "nested",
     "fields": [{"name": "code", "selector": ".//code"}]},
    {"name": "markup", "selector": ".//b[@class='no']", "type": "outer"}]}


def test_css_records_and_field_types(spark):
    pages = _pages(spark)
    a, b = extract_records(html_nodes(pages), CSS, "css", pages_html=pages).orderBy("item_no").collect()
    assert (a.room, a.use, a.side) == ("01", "MAP STORE", "North") and (b.room, b.use, b.side) == ("02", "free", None)
    assert [x.n for x in a.counts] == ["14", "9"] and [x.n for x in b.counts] == ["3"]
    assert a.lock.code == "K-77" and b.lock is None
    assert a.markup == '<b class="no">2.01</b>'  # a type that is not known gives the markup


def test_xpath_equals_css_and_reroots_leading_slashes(spark):
    pages = _pages(spark)
    nodes = html_nodes(pages)
    a = extract_records(nodes, CSS, "css", pages_html=pages).orderBy("item_no").collect()
    b = extract_records(nodes, XPATH, " XPath ", pages_html=pages).orderBy("item_no").collect()
    assert a == b


def test_xpath_values_go_through_type_and_transform(spark):
    schema = {"baseSelector": "//li", "fields": [
        {"name": "direct", "selector": ".//a/@href", "type": "regex", "pattern": "r=([0-9]+)"},
        {"name": "steps", "selector": "./dl/preceding-sibling::a/@href", "type": "regex", "pattern": "r=([0-9]+)"},
        {"name": "upper", "selector": ".//a/text()", "type": "text", "transform": "uppercase"},
        {"name": "none", "selector": ".//a/@href", "type": "regex", "pattern": "x=([0-9]+)", "default": "-"}]}
    got = extract_records(html_nodes(_pages(spark)), schema, "xpath").orderBy("item_no").collect()
    assert [tuple(r)[2:] for r in got] == [("201", "201", "PLAN", "-"), ("202", "202", "PLAN", "-")]


def test_selector_type_validation(spark):
    assert normalize_selector_type(" XPath ") == "xpath"
    with pytest.raises(ValueError, match="'regex': choose one of css, xpath"):
        normalize_selector_type("regex")


def test_empty_result_error_names_selector_language(spark):
    pages = _pages(spark)
    recs = extract_records(html_nodes(pages), {"baseSelector": "table.none", "fields": [
        {"name": "t", "selector": "td", "type": "text"}]}, "css")
    s = extraction_summary(recs, pages, "css").first()
    assert s["count"] == 0 and "css selectors" in s.error


def test_xpath_text_predicates_and_axes(spark):
    html = "<ul><li>one</li><li>two <a href='/t'>link</a></li><li>three</li></ul>"
    pages = _pages(spark, html)
    nodes = html_nodes(pages)
    schema = {"baseSelector": "//li[contains(text(),'two')]", "fields": [
        {"name": "prev", "selector": "./preceding-sibling::li", "type": "text"},
        {"name": "next", "selector": "./following-sibling::li", "type": "text"},
        {"name": "up", "selector": "..", "type": "text"},
        {"name": "href", "selector": ".//a/@href", "type": "text"}]}
    r = extract_records(nodes, schema, "xpath").first()
    assert (r.prev, r.next, r.href) == ("one", "three", "/t") and r.up.startswith("one")


def test_pattern_validation():
    assert [n for n, _ in resolve_patterns(None)] == ["email", "url"]
    with pytest.raises(ValueError, match="patterns zip, 7 are not built in. Valid values: email, phone_intl"):
        resolve_patterns(None, ["zip", "email", 7])
    with pytest.raises(ValueError, match="at least one"):
        resolve_patterns(None, [])
    with pytest.raises(ValueError, match="'n' is a int, not text"):
        resolve_patterns(None, [], {"n": 5})
    assert [n for n, _ in resolve_patterns(None, ["EMAIL"])] == ["email"]


def test_invalid_custom_regex_named(spark):
    with pytest.raises(ValueError, match="custom pattern 'open' does not compile"):
        resolve_patterns(spark, [], {"word": "[a-z]+", "open": "(a|b"})


def test_patterns_over_whole_text(spark):
    text = ("Mail a.b@example.com or +44 20 7946 0958, see https://x.test/p?q=1 on 2024-01-31 at 13:45, "
            "ip 192.168.0.1 #tag @handle 50% $1,234.50 card 4111 1111 1111 1111 " + "filler " * 5000 + "z@z.io")
    df = spark.createDataFrame([(1, text)], "k long, t string")
    specs = resolve_patterns(spark, list(BUILTIN_PATTERNS))
    got = {}
    for r in extract_patterns(df, "t", ["k"], specs).collect():
        got.setdefault(r.label, []).append(r.value)
    assert got["email"] == ["a.b@example.com", "z@z.io"]          # the match after 5000 words is found
    assert got["url"] == ["https://x.test/p?q=1"] and got["date_iso"] == ["2024-01-31"]
    assert got["ipv4"] == ["192.168.0.1"] and got["percentage"] == ["50%"] and got["hashtag"] == ["#tag"]
    assert got["credit_card"] == ["4111 1111 1111 1111"] and got["currency"] == ["$1,234.50"]


PAYLOADS = [('[{"room":"2.01","seats":14},{"room":"2.02","seats":3},5]', 3, None), ('{"floor":2}', 1, None),
            ("[]", 0, "nothing"), (None, 0, "nothing"), ('[{"room":', 0, "cannot be parsed"), ("17.5", 0, "type number"),
            ('"2.01"', 0, "type string"), ("false", 0, "type boolean"), ("null", 0, "type null")]


def test_payload_normalisation(spark):
    df = spark.createDataFrame([(p,) for p, _, _ in PAYLOADS], "p string")
    for r, (_, n, err) in zip(normalize_payload(df, "p", "nothing").collect(), PAYLOADS, strict=True):
        assert r["count"] == n
        assert (r.error is None) if err is None else err in r.error


FLAGS = [('[{"error":true,"content":" quota used up "},{"error":true,"content":"try later"}]', "quota used up | try later"),
         ('[{"room":"error","content":"an error occurred"}]', None), ('[{"error":false,"content":"read"}]', None),
         (None, None), ("", None), ("error: true", None), ('[{"part":3,"error":true}]', GENERIC_PROVIDER_ERROR),
         ('{"error":true,"content":"closed"}', "closed"), ('{"error":"true","content":"x"}', None), ('{"error":1}', None)]


def test_flagged_blocks(spark):
    df = spark.createDataFrame([(p,) for p, _ in FLAGS], "p string")
    got = [r[0] for r in df.select(extraction_error("p")).collect()]
    assert got == [w for _, w in FLAGS]
    flags = spark.createDataFrame([("[]",), (" {} ",), ("",), ('[{"a":1}]',)], "p string")
    assert [r[0] for r in flags.select(empty_structured("p")).collect()] == [True, True, True, False]


def test_chunking(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(5000))), (2, "short text")], "k long, t string")
    got = {(r.k, r.chunk_no): r.n_tokens for r in chunk_text(df, "t", ["k"], 2048).collect()}
    assert got == {(1, 1): 2048, (1, 2): 2048, (1, 3): 904, (2, 1): 2}
    off = chunk_text(df, "t", ["k"], 2048, apply_chunking=False).collect()
    assert len(off) == 2


def test_markup_is_cut_from_a_page_once_per_record(spark):
    import re
    html = "<article><h1 class='x'>A &amp; B</h1><p>one</p><p>two <b>b</b></p></article><article><p>three</p></article>"
    pages = spark.createDataFrame([(1, html), (2, "<article><h1>C</h1></article>")], "page_id long, html string")
    schema = {"baseSelector": "article", "fields": [
        {"name": "t", "selector": "h1", "type": "text"}, {"name": "h", "selector": "h1", "type": "html"},
        {"name": "p", "selector": "p", "type": "html", "transform": "uppercase", "default": "none"}]}
    rec = extract_records(parsed_nodes(pages), schema, "css", pages_html=pages)
    got = sorted(tuple(r) for r in rec.collect())
    assert got == [(1, 1, "A & B", "<h1 class='x'>A &amp; B</h1>", "<P>ONE</P>"), (1, 2, None, None, "<P>THREE</P>"),
                   (2, 1, "C", "<h1>C</h1>", "none")]
    plan = rec._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"min_by\(.*substring", plan)
