"""Selector compiler (2.13-d): CSS combinators, pseudo-classes, attribute operators, XPath axes."""

import pytest

from pagewright.operators.parse import html_nodes
from pagewright.operators.select import request_nodes, select_css, select_xpath, subtree, without_subtree

HTML = """<html><body>
<div id="main" class="wrap big"><h2>T</h2><p class="a">p1</p><p class="b x">p2</p><span>s</span><p>p3</p></div>
<ul><li data-k="alpha-1">one</li><li data-k="beta">two</li><li lang="en-US">three</li></ul>
<section><div><p>deep</p></div></section></body></html>"""


@pytest.fixture(scope="module")
def nodes(spark):
    pages = spark.createDataFrame([(1, "u", HTML)], "page_id long, url string, html string")
    return html_nodes(pages).cache()


def _texts(nodes, matches):
    return sorted(r.text for r in matches.join(
        nodes.select("page_id", nodes.pre.alias("m"), "text"), ["page_id", "m"]).collect())


@pytest.mark.parametrize("sel,want", [
    ("p", ["deep", "p1", "p2", "p3"]),
    ("div#main > p", ["p1", "p2", "p3"]),
    ("section p", ["deep"]),
    ("p.a + p", ["p2"]),
    ("p.a ~ p", ["p2", "p3"]),
    ("h2 + p, span + p", ["p1", "p3"]),
    (".b.x", ["p2"]),
    ("li:first-child", ["one"]),
    ("li:nth-child(2)", ["two"]),
    ("[data-k^=alpha]", ["one"]),
    ("[data-k$=eta]", ["two"]),
    ("[data-k*=lph]", ["one"]),
    ("[lang|=en]", ["three"]),
    ("div[class~=big] > span", ["s"]),
    ("li:last-child", ["three"]),
    ("div#main > p:last-child", ["p3"]),
    ("p:not(.a)", ["deep", "p2", "p3"]),
    ("div#main > p:not(.a, :nth-child(3))", ["p3"]),
    ("li:not([lang]):not(:first-child)", ["two"]),
])
def test_css(nodes, sel, want):
    assert _texts(nodes, select_css(nodes, sel)) == want


@pytest.mark.parametrize("expr,want", [
    ("//p", ["deep", "p1", "p2", "p3"]),
    ("/html/body/ul/li[2]", ["two"]),
    ("//li[@data-k='beta']/preceding-sibling::li", ["one"]),
    ("//li[contains(text(),'thr')]", ["three"]),
    ("//p[@class='a']/following-sibling::p", ["p2", "p3"]),
    ("//section//p/..", ["deep"]),
    ("//div[@id='main']/p[starts-with(@class,'b')]", ["p2"]),
    ("//li[text()='one' or @lang='en-US']", ["one", "three"]),
    ("//li[@lang and text()='one' or text()='two']", ["two"]),
    ("//li[@lang and (text()='one' or text()='three')]", ["three"]),
    ("//li[not(@lang) and not(contains(., 'w'))]", ["one"]),
    ("//li[@data-k='a/b or c' or @data-k='beta']", ["two"]),
    ("//p[@class='a'] | //span[contains(., 's')]", ["p1", "s"]),
    ("//li[@data-k][2]", ["two"]),
])
def test_xpath(nodes, expr, want):
    assert _texts(nodes, select_xpath(nodes, expr)) == want


def test_unsupported_syntax_refused(nodes):
    with pytest.raises(ValueError, match="unsupported CSS pseudo-class :hover"):
        select_css(nodes, "a:hover")
    with pytest.raises(ValueError, match="unsupported CSS selector in :not"):
        select_css(nodes, "p:not(div p)")
    for expr in ("//a[string-length(.)]", "//a[last() or @b]", "//a[1 or @b]", "//a[@b]c", "//a[not(2)]"):
        with pytest.raises(ValueError, match="unsupported XPath"):
            select_xpath(nodes, expr)


def test_subtrees(spark, nodes):
    inside = subtree(nodes, select_css(nodes, "section, ul, section div"))
    assert sorted(r.tag for r in inside.collect()) == ["div", "li", "li", "li", "p", "section", "ul"]
    rest = without_subtree(nodes, select_css(nodes, "section, ul, section div"))
    assert inside.count() + rest.count() == nodes.count()
    assert inside.columns == rest.columns == nodes.columns
    none = select_css(nodes, "table")
    assert subtree(nodes, none).count() == 0 and without_subtree(nodes, none).count() == nodes.count()


def test_request_nodes(spark, nodes):
    rows = [(10, 1, None, None), (11, 1, "ul", None), (12, 1, None, "ul, section"), (13, 1, "div#main", "p"),
            (14, 1, "table", None), (15, 1, None, "table"), (16, 9, None, None)]
    asked = spark.createDataFrame(rows, "request_id long, page_id long, css_selector string, excluded_selector string")
    got = request_nodes(nodes, asked, ["ul", "ul, section", "div#main", "p", "table"]).collect()
    tags = {k: sorted(r.tag for r in got if r.page_id == k) for k in range(10, 17)}
    everything = sorted(r.tag for r in nodes.collect())
    assert tags[10] == tags[15] == everything and tags[14] == tags[16] == []
    assert tags[11] == ["li", "li", "li", "ul"] and tags[13] == ["div", "h2", "span"]
    assert len(tags[12]) == len(everything) - 4 - 3
    assert request_nodes(nodes, asked, []).where("page_id = 10").count() == len(everything)
