"""Structural joins against brute force over parent chains, new axes and positions, linear node tables."""

import random

import pytest
from pyspark.sql import functions as F

from pagewright.operators import structure
from pagewright.operators.parse import html_nodes, parse_html
from pagewright.operators.select import select_css, select_xpath


def _random_html(seed):
    rnd = random.Random(seed)

    def element(depth):
        tag = rnd.choice(["div", "ul", "li", "section", "b", "span"])
        kids = "".join(element(depth + 1) for _ in range(rnd.randint(0, 3))) if depth < 6 else ""
        return f"<{tag} id='{rnd.randint(0, 3)}'>{rnd.choice(['', 'x', ' a  b '])}{kids}</{tag}>"
    return "".join(element(0) for _ in range(3))


@pytest.fixture(scope="module")
def htmls():
    return [_random_html(s) for s in range(6)] + ["", "<div>" * 40 + "deep" + "</div>" * 40, "<br><br>"]


@pytest.fixture(scope="module")
def nodes(spark, htmls):
    return html_nodes(spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")).cache()


def _trees(htmls):
    for page, html in enumerate(htmls):
        els = sorted(parse_html(html), key=lambda e: e.pre)
        chain = lambda e: [] if e.parent < 0 else [*chain(els[e.parent]), e.parent]  # noqa: E731, B023
        yield page, els, {e.pre: chain(e) for e in els}


def test_last_is_the_end_of_the_subtree(nodes, htmls):
    got = {(r.page_id, r.pre): r.last for r in nodes.select("page_id", "pre", structure.last().alias("last")).collect()}
    for page, els, chain in _trees(htmls):
        for e in els:
            assert got[(page, e.pre)] == max(x for x in chain if x == e.pre or e.pre in chain[x])


@pytest.mark.parametrize("or_self", [False, True])
def test_pairs(nodes, htmls, or_self):
    n = nodes.withColumn("last", structure.last())
    twice = n.filter("tag = 'ul'")
    outer = twice.select("page_id", "pre", "last", F.lit("x").alias("_at")).union(twice.filter("attrs['id'] = '1'").select("page_id", "pre", "last", F.lit("y")))
    inner = n.filter("tag in ('ul', 'b')").select("page_id", "pre", F.col("tag").alias("_kind"))
    got = sorted((r._out.page_id, r._out.pre, r._out._at, r._in.pre) for r in structure.pairs(outer, inner, or_self).collect())
    want = []
    for page, els, chain in _trees(htmls):
        for e in els:
            if e.tag in ("ul", "b"):
                for a in chain[e.pre] + ([e.pre] if or_self else []):
                    if els[a].tag == "ul":
                        want += [(page, a, "x", e.pre)] + [(page, a, "y", e.pre)] * (els[a].attrs["id"] == "1")
    assert got == sorted(want) and want


@pytest.mark.parametrize("or_self", [False, True])
def test_enclosing(nodes, htmls, or_self):
    rows = nodes.select("page_id", "pre", structure.last().alias("last"), "tag")
    tag = F.col("tag")
    got = structure.enclosing(rows, tag.isin("b", "li"), inside={"in_ul": tag == "ul", "in_none": tag == "table"}, or_self=or_self, nearest={
        "near_li": (tag == "li", F.col("pre")), "near_any": (tag != "span", tag)})
    got = {(r.page_id, r.pre): (r.in_ul, r.in_none, r.near_li, r.near_any) for r in got.collect()}
    want = {}
    for page, els, chain in _trees(htmls):
        for e in els:
            if e.tag in ("b", "li"):
                up = chain[e.pre] + ([e.pre] if or_self else [])
                li, some = [a for a in up if els[a].tag == "li"], [els[a].tag for a in up if els[a].tag != "span"]
                want[(page, e.pre)] = (any(els[a].tag == "ul" for a in up), False, li[-1] if li else None, some[-1] if some else None)
    assert got == want and want


def _match(df):
    return sorted({(r.page_id, r.m) for r in df.collect()})


def test_axes_and_positions(nodes, htmls):
    """Each expression against a filter over the parsed trees."""
    def found(test):
        return sorted((page, e.pre) for page, els, chain in _trees(htmls) for e in els if test(e, els, chain))

    kids = lambda e, els: [x for x in els if x.parent == e.pre]
    same = lambda e, els: [x.pre for x in els if x.parent == e.parent and x.tag == e.tag]
    below = lambda e, els, chain, tag: any(e.pre in chain[x.pre] and x.tag == tag for x in els)
    text = lambda e: " ".join("".join(e.parts).split())
    assert _match(select_xpath(nodes, "//b/ancestor::div")) == found(lambda e, els, c: e.tag == "div" and below(e, els, c, "b"))
    nearest = {(p, [a for a in chain[e.pre] if els[a].tag == "div"][-1]) for p, els, chain in _trees(htmls) for e in els
               if e.tag == "b" and any(els[a].tag == "div" for a in chain[e.pre])}
    assert _match(select_xpath(nodes, "//b/ancestor::div[1]")) == sorted(nearest)
    outermost = {(p, ([a for a in chain[e.pre] if els[a].tag == "div"] + [e.pre] * (e.tag == "div"))[0]) for p, els, chain in _trees(htmls)
                 for e in els if e.tag == "div"}
    assert _match(select_xpath(nodes, "//div/ancestor-or-self::div[last()]")) == sorted(outermost)
    assert _match(select_xpath(nodes, "//div/*[last()]")) == found(lambda e, els, c: e.parent >= 0 and els[e.parent].tag == "div" and kids(els[e.parent], els)[-1].pre == e.pre)
    assert _match(select_xpath(nodes, "//li[position()>1]")) == found(lambda e, els, c: e.tag == "li" and same(e, els).index(e.pre) >= 1)
    assert _match(select_xpath(nodes, "//ul[count(*)=2]")) == found(lambda e, els, c: e.tag == "ul" and len(kids(e, els)) == 2)
    assert _match(select_xpath(nodes, "//*[normalize-space()='a b']")) == found(lambda e, els, c: text(e) == "a b")
    assert _match(select_css(nodes, "li:nth-child(odd)")) == found(lambda e, els, c: e.tag == "li" and e.ordinal % 2 == 1)
    assert _match(select_css(nodes, "b:nth-child(-n+2)")) == found(lambda e, els, c: e.tag == "b" and e.ordinal <= 2)
    assert _match(select_css(nodes, "div:first-of-type")) == found(lambda e, els, c: e.tag == "div" and same(e, els)[0] == e.pre)
    assert _match(select_css(nodes, "div:last-of-type")) == found(lambda e, els, c: e.tag == "div" and same(e, els)[-1] == e.pre)
    assert _match(select_css(nodes, "div:nth-of-type(2)")) == found(lambda e, els, c: e.tag == "div" and e.pre in same(e, els)[1:2])


def test_preceding_sibling_position_is_the_nearest(spark):
    page = spark.createDataFrame([(1, "<ul><li>a</li><li>b</li><li id='c'>c</li></ul>")], "page_id long, html string")
    n = html_nodes(page)
    got = select_xpath(n, "//li[@id='c']/preceding-sibling::li[1]").join(n.select("page_id", F.col("pre").alias("m"), "text"), ["page_id", "m"])
    assert [r.text for r in got.collect()] == ["b"]


@pytest.mark.parametrize("lean", [True, False])
def test_deep_pages_are_linear(spark, lean):
    """800 nested ``div`` in 8,800 bytes: the node table grows with the html, not with its square."""
    size = {}
    for n in (200, 800):
        page = spark.createDataFrame([(1, "<div>" * n + "x" + "</div>" * n)], "page_id long, html string")
        df = html_nodes(page, container_text=not lean)
        assert not [f for f in df.schema if f.dataType.typeName() == "array"]
        size[n] = sum(len(str(tuple(r))) for r in df.collect())
    assert size[800] < 5 * size[200] and size[800] < 150 * 800
