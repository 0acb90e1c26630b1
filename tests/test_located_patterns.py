"""Patterns located in element intervals: offsets, holders and scopes against plain Python."""

import re

from pagewright.operators.parse import html_nodes, parse_html
from pagewright.operators.patterns import located_patterns, match_offsets

SPECS = [("num", "[0-9]+"), ("tag", "<b[^>]*>"), ("word", "é+x?")]
HTMLS = ["", None, "12 é <div id='7'>3<b class=9>éx</b> 44<section><div>5 é</div>6</section></div> 77",
         "<div><p>1<p>2 <b>3</b></div>8<section>9", "éé1é <section id=s>é22</section><section>é33</section>", "no markup 5"]


def _brute(selector_tag=None):
    out = []
    for page, html in enumerate(HTMLS):
        els = sorted(parse_html(html), key=lambda e: e.pre)
        for label, rx in SPECS:
            n = 0
            for m in re.finditer(rx, html or ""):
                holders = [e for e in els if e.start <= m.start() < e.end]
                if selector_tag and not any(e.tag == selector_tag and e.start <= m.start() and m.end() <= e.end for e in els):
                    continue
                n += 1
                out.append((page, label, n, m.group(), m.start(), *((holders[-1].pre, holders[-1].tag) if holders else (None, None))))
    return sorted(out, key=repr)


def _pages(spark):
    return spark.createDataFrame(list(enumerate(HTMLS)), "page_id long, html string")


def test_offsets(spark):
    got = match_offsets(_pages(spark), "html", ["page_id"], SPECS).collect()
    want = {(p, label, m.start(), m.end(), m.group()) for p, h in enumerate(HTMLS) for label, rx in SPECS for m in re.finditer(rx, h or "")}
    assert {(r.page_id, r.label, r.start_off, r.stop_off, r.value) for r in got} == want and len(got) == len(want)


def test_holders_and_scopes(spark):
    pages = _pages(spark)
    nodes = html_nodes(pages).cache()
    run = lambda sel: sorted((tuple(r) for r in located_patterns(pages, nodes, SPECS, sel).collect()), key=repr)
    assert run(None) == _brute()
    for tag in ("div", "section", "p", "table"):
        assert run(tag) == _brute(tag)
    assert _brute("table") == [] and len(_brute("div")) > 5


def test_texts_are_split_by_matching_patterns_only(spark):
    import re

    from pagewright.operators.patterns import BUILTIN_PATTERNS, match_offsets
    texts = ["", "nothing here", "a@b.org, c@d.org 50 % #tag #aabbcc @me 12:30 2024-01-02 1/2/2024", "http://x.org/1 $5.00 10.0.0.1", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    specs = list(BUILTIN_PATTERNS.items())
    out = match_offsets(df, "t", ["id"], specs)
    got = {(r.id, r.label, r.start_off, r.stop_off, r.value) for r in out.collect()}
    assert got == {(i, n, m.start(), m.end(), m[0]) for i, t in enumerate(texts) if t for n, rx in specs for m in re.finditer(rx, t, re.ASCII)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == len(specs) and plan.count("CASE WHEN (size(") >= len(specs)
