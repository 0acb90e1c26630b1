"""Tag-soup tree building (2.13-i) and node-table invariants."""

from pagewright.operators.parse import collapse, parse_html


def _by_tag(els, tag):
    return [e for e in sorted(els, key=lambda e: e.pre) if e.tag == tag]


def _text(e):
    return collapse("".join(e.parts))


def test_block_start_closes_open_p_with_inline_still_open():
    els = parse_html("<article><p><b>Title<br><p>Second para</p></article>")
    ps = _by_tag(els, "p")
    assert [_text(p) for p in ps] == ["Title", "Second para"]
    assert ps[1].parent == _by_tag(els, "article")[0].pre   # not nested in the first p or in b


def test_script_text_is_never_text_and_cannot_close_p():
    els = parse_html('<head><script>var t="</p>";</script></head><body><p>a</p></body>')
    assert _text(_by_tag(els, "script")[0]) == ""
    assert [_text(p) for p in _by_tag(els, "p")] == ["a"]


def test_void_elements_and_br_space():
    els = parse_html("<p>one<br>two<img src=x>three</p>")
    p = _by_tag(els, "p")[0]
    assert _text(p) == "one two three"
    assert all(e.parent == p.pre for e in els if e.tag in ("br", "img"))


def test_unmatched_end_tag_ignored_and_entities_unescaped():
    els = parse_html("<div>x &amp; y &copy;</span></div>")
    assert _text(_by_tag(els, "div")[0]) == "x & y ©"


def test_pre_post_nesting_is_valid():
    html = "<html><body><nav><ul><li><a href='/a'>A</a></li><li>B</ul></nav><p>t<p>u</body></html>"
    els = sorted(parse_html(html), key=lambda e: e.pre)
    by_pre = {e.pre: e for e in els}
    for e in els:
        if e.parent >= 0:
            a = by_pre[e.parent]
            assert a.pre < e.pre and e.post < a.post
            assert a.start <= e.start and e.end <= a.end
    assert sorted(e.post for e in els) == list(range(len(els)))


def test_li_closes_open_li_and_offsets_recover_markup():
    html = "<ul><li>one<li>two</ul>"
    els = parse_html(html)
    lis = _by_tag(els, "li")
    assert [_text(li) for li in lis] == ["one", "two"]
    assert html[lis[0].start:lis[0].end] == "<li>one"


def test_node_table_on_pages(spark):
    from pyspark.sql import functions as F

    from conftest import SF
    from pagewright.operators.parse import html_nodes
    from pagewright.sources.tables import table

    pages = table(spark, SF, "pages")
    nodes = html_nodes(pages)
    # every page yields exactly one html root and one title
    per = nodes.groupBy("page_id").agg(F.count_if(F.col("depth") == 0).alias("roots"),
                                       F.count_if(F.col("tag") == "title").alias("titles"))
    assert per.filter((F.col("roots") != 1) | (F.col("titles") != 1)).count() == 0
    assert per.count() == pages.count()


def test_legacy_entities_without_semicolon_decode_like_html5():
    els = parse_html("<h1>Tom &amp Jerry &copy 2024 &amp;amp;</h1>")
    assert _text(_by_tag(els, "h1")[0]) == "Tom & Jerry © 2024 &amp;"
