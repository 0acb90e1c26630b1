"""Links (PRJ10, PRJ11) and tables (PRJ12) from html fixtures (FIXTURES F2, F3)."""


from pagewright.operators.parse import html_nodes
from pagewright.operators.project import links_struct, page_links, page_metadata
from pagewright.operators.tables import page_tables

LINK_HTML = """<html><head><title> T </title><meta name="description" content="D"></head><body>
<a href="/a" title="">Python</a><a>nowhere</a><a href="  ">blank</a>
<a href=" https://docs.example.com/x ">  Docs </a><a href="https://other.org/">Other</a>
<a href="http://example.com:8080/p">Port</a></body></html>"""


def _pages(spark, html, url="https://www.example.com/start"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_link_projection_and_split(spark):
    pages = _pages(spark, LINK_HTML)
    links = page_links(html_nodes(pages), pages).orderBy("pos").collect()
    assert [(r.pos, r.kind, r.text, r.title) for r in links] == [
        (1, "internal", "Python", None), (2, "internal", "Docs", None), (3, "external", "Other", None),
        (4, "internal", "Port", None)]
    assert links[1].href == " https://docs.example.com/x "        # href itself is not trimmed
    nested = links_struct(page_links(html_nodes(pages), pages)).first().links
    assert [l.href for l in nested.internal][0] == "/a" and len(nested.external) == 1


def test_no_cap_on_links(spark):
    html = "<body>" + "".join(f'<a href="/p{i}">p{i}</a>' for i in range(750)) + "</body>"
    pages = _pages(spark, html)
    assert page_links(html_nodes(pages), pages).count() == 750


def test_metadata_null_when_absent(spark):
    pages = spark.createDataFrame([(1, "u", LINK_HTML), (2, "v", "<html><body>x</body></html>")],
                                  "page_id long, url string, html string")
    meta = {r.page_id: (r.title, r.description) for r in page_metadata(html_nodes(pages)).collect()}
    assert meta[1] == ("T", "D") and 2 not in meta or meta.get(2) == (None, None)


TABLE_HTML = """<html><body>
<table><caption>Pop</caption><thead><tr><th>Country</th><th>Population</th></tr></thead>
<tbody><tr><td>A</td><td>1</td></tr><tr><td>B</td><td>2</td></tr></tbody></table>
<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table>
<table role="presentation"><tr><td>layout</td></tr></table>
<table><tr><td><table><tr><td>in</td></tr></table></td></tr></table>
</body></html>"""


def test_tables_scored_and_shaped(spark):
    pages = _pages(spark, TABLE_HTML)
    all_t = page_tables(html_nodes(pages), min_score=-99).orderBy("table_pre").collect()
    scores = [t.score for t in all_t]
    assert scores[0] == 6 and scores[2] < 0        # th+2, caption+1, widths+1, rows+1, cols+1 vs layout
    data = page_tables(html_nodes(pages)).orderBy("table_no").collect()
    assert data[0].headers == ["Country", "Population"] and data[0].rows == [["A", "1"], ["B", "2"]]
    assert data[0].caption == "Pop"
    hdrless = [t for t in all_t if t.caption is None and t.rows == [["a", "b"], ["c", "d"]]]
    assert hdrless and hdrless[0].headers == []


def test_many_rows_never_truncated(spark):
    body = "".join(f"<tr><td>{i}</td><td>x</td></tr>" for i in range(300))
    pages = _pages(spark, f"<table><tr><th>k</th><th>v</th></tr>{body}</table>")
    t = page_tables(html_nodes(pages)).first()
    assert len(t.rows) == 300 and t.rows[299] == ["299", "x"]
