"""Per-request queries through the inverted index equal the compiled one-query filter."""

from pyspark.sql import functions as F

from pagewright.operators import search
from pagewright.operators.blocks import density_prune, fit_filter, page_blocks
from pagewright.operators.parse import parsed_nodes
from pagewright.operators.search import request_blocks


def _page(k):
    words = ["install", "steps", "python", "menu", "about", "The", "and", str(k)]
    paras = "".join(f"<p>{' '.join(words[(i * j + k) % len(words)] for j in range(3 + i * 4))}</p>" for i in range(6))
    return f"<html><body><nav><p>Menu install</p></nav><article><h1>Install {k}</h1>{paras}<pre>code {k}</pre></article></body></html>"


def _kept(df):
    return sorted((r.page_id, r.pre) for r in df.filter("kept").select("page_id", "pre").collect())


def test_requests_equal_single_filters(spark):
    pages = spark.createDataFrame([(k, _page(k)) for k in range(4)] + [(4, ""), (5, None)], "page_id long, html string")
    blocks = page_blocks(parsed_nodes(pages))
    settings = {0: ("install steps", 10), 1: (None, 10), 2: ("  ", 3), 3: ("Python, PYTHON menu", 10), 4: ("nowhere", 10), 5: ("?!", 10)}
    rows = [(10 * page + k, page, q, w) for page in range(6) for k, (q, w) in settings.items()]
    requests = spark.createDataFrame(rows, "request_id long, page_id long, query string, word_count_threshold int")
    got = request_blocks(blocks, requests)
    assert got.columns == [*blocks.columns, "kept"]
    assert got.count() == blocks.count() * len(settings)
    got = _kept(got)
    for k, (q, w) in settings.items():
        mine = [(r // 10, pre) for r, pre in got if r % 10 == k]
        if q == "?!":
            assert mine == []
        elif q and q.strip():
            assert mine == _kept(fit_filter(blocks, query=q))
        else:
            assert mine == _kept(density_prune(blocks, F.lit(w))) and mine


def test_the_index_moves_blocks_once(spark, monkeypatch):
    monkeypatch.setattr(search, "materialize", lambda df, name: df)
    blocks = spark.createDataFrame([(1, 0, "a b a"), (1, 4, "b c"), (2, 0, "a"), (2, 1, "...")], "page_id long, pre int, text string")
    index = search.inverted_index(blocks)
    assert index._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {(r.page_id, r.term, r.pre): (r.tf, r.dl, r.df, r.n_blocks, r.avgdl) for r in index.collect()}
    assert got == {(1, "a", 0): (2, 3, 1, 2, 2.5), (1, "b", 0): (1, 3, 2, 2, 2.5), (1, "b", 4): (1, 2, 2, 2, 2.5),
                   (1, "c", 4): (1, 2, 1, 2, 2.5), (2, "a", 0): (1, 1, 1, 2, 0.5)}
