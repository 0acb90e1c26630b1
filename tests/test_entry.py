"""Driver contract: entry() runs, every oracle has a query, column names agree on sf0.001."""

import re

import duckdb

import __spark_entry__ as E
from conftest import SF
from pagewright.sources.tables import TABLES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"host", "n_pages", "n_links", "n_internal", "n_external", "title_chars"}
    assert df.count() > 0


def test_registry_consistent():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 55
    corpus = {n for n in qs if n == "pipeline" or re.match(r"op\d+_", n)}  # tested in tests/llm
    assert set(qs) - set(sqls) - corpus == {"best_first_budget"}


def test_oracles_run_and_columns_match(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs = E.queries()
    for name, sql in E.oracle_sql().items():
        cols = [d[0] for d in con.execute(sql).description]
        if name.startswith(("stream_", "bfs", "best_first", "sitemap", "sink", "scope_filters", "domain", "glob", "crawl")):
            continue  # heavy plans: covered by the sf0.01 oracle check
        assert sorted(qs[name](spark, SF).columns) == sorted(cols), name
