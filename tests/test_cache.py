"""A cache used by a sequence of requests, each in its own mode (SRC8), against a plain replay."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pagewright.operators import prefix
from pagewright.operators.cache import page_digest, read_cache, refiltered, resolve, served, upsert
from pagewright.operators.config import CACHE_MODES

SCHEMA = "url string, seq long, mode string, html string, status_code int, names string"


def _requests(rnd, n, urls, hot=0.5):
    out = []
    for i in range(n):
        url = "hot" if rnd.random() < hot else f"u{rnd.randint(0, urls)}"
        html = None if rnd.random() < 0.25 else f"<p>{i}</p>"
        mode = rnd.choice([*CACHE_MODES, None, " Enabled", "READ_ONLY ", "nonsense"])
        out.append((url, i, mode, html, 200 if html else 503, "own"))
    return out


def _replay(requests, cache):
    held, by, out = dict(cache), {}, {}
    for url, seq, mode, html, status, _ in sorted(requests, key=lambda r: r[1]):
        mode = (mode or "bypass").strip().lower()
        if mode not in CACHE_MODES:
            out[url, seq] = ("refused", None, False, None, None)
        elif mode in ("enabled", "read_only") and url in held:
            out[url, seq] = ("cache", by.get(url), False, held[url], None)
        else:
            writes = html is not None and mode in ("enabled", "write_only")
            out[url, seq] = ("fresh", None, writes, html, status)
            if writes:
                held[url], by[url] = html, seq
    return out, held


@pytest.mark.parametrize("seed", [1, 2])
def test_requests_equal_a_replay(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(prefix, "LEAST_PIECE", 8)  # the hot URL is cut into many pieces
    rnd = random.Random(seed)
    rows = _requests(rnd, 400, 25)
    cache = {f"u{k}": f"<p>was {k}</p>" for k in range(0, 25, 3)} | {"other": "<p>other</p>"} | ({"hot": "<p>hot</p>"} if seed == 2 else {})
    want, held = _replay(rows, cache)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    was = spark.createDataFrame(list(cache.items()), "url string, html string")
    got = resolve(frame, was).collect()
    assert {(r.url, r.seq): (r.source, r.stored_by, r.writes_cache, r.html, r.status_code) for r in got} == want
    assert len(got) == len(rows) and {r.names for r in got} == {"own"}
    # in two parts through the table
    path = f"{tmp_path}/cache"
    upsert(was, path, 0)
    served(frame.where("seq < 150"), path, 1)
    again = served(frame.where("seq >= 150"), path, 2).collect()
    assert {(r.url, r.seq): (r.source, r.html) for r in again} == {k: (v[0], v[3]) for k, v in want.items() if k[1] >= 150}
    assert {r.url: r.html for r in read_cache(spark, path).collect()} == held


def test_upsert_rewrites_only_the_folders_it_touches(spark, tmp_path):
    path = f"{tmp_path}/cache"
    assert read_cache(spark, path).count() == 0
    frame = lambda rows: spark.createDataFrame(rows, "url string, html string")
    upsert(frame([(f"u{k}", f"a{k}") for k in range(60)] + [(None, "x"), ("empty", None)]), path, 1)
    files = {str(f) for f in tmp_path.rglob("*.parquet")}
    upsert(frame([("u3", "b3"), ("new", "c")]), path, 2)
    kept = files & {str(f) for f in tmp_path.rglob("*.parquet")}
    assert len(files) - len(kept) in (1, 2)
    upsert(frame([("u3", "again")]), path, 2)  # the same version once more
    upsert(frame([("u3", "late"), ("u4", "late")]), path, 0)  # stored later already
    got = {r.url: (r.html, r.version) for r in read_cache(spark, path).collect()}
    assert got == {f"u{k}": (f"a{k}", 1) for k in range(60)} | {"u3": ("again", 2), "new": ("c", 2)}
    before = {str(f) for f in tmp_path.rglob("*.parquet")}
    upsert(frame([]), path, 3)
    assert {str(f) for f in tmp_path.rglob("*.parquet")} == before


def test_cached_pages_are_filtered_with_the_requests_own_threshold(spark):
    words = lambda n: " ".join(f"w{k}" for k in range(n))
    html = f"<html><body><article><p>{words(8)}</p><p>{words(40)}</p></article></body></html>"
    rows = [("a", 1, "enabled", html, 200, 5, 7), ("a", 2, "enabled", "<p>other</p>", 200, 5, 7), ("a", 3, "enabled", None, None, 20, 7),
            ("a", 4, "read_only", None, None, None, 7), ("b", 5, "read_only", None, 404, 5, None), ("a", 6, "bypass", "<p>short</p>", 200, 20, 9)]
    req = spark.createDataFrame(rows, "url string, seq long, mode string, html string, status_code int, words int, page int")
    out = {r.seq: r for r in refiltered(resolve(req, spark.createDataFrame([], "url string, html string")), "page", "words").collect()}
    assert [out[k].source for k in range(1, 7)] == ["fresh", "cache", "cache", "cache", "fresh", "fresh"]
    assert out[1].content == out[2].content == f"{words(8)}\n\n{words(40)}"
    assert out[3].content == out[4].content == words(40) and out[5].content is None and out[6].content == "short"


def test_extremes_before_equals_a_window(spark, monkeypatch):
    from pyspark.sql import Window
    monkeypatch.setattr(prefix, "LEAST_PIECE", 8)
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice("abc"), i, rnd.choice([None, rnd.randint(0, 99)])) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, i long, v int").repartition(4)
    w = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("hi", F.max("v").over(w)).withColumn("lo", F.min("v").over(w))
    got = prefix.extremes_before(df, ["k"], ["i"], hi=("v", F.max), lo=("v", F.min))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_pages_are_never_broadcast_and_digests_stand_for_them(spark):
    rows = _requests(random.Random(6), 300, 20)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    was = spark.createDataFrame([(f"u{k}", f"<p>was {k}</p>") for k in range(0, 20, 3)], "url string, html string")
    whole = resolve(frame, was)
    # a file with few distinct pages is small, the rows read from it are not
    assert not re.search(r"BroadcastHashJoin \[url#", whole._jdf.queryExecution().executedPlan().toString())
    named = lambda d: d.withColumn("digest", page_digest()).drop("html")
    short = resolve(named(frame), named(was), "digest")
    cols = ("url", "seq", "source", "stored_by", "writes_cache", "status_code", "digest")
    assert sorted(map(str, short.select(*cols).collect())) == sorted(map(str, named(whole).select(*cols).collect()))


def test_filtered_pages_come_from_their_own_table(spark):
    req = spark.createDataFrame([("a", 1, 7), ("b", 2, 9), ("c", 3, None), ("d", 4, 7)], "url string, seq long, page int")
    pages = spark.createDataFrame([(7, "<p>seven</p>"), (9, "<p>nine</p>"), (11, "<p>not asked</p>")], "page int, html string")
    assert {r.seq: r.content for r in refiltered(req, "page", pages=pages).collect()} == {1: "seven", 2: "nine", 3: None, 4: "seven"}


def test_cache_of_digest_requests_holds_html(spark, tmp_path):
    rows = _requests(random.Random(9), 200, 12)
    cache = {f"u{k}": f"<p>was {k}</p>" for k in range(0, 12, 3)}
    want, held = _replay(rows, cache)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    pages = frame.where("html IS NOT NULL").select(page_digest().alias("digest"), "html")
    path = f"{tmp_path}/cache"
    upsert(spark.createDataFrame(list(cache.items()), "url string, html string"), path, 0)
    got = served(frame.withColumn("digest", page_digest()).drop("html"), path, 1, pages=pages.union(pages)).collect()
    assert {(r.url, r.seq): r.source for r in got} == {k: v[0] for k, v in want.items()}
    assert {r.url: r.html for r in read_cache(spark, path).collect()} == held
