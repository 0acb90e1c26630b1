"""Structured Streaming operators agree with their batch counterparts (STR1-STR5)."""

from pyspark.sql import functions as F

from conftest import SF
from pagewright.operators.patterns import resolve_patterns, extract_patterns
from pagewright.operators.sessions import session_summary, sessionize
from pagewright.sources.tables import table
from pagewright.streaming import streams as ST


def test_stream_sessions_equal_closed_batch_sessions(spark):
    out = ST.idle_sessions(ST.stream_table(spark, SF, "events"))
    streamed = {(r.user_id, r.start, r.n_events) for r in out.select(
        "user_id", F.unix_micros("session_window.start").alias("start"), "n_events").collect()}
    ev = table(spark, SF, "events").select("event_id", "user_id", "ts")
    batch = session_summary(sessionize(ev, "user_id", "ts", "event_id"), "user_id", "ts")
    max_us = ev.select(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0]
    watermark_us = (max_us // 1000 - 60_000) * 1000
    closed = {(r.user_id, r.first_us, r.n_events) for r in batch.filter(F.col("end_us") <= watermark_us).collect()}
    assert streamed == closed and len(closed) > 0


def test_stream_dedup_and_patterns(spark):
    ev = ST.stream_table(spark, SF, "events")
    urls = ST.dedup_urls(ev.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), "ts"), delay="31 days")
    assert urls.count() == table(spark, SF, "events").select("user_id").distinct().count()
    specs = resolve_patterns(spark, ["email", "number"])
    streamed = ST.stream_patterns(ST.stream_table(spark, SF, "documents"), specs)
    docs = table(spark, SF, "documents").select("doc_id", "text")
    batch = extract_patterns(docs, "text", ["doc_id"], specs)
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "label", "value").collect())
    assert key(streamed) == key(batch)


def test_stream_page_results(spark):
    out = ST.page_results_stream(ST.stream_table(spark, SF, "pages"))
    assert out.count() == table(spark, SF, "pages").count()
    assert out.filter(F.col("title").isNull()).count() == 0


def _write(spark, folder, name, rows):
    spark.createDataFrame(rows, "url string, ts timestamp").coalesce(1).write.parquet(f"{folder}/{name}")


def test_each_url_once_across_restarts_and_replays(spark, tmp_path):
    """Two runs with a restart between them, many batches, repeats far apart, a replayed batch."""
    import datetime as dt
    import random
    rnd, day = random.Random(7), dt.timedelta(days=1)
    start = dt.datetime(2024, 1, 1)
    rows = [(f"u{rnd.randint(0, 60)}" if rnd.random() > 0.05 else None, start + day * rnd.randint(0, 900)) for _ in range(300)]
    folder, base = f"{tmp_path}/in", f"{tmp_path}/query"
    stream = lambda: spark.readStream.schema("url string, ts timestamp").option("maxFilesPerTrigger", "1").option(
        "recursiveFileLookup", "true").parquet(folder)
    for k in range(3):
        _write(spark, folder, f"a{k}", rows[50 * k:50 * k + 50])
    first = ST.each_url_once(stream(), location=base)
    assert sorted(r.url for r in first.collect()) == sorted({u for u, _ in rows[:150] if u})
    for k in range(3, 6):
        _write(spark, folder, f"b{k}", rows[50 * k:50 * k + 50])
    again = ST.each_url_once(stream(), location=base)
    assert sorted(r.url for r in again.collect()) == sorted({u for u, _ in rows if u})
    parts = {r.part: r.n for r in spark.read.parquet(f"{base}/out").groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    replayed = ST.first_seen(spark.createDataFrame(rows[200:250], "url string, ts timestamp"), 4, f"{base}/out")
    before = {u for u, _ in rows[:200] if u}
    assert {r.url for r in replayed.collect()} == {u for u, _ in rows[200:250] if u} - before
    assert sum(parts.values()) == len({u for u, _ in rows if u}) and len(parts) > 1


def test_folder_tables_are_streamed_whole(spark, tmp_path):
    """A table may be a folder of files, beside tables that are one file."""
    docs = [(k, f"mail a{k}@x.org or b{k}@y.org" if k % 3 else None) for k in range(30)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    html = "<html><head><title>t{0}</title></head><body><a href='/a'>x</a><a href='/b{0}'>y</a></body></html>"
    pages = [(k, f"https://h{k % 4}.org/p", html.format(k)) for k in range(20)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    found = ST.stream_patterns(ST.stream_table(spark, str(tmp_path), "documents"), resolve_patterns(spark, ["email"])).collect()
    assert sorted((r.doc_id, r.value) for r in found) == sorted((k, f"{who}{k}@{host}.org") for k, t in docs if t for who, host in ("ax", "by"))
    got = ST.page_results_stream(ST.stream_table(spark, str(tmp_path), "pages", max_files_per_trigger=1))
    assert sorted((r.page_id, r.title, r.n_links) for r in got.collect()) == [(k, f"t{k}", 2) for k in range(20)]


def test_a_stream_without_files_has_the_sinks_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    pages = spark.readStream.schema("page_id long, url string, html string").parquet(f"{tmp_path}/in")
    out = ST.page_results_stream(pages).select("page_id", "title", "n_links")
    assert out.collect() == [] and out.dtypes == [("page_id", "bigint"), ("title", "string"), ("n_links", "bigint")]
    docs = spark.readStream.schema("doc_id long, text string").parquet(f"{tmp_path}/in")
    assert ST.stream_patterns(docs, resolve_patterns(spark, ["email"])).select("doc_id", "label", "value").collect() == []
