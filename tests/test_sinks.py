"""File names, manifest and sink behaviour (SNK1-SNK5, FIXTURES F5)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pagewright.functions.text import safe_filename
from pagewright.operators.sinks import (manifest, persist, read_manifest, read_pages, sink_dir, with_file_names,
                                         write_pages)


def _names(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    return [r[0] for r in df.select(safe_filename(F.col("url"))).collect()]


def test_filename_rules(spark):
    a, b, c, d = _names(spark, ["https://example.com/page", "https://example.com/path?q=hello&x=1#top",
                                "https://example.com/" + "a" * 300, "https://"])
    assert a == "example_com_page_3641c5f2.md"
    assert b.startswith("example_com_path_q_hello_x_1_top_")
    assert len(c) - len("_12345678.md") <= 200 and d.startswith("page_")


def test_filenames_distinct_for_lossy_stems(spark):
    urls = ["https://example.cn/中文", "https://example.cn/日本", "https://example.cn/한국", "https://example.cn/русский",
            "https://e.com/docs/api", "https://e.com/docs/api/", "https://e.com/Page", "https://e.com/page",
            "http://e.com/x", "https://e.com/x"]
    names = _names(spark, urls)
    assert len(set(names)) == len(names)
    assert _names(spark, ["https://e.com/x"]) == _names(spark, ["https://e.com/x"])


RES_SCHEMA = "url string, success boolean, error_message string, depth int, parent_url string, content string, rank long"


def test_manifest_success_first_optional_keys(spark):
    res = spark.createDataFrame([
        ("https://e.com/a", True, None, 0, None, "A", 1),
        ("https://e.com/b", True, None, 1, "https://e.com/a", "B", 2),
        ("https://e.com/c", False, "Connection timeout", None, None, None, 3)], RES_SCHEMA)
    m = [json.loads(r.entry) for r in manifest(with_file_names(res)).orderBy("entry_no").collect()]
    assert m[0] == {"url": "https://e.com/a", "file": m[0]["file"], "success": True, "depth": 0}
    assert m[1]["parent_url"] == "https://e.com/a" and m[1]["depth"] == 1
    assert m[2] == {"url": "https://e.com/c", "success": False, "error": "Connection timeout"}


def test_persist_overwrites_and_returns_file(spark):
    res = spark.createDataFrame([("https://e.com/a", True, None, None, None, "A", 1),
                                 ("https://e.com/b", False, "boom", None, None, None, 2)], RES_SCHEMA)
    out_dir = sink_dir(spark)
    for _ in range(2):
        out, note = persist(res, out_dir)
        assert note is None
    back = read_pages(spark, out_dir).collect()
    assert [(r.url, r.content) for r in back] == [("https://e.com/a", "A")]
    assert out.filter("success").first().content is None and out.filter("success").first().file


def test_unwritable_dir_keeps_content_and_note(spark):
    res = spark.createDataFrame([("https://e.com/a", True, None, None, None, "A", 1)], RES_SCHEMA)
    blocker = os.path.join(spark.sparkContext.getCheckpointDir().replace("file:", ""), "blocker-file")
    with open(blocker, "w") as f:
        f.write("x")
    out, note = persist(res, f"file:{blocker}/sub", note="earlier note")
    assert note.startswith("earlier note Writing to")
    assert out.first().content == "A"


def test_manifest_lines_are_the_entries(spark):
    res = spark.createDataFrame([("https://e.com/bad", False, "time\nout", None, None, None, 3), ("https://e.com/root", True, None, 0, None, "Root", 1),
                                 ("https://e.com/child", True, None, 1, "https://e.com/root", "Child", 2)], RES_SCHEMA)
    out_dir = sink_dir(spark)
    out, _ = persist(res, out_dir)
    lines = [json.loads(r.value) for r in spark.read.text(f"{out_dir}/manifest").collect()]
    assert [e["success"] for e in lines] == [True, True, False]
    assert lines[0]["depth"] == 0 and "parent_url" not in lines[0] and lines[1]["parent_url"] == "https://e.com/root"
    assert lines[2] == {"url": "https://e.com/bad", "success": False, "error": "time\nout"}
    back = {r.url: r for r in read_manifest(spark, out_dir).collect()}
    assert back["https://e.com/child"].file == out.filter("url like '%child'").first().file and back["https://e.com/bad"].file is None


def test_only_folders_of_colliding_names_are_rewritten(spark):
    out_dir = sink_dir(spark)
    crawl = lambda pages: write_pages(spark.createDataFrame(
        [(u, True, None, None, None, c, k) for k, (u, c) in enumerate(pages)], RES_SCHEMA), out_dir)
    urls = [f"https://e.com/{k}" for k in range(40)]
    crawl([(u, "old") for u in urls])
    files = lambda: {r[0] for r in spark.read.parquet(f"{out_dir}/pages").select("_metadata.file_path").distinct().collect()}
    before = files()
    crawl([(urls[3], "new"), ("https://e.com/more", "x"), (urls[3], "newest")])
    after = files()
    assert len(before - after) <= 2 and len(before & after) >= len(before) - 2
    got = {r.url: r.content for r in read_pages(spark, out_dir).collect()}
    assert got == {u: "old" for u in urls} | {urls[3]: "newest", "https://e.com/more": "x"}
    assert read_pages(spark, sink_dir(spark)).collect() == []


def test_an_error_of_the_crawl_is_raised(spark):
    res = spark.createDataFrame([("https://e.com/a", True, None, None, None, "A", 1)], RES_SCHEMA)
    with pytest.raises(Exception, match="broken page"):
        persist(res.withColumn("content", F.raise_error(F.lit("broken page")).cast("string")), sink_dir(spark))
