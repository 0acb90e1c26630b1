"""Profiles (SRC9, SRC10, FIXTURES F10), cache modes (SRC8), sessions/progress/pacing (WIN1-WIN6, F11)."""

import pytest
from pyspark.sql import functions as F

from pagewright.operators.config import (apply_cache_mode, check_profile, effective_keys, overlay,
                                         profiles_table, resolve_cache_mode)
from pagewright.operators.sessions import fetch_plan, progress, session_ledger, session_registry, sessionize

REQ = "rid int, profile string, overrides map<string,string>"


def _overlay(spark, rows):
    out = overlay(spark.createDataFrame(rows, REQ), profiles_table(spark))
    return {r.rid: r for r in out.collect()}


def test_profile_layers_right_wins(spark):
    got = _overlay(spark, [(1, None, None), (2, "fast", None), (3, "fast", {"page_timeout": "5"}),
                           (4, "stealth", {"not_a_real_key": "x", "verbose": "true"})])
    assert got[1].settings["page_timeout"] == "60000" and got[1].word_count_threshold == 10
    assert got[2].settings["page_timeout"] == "15000" and got[2].word_count_threshold == 5
    assert got[3].settings["page_timeout"] == "5"
    assert got[4].ignored_keys == ["not_a_real_key"] and got[4].settings["verbose"] == "false"
    assert "word_count_threshold" not in got[1].settings       # routed to the content filter


def test_profile_keys_split_and_refusal(spark):
    df = spark.createDataFrame([({"page_timeout": "1", "word_count_threshold": "3", "not_a_real_key": "x"},)],
                               "settings map<string,string>")
    r = effective_keys(df).first()
    assert sorted(r.applied) == ["page_timeout", "word_count_threshold"] and list(r.ignored) == ["not_a_real_key"]
    with pytest.raises(ValueError, match="unknown profile 'fsat': choose one of default, fast"):
        check_profile("fsat", ["default", "fast", "js_heavy", "stealth"])


def test_cache_modes(spark):
    assert resolve_cache_mode(None) == "bypass" and resolve_cache_mode(" Read_Only ") == "read_only"
    with pytest.raises(ValueError, match="unknown cache_mode 'bypas'"):
        resolve_cache_mode("bypas")
    req = spark.createDataFrame([("a",), ("b",)], "url string")
    cache = spark.createDataFrame([("a", "<cached>")], "url string, html string")
    fresh = spark.createDataFrame([("a", "<fresh>", 200), ("b", "<fresh>", 200)], "url string, html string, status_code int")

    def run(mode):
        return {r.url: (r.source, r.status_code, r.writes_cache) for r in apply_cache_mode(req, cache, fresh, mode).collect()}
    assert run("enabled") == {"a": ("cache", None, False), "b": ("fresh", 200, True)}
    assert run("read_only") == {"a": ("cache", None, False), "b": ("fresh", 200, False)}
    assert run(None) == {"a": ("fresh", 200, False), "b": ("fresh", 200, False)}
    assert run("write_only") == {"a": ("fresh", 200, True), "b": ("fresh", 200, True)}


MIN = 60_000_000


def test_session_registry(spark):
    now = 1_000 * MIN
    declared = spark.createDataFrame([("s1", now - 90 * MIN), ("s2", now - 200 * MIN), ("s3", now - 5 * MIN),
                                      ("s4", now - 40 * MIN)], "session_id string, declared_us long")
    uses = spark.createDataFrame([("s1", now - 1 * MIN), ("s2", now - 120 * MIN), ("s4", now - 30 * MIN)],
                                 "session_id string, ts_us long")
    got = {r.session_id: (r.state, r.minutes) for r in session_registry(declared, uses, now).collect()}
    assert got == {"s1": ("live", 1), "s2": ("expired", 120), "s3": ("declared", 5), "s4": ("live", 30)}


def test_ledger_duplicate_and_destroy(spark):
    rows = [("a", 1, "create"), ("a", 2, "create"), ("b", 3, "create"), ("a", 4, "destroy"), ("a", 5, "destroy"),
            ("c", 6, "use")]
    df = spark.createDataFrame([(s, f"2024-01-01 00:00:0{t}", t, a) for s, t, a in rows],
                               "session_id string, ts string, seq long, action string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.session_id: (r.created, r.refused_duplicates, r.destroyed, r.not_found, r.alive)
           for r in session_ledger(df).collect()}
    assert got == {"a": (1, 1, 1, 1, False), "b": (1, 0, 0, 0, True), "c": (0, 0, 0, 0, True)}


def test_progress_and_sessions(spark):
    ts = ["2024-01-01 00:00:00", "2024-01-01 00:10:00", "2024-01-01 00:40:00", "2024-01-01 01:10:00",
          "2024-01-01 01:39:59"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(ts)], "u long, seq long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    p = progress(df, "u", "ts", "seq").orderBy("seq").collect()
    assert [r.done for r in p] == [1, 2, 3, 4, 5] and {r.total for r in p} == {5}
    s = sessionize(df, "u", "ts", "seq").orderBy("seq").collect()
    assert [r.session_no for r in s] == [1, 1, 2, 3, 3]        # a gap of exactly 30 min starts a session


def test_fetch_plan_lanes(spark):
    pages = spark.createDataFrame([(i, f"https://h{i % 2}.test/{i}") for i in range(7)], "page_id long, url string")
    got = {r.page_id: (r.rn, r.lane, r.start_s) for r in fetch_plan(pages, 2, 1.5).collect()}
    assert got[0] == (1, 0, 0.0) and got[2] == (2, 1, 0.0) and got[4] == (3, 0, 1.5) and got[6] == (4, 1, 1.5)
