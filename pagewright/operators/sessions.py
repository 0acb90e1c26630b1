"""Pacing, progress and sessions (WIN1-WIN6) as batch window operators.

Every per-key sequence computation (row numbers, lags, running counts) is a distributed prefix scan
(``prefix``): a key holding a large share of all rows is cut along its own order into pieces of
about equal size and stitched with one summary per piece. The inputs are read several times
(counts, a sample, the rows); write an expensive one as a table first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.operators import prefix

SESSION_TTL_SECONDS = 1800
IDLE_GAP_SECONDS = 1800


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def fetch_plan(pages: DataFrame, max_concurrent: int = 10, delay_s: float = 0.0, key: str = "host") -> DataFrame:
    """WIN1: per host, requests in page order get a lane and an earliest start offset.

    ``lane = (rn-1) % max_concurrent``; ``start_s = (rn-1) div max_concurrent * delay``.
    """
    if max_concurrent < 1:
        raise ValueError("max_concurrent must be >= 1")
    d = pages.withColumn(key, U.host("url")) if key == "host" and key not in pages.columns else pages
    d = prefix.row_number(d, [key], ["page_id"], out="rn", written=False)
    return d.withColumn("lane", ((F.col("rn") - 1) % max_concurrent).cast("int")) \
        .withColumn("start_s", (F.floor((F.col("rn") - 1) / max_concurrent) * F.lit(float(delay_s))).cast("double"))


def progress(events: DataFrame, batch_col: str, ts_col: str, seq_col: str, total: bool = True) -> DataFrame:
    """WIN2: after each completed item, ``done`` (strictly increasing) and ``total`` per batch."""
    d = prefix.running_count(events, [batch_col], [_micros(ts_col), seq_col], total="total" if total else None, written=False)
    return d if total else d.withColumn("total", F.lit(None).cast("long"))


def sessionize(events: DataFrame, key: str, ts_col: str, seq_col: str, gap_s: int = IDLE_GAP_SECONDS
               ) -> DataFrame:
    """WIN4: a gap of ``gap_s`` or more starts a new session; adds ``session_no`` (1-based)."""
    d = events.withColumn("_t", _micros(ts_col))
    return prefix.sessions(d, [key], ["_t", seq_col], "_t", gap_s * 1_000_000, written=False).drop("_t")


def session_summary(sessionized: DataFrame, key: str, ts_col: str, gap_s: int = IDLE_GAP_SECONDS) -> DataFrame:
    """Per session: first/last event (epoch micros), end = last + gap, event count."""
    t = _micros(ts_col)
    return sessionized.groupBy(key, "session_no").agg(
        F.min(t).alias("first_us"), F.max(t).alias("last_us"), F.count(F.lit(1)).cast("long").alias("n_events")) \
        .withColumn("end_us", F.col("last_us") + F.lit(gap_s * 1_000_000))


def session_registry(declared: DataFrame, uses: DataFrame, now_us: int, ttl_s: int = SESSION_TTL_SECONDS
                     ) -> DataFrame:
    """WIN3/WIN5: live iff idle <= ttl measured from last use (strict > expires); never used ->
    declared. ``declared(session_id, declared_us)``, ``uses(session_id, ts_us)`` (any outcome)."""
    last = uses.groupBy("session_id").agg(F.max("ts_us").alias("last_used_us"))
    s = declared.join(last, "session_id", "left")
    idle = (F.lit(now_us) - F.col("last_used_us")) / F.lit(1_000_000.0)
    state = F.when(F.col("last_used_us").isNull(), "declared").when(idle > ttl_s, "expired").otherwise("live")
    since = F.when(F.col("last_used_us").isNull(), (F.lit(now_us) - F.col("declared_us")) / F.lit(1_000_000.0)) \
        .otherwise(idle)
    return s.select("session_id", state.alias("state"), F.bround(since / 60.0, 0).cast("long").alias("minutes"))


def session_ledger(actions: DataFrame, key: str = "session_id", ts_col: str = "ts", seq_col: str = "seq",
                   action_col: str = "action") -> DataFrame:
    """WIN6: event-sourced create/destroy/use log -> per id accepted/refused counts and final state.

    The state before an event is set by the previous event alone (create or use -> alive,
    destroy -> gone), so a skew-safe lag replaces a sequential state machine. A create while
    alive is refused as a duplicate; a destroy while gone reports not-found.
    """
    d = actions.withColumn("_ord_", F.struct(_micros(ts_col).alias("t"), F.col(seq_col).alias("s")))
    d = prefix.lag(d, [key], ["_ord_"], action_col, out="_prev", written=False)
    alive_before = F.col("_prev").isNotNull() & (F.col("_prev") != "destroy")
    a = F.col(action_col)
    d = d.withColumn("dup", (a == "create") & alive_before).withColumn("not_found", (a == "destroy") & ~alive_before)
    return d.groupBy(key).agg(
        F.count_if((a == "create") & ~F.col("dup")).cast("long").alias("created"),
        F.count_if("dup").cast("long").alias("refused_duplicates"),
        F.count_if((a == "destroy") & ~F.col("not_found")).cast("long").alias("destroyed"),
        F.count_if("not_found").cast("long").alias("not_found"),
        (F.max_by(a, "_ord_") != "destroy").alias("alive"))
