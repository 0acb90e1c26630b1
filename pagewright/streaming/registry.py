"""The session registry as a stream (WIN3, WIN6): state with event-time timers per session id.

Actions ``create``, ``use`` and ``destroy`` arrive in any order within the watermark's delay. A session's
actions wait in its state until the watermark has passed them and are then taken in event order, so the
decisions do not depend on how the stream was cut into batches:

* ``create`` of a session that lives is refused (``duplicate``) and does not touch it;
* ``destroy`` of one that does not live is ``not_found``;
* ``use`` registers its session whatever its outcome, and renews it;
* a session that was idle for more than the time to live is ``expired`` at the end of that time: a timer
  says so without waiting for another action.

State is kept by bucket: the sessions whose id has the same hash among ``BUCKETS`` share one state, one timer
and one call a batch, since each call and each access to state costs a round trip. A bucket holds the last uses
of the sessions that live and the actions not yet passed (what the delay and one batch hold), packed as Arrow.
An action without a seq comes after the others of its time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pagewright.operators.sessions import SESSION_TTL_SECONDS
from pagewright.streaming.streams import WATERMARK_DELAY, run_to_sink

DECISIONS = "session_id string, seq long, ts_us long, decision string"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: part of the checkpoint, like the number of shuffle partitions: a restarted query needs the same one
BUCKETS = 4096
#: waiting actions that are packed together, and rows that an Arrow batch has (no html here)
PACKED_ROWS, BATCH_ROWS = 1 << 16, 1 << 13
_ACTIONS = pa.schema([("session_id", pa.string()), ("ts_us", pa.int64()), ("seq", pa.int64()), ("action", pa.string())])
_LIVES = pa.schema([("session_id", pa.string()), ("last_us", pa.int64())])
_NO_SEQ = (1 << 63) - 1


def decide(last_us: int | None, ttl_us: int | None, actions: list[tuple[int, int, str]], until_us: int) -> tuple[int | None, list[tuple]]:
    """Take ``(ts_us, seq, action)`` in order, up to the time ``until_us``: the last use of what lives then, and rows
    ``(seq, ts_us, decision)``. An expiry has no seq."""
    out: list[tuple] = []
    for ts, seq, action in [*actions, (until_us, None, None)]:
        if last_us is not None and ttl_us is not None and ts - last_us > ttl_us:
            out.append((None, last_us + ttl_us, "expired"))
            last_us = None
        if action is None:
            break
        if action == "create":
            out.append((seq, ts, "duplicate" if last_us is not None else "created"))
            last_us = ts if last_us is None else last_us
        elif action == "destroy":
            out.append((seq, ts, "not_found" if last_us is None else "destroyed"))
            last_us = None
        else:
            out.append((seq, ts, "used"))
            last_us = ts
    return last_us, out


def _pack(columns: list, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_table(pa.table([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema))
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(blob)).read_all()


class Registry(StatefulProcessor):
    """The sessions of one bucket: ``kept`` has the time of the first waiting action and the last use of each session
    that lives, ``waiting`` the actions."""

    def __init__(self, ttl_us: int | None):
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "first_us long, lives binary")
        self.waiting = handle.getListState("waiting", "actions binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, lives = self._kept()
        parts: list[pd.DataFrame] = []
        for part in rows:
            first = min(int(part["ts_us"].min()), _NO_SEQ if first is None else first)
            parts.append(part)
            if sum(map(len, parts)) >= PACKED_ROWS:
                self._wait(parts)
                parts = []
        if parts:
            self._wait(parts)
        yield self._passed(first, lives, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._passed(*self._kept(), timerValues.getCurrentWatermarkInMs())

    def _kept(self) -> tuple[int | None, dict[str, int]]:
        kept = self.kept.get()
        if kept is None:
            return None, {}
        lives = _unpack(kept[1])
        return kept[0], dict(zip(*(lives.column(c).to_pylist() for c in _LIVES.names), strict=True))

    def _wait(self, parts: list[pd.DataFrame]) -> None:
        rows = pd.concat(parts)
        self.waiting.appendList([(_pack([rows[c] for c in _ACTIONS.names], _ACTIONS),)])

    def _ready(self, watermark_ms: int) -> tuple[pa.Table, int | None]:
        """The actions before the watermark, by session and in order, and the time of the first of the rest."""
        waiting = pa.concat_tables([_unpack(blob) for (blob,) in self.waiting.get()])
        past = waiting.column("ts_us").to_numpy() // 1000 < watermark_ms
        rest = waiting.filter(pa.array(~past))
        self.waiting.clear()
        for a in range(0, rest.num_rows, PACKED_ROWS):
            self.waiting.appendList([(_pack([c.combine_chunks() for c in rest.slice(a, PACKED_ROWS).columns], _ACTIONS),)])
        order = [(c, "ascending") for c in _ACTIONS.names]
        return waiting.filter(pa.array(past)).sort_by(order), int(rest.column("ts_us").to_numpy().min()) if rest.num_rows else None

    def _passed(self, first: int | None, lives: dict[str, int], watermark_ms: int) -> pd.DataFrame:
        """Decide the actions before the watermark, and set the one timer that the rest needs."""
        until = watermark_ms * 1000
        ids: list[str] = []
        out: list[tuple] = []

        def take(session_id: str, actions: list[tuple[int, int, str]]) -> None:
            last, rows = decide(lives.pop(session_id, None), self.ttl_us, actions, until)
            if last is not None:
                lives[session_id] = last
            ids.extend([session_id] * len(rows))
            out.extend(rows)

        if first is not None and first // 1000 < watermark_ms:
            ready, first = self._ready(watermark_ms)
            sessions = ready.column("session_id").combine_chunks().dictionary_encode()
            edges = np.flatnonzero(np.diff(sessions.indices.to_numpy(), prepend=-1, append=-1)).tolist()
            actions = list(zip(*(ready.column(c).to_pylist() for c in ("ts_us", "seq", "action")), strict=True))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                take(sessions[a].as_py(), actions[a:b])
        if self.ttl_us is not None:
            for session_id in [s for s, last in lives.items() if until - last > self.ttl_us]:
                take(session_id, [])
        if first is None and not lives:
            self.kept.clear()
        else:
            self.kept.update((first, _pack([list(lives), list(lives.values())], _LIVES)))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(int(t))
        due = [] if first is None else [first // 1000 + 1]
        if lives and self.ttl_us is not None:
            due.append((min(lives.values()) + self.ttl_us) // 1000 + 1)
        if due:
            self.handle.registerTimer(max(min(due), watermark_ms + 1))
        frame = pd.DataFrame([(i, None if s == _NO_SEQ else s, t, d) for i, (s, t, d) in zip(ids, out, strict=True)], columns=["session_id", "seq", "ts_us", "decision"], dtype="object")
        return frame.astype({"seq": "Int64", "ts_us": "int64"})

    def close(self) -> None:
        pass


def registry_stream(actions: DataFrame, ttl_s: int | None = SESSION_TTL_SECONDS, delay: str = WATERMARK_DELAY, location: str | None = None) -> DataFrame:
    """``session_id, seq, ts_us, decision`` of every action that the watermark has passed, and every expiry.

    ``actions``: a stream ``session_id string, ts timestamp, seq long, action string``; rows without a session
    id or time are left out. ``ttl_s`` None: sessions live until they are destroyed.
    """
    spark = actions.sparkSession
    a = actions.where("session_id IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", delay)
    a = a.select(F.pmod(F.xxhash64("session_id"), F.lit(BUCKETS)).cast("int").alias("bucket"), "session_id", F.coalesce("seq", F.lit(_NO_SEQ)).alias("seq"),
                 "ts", F.unix_micros("ts").alias("ts_us"), F.coalesce("action", F.lit("use")).alias("action"))
    out = a.groupBy("bucket").transformWithStateInPandas(
        Registry(None if ttl_s is None else ttl_s * 1_000_000), DECISIONS, outputMode="Append", timeMode="EventTime")
    # several state variables and timers need this store; the query takes the settings when it starts
    conf = {_STORE: _ROCKS, _BATCH: str(BATCH_ROWS)}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run_to_sink(out, "registry", location=location)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def ledger(decisions: DataFrame) -> DataFrame:
    """The decisions as the counts of ``sessions.session_ledger``, and expiries."""
    count = lambda d: F.count_if(F.col("decision") == d).cast("long")
    lives = F.max_by(~F.col("decision").isin("destroyed", "not_found", "expired"), F.struct("ts_us", F.coalesce("seq", F.lit(-1))))
    return decisions.groupBy("session_id").agg(
        count("created").alias("created"), count("duplicate").alias("refused_duplicates"), count("destroyed").alias("destroyed"),
        count("not_found").alias("not_found"), count("expired").alias("expired"), lives.alias("alive"))
