"""The session registry as a stream: decisions do not depend on the batches, and equal the batch ledger."""

import datetime as dt
import random

from pagewright.operators.sessions import session_ledger
from pagewright.streaming.registry import Registry, decide, ledger, registry_stream

SCHEMA = "session_id string, ts timestamp, seq long, action string"
START = dt.datetime(2024, 1, 1)


def _actions(seed, n):
    rnd, t, out = random.Random(seed), 0, []
    for i in range(n):
        t += rnd.choice([0, 1, 20, 400, 1000])
        out.append((rnd.choice(["a", "a", "a", "b", "c", "d"]), START + dt.timedelta(seconds=t), i, rnd.choice(["create", "use", "destroy"])))
    return out


def _stream(spark, folder, batches):
    import os
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/b{k}")
        for f in os.listdir(f"{folder}/b{k}"):  # files are read in the order of their times
            os.utime(f"{folder}/b{k}/{f}", (1_700_000_000 + 10 * k, 1_700_000_000 + 10 * k))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(str(folder))


def _us(t):
    return int((t - START).total_seconds()) * 1_000_000 + 1_704_067_200_000_000


def _replayed(rows, ttl_us, until_us):
    out = set()
    for sid in {r[0] for r in rows}:
        mine = sorted((_us(t), s, a) for i, t, s, a in rows if i == sid and _us(t) < until_us)
        out |= {(sid, *d) for d in decide(None, ttl_us, mine, until_us)[1]}
    return out


def test_rules_of_one_session():
    m = 60_000_000
    acts = [(0, 1, "create"), (29 * m, 2, "create"), (31 * m, 3, "create"), (61 * m, 4, "use"), (91 * m, 5, "destroy"), (92 * m, 6, "destroy")]
    last, out = decide(None, 30 * m, acts, 93 * m)
    # a refused create does not renew; exactly 30 minutes of idling do not expire
    assert last is None and out == [(1, 0, "created"), (2, 29 * m, "duplicate"), (None, 30 * m, "expired"), (3, 31 * m, "created"),
                                    (4, 61 * m, "used"), (5, 91 * m, "destroyed"), (6, 92 * m, "not_found")]
    assert decide(5, 30 * m, [], 5 + 30 * m) == (5, []) and decide(5, 30 * m, [], 6 + 30 * m) == (None, [(None, 5 + 30 * m, "expired")])


def test_decisions_do_not_depend_on_batches(spark, tmp_path):
    rows = _actions(3, 240)
    late = dt.timedelta(minutes=1)
    until = _us(max(t for _, t, _, _ in rows) - late)
    want = _replayed(rows, 1800 * 1_000_000, until)
    assert {"created", "duplicate", "destroyed", "not_found", "used", "expired"} == {d[3] for d in want}
    # several batches, each with its rows out of order
    cut = [rows[k:k + 60] for k in range(0, 240, 60)]
    for c in cut:
        random.Random(9).shuffle(c)
    got = registry_stream(_stream(spark, tmp_path / "many", cut)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_without_expiry_it_is_the_batch_ledger(spark, tmp_path):
    rows = _actions(5, 150)
    late = dt.timedelta(minutes=1)
    until = max(t for _, t, _, _ in rows) - late
    stream = _stream(spark, tmp_path / "in", [rows[:50], rows[50:100], rows[100:]])
    got = {tuple(r) for r in ledger(registry_stream(stream, ttl_s=None)).drop("expired").collect()}
    batch = session_ledger(spark.createDataFrame([r for r in rows if r[1] < until], SCHEMA))
    assert got == {tuple(r) for r in batch.select("session_id", "created", "refused_duplicates", "destroyed", "not_found", "alive").collect()}


class _Handle:
    """State in memory that counts the round trips of a real one."""

    def __init__(self):
        self.calls, self.timers, self.states = 0, set(), {}

    def _state(self, name, schema):
        return self.states.setdefault(name, _State(self))

    getValueState = getListState = _state  # noqa: N815

    def listTimers(self):  # noqa: N802
        self.calls += 1
        return iter(self.timers)

    def deleteTimer(self, t):  # noqa: N802
        self.calls += 1
        self.timers.remove(t)

    def registerTimer(self, t):  # noqa: N802
        self.calls += 1
        self.timers.add(t)


class _State:
    def __init__(self, handle):
        self.handle, self.value = handle, None

    def get(self):
        self.handle.calls += 1
        return iter(self.value) if isinstance(self.value, list) else self.value

    def exists(self):
        self.handle.calls += 1
        return self.value is not None

    def update(self, value):
        self.handle.calls += 1
        self.value = value

    def put(self, values):
        self.update(list(values))

    def clear(self):
        self.update(None)

    def appendList(self, values):  # noqa: N802
        self.update([*(self.value or []), *values])


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def test_state_is_not_asked_once_per_session():
    """The sessions of a bucket take the same few calls together, whatever their number."""
    import pandas as pd
    rnd = random.Random(4)
    rows = [(f"s{rnd.randint(0, 299)}", START + dt.timedelta(seconds=rnd.randint(0, 7200)), k, rnd.choice(["create", "use", "destroy"])) for k in range(2000)]
    handle, got = _Handle(), set()
    bucket = Registry(1800 * 1_000_000)
    bucket.init(handle)
    clocks = [0, _us(START) // 1000 + 2_000_000, _us(START) // 1000 + 5_000_000, _us(START) // 1000 + 20_000_000]
    for k, ms in enumerate(clocks):
        if k < 2:  # rows come with the first two watermarks, then timers only
            new = [r for r in rows if (_us(r[1]) // 1000 < clocks[1]) == (k == 0)]
            frame = pd.DataFrame([(i, s, _us(t), a) for i, t, s, a in new], columns=["session_id", "seq", "ts_us", "action"])
            out = bucket.handleInputRows((0,), iter([frame[:300], frame[300:]]), _Clock(ms))
        else:
            assert min(handle.timers) <= ms
            out = bucket.handleExpiredTimer((0,), _Clock(ms), None)
        got |= {tuple(None if x is pd.NA else x for x in r) for f in out for r in f.astype(object).itertuples(index=False)}
    assert got == _replayed(rows, 1800 * 1_000_000, clocks[-1] * 1000)
    assert not handle.timers and handle.calls < 40


def test_an_action_without_seq_comes_after_the_others_of_its_time(spark, tmp_path):
    t = START + dt.timedelta(hours=1)
    rows = [("a", t, None, "destroy"), ("a", t, 7, "create"), ("b", t, None, None), ("c", t + dt.timedelta(hours=1), 9, "use")]
    got = registry_stream(_stream(spark, tmp_path / "in", [rows])).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("a", 7, _us(t), "created"), ("a", None, _us(t), "destroyed"), ("b", None, _us(t), "used"),
                                                        ("b", None, _us(t) + 1_800_000_000, "expired")], key=repr)
