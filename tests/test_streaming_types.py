"""Keyed state of any type, with NULLs, on streams; and what state access costs."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from conftest import rows_of
from streams import run_to_end, stream_of, write_batch
from weir.streaming import stateful

RECORDS = [
    {"k": "a", "s": 1, "u": None, "d": 0.5, "m": "1.10", "t": "x"},
    {"k": "a", "s": 2, "u": 7, "d": None, "m": None, "t": None},
    {"k": None, "s": 3, "u": 7, "d": None, "m": "2.00", "t": "y"},
    {"k": "a", "s": 4, "u": None, "d": 2.25, "m": "99999999.99", "t": "z"},
    {"k": None, "s": 5, "u": 8, "d": 4.0, "m": "0.01", "t": "w"},
    {"k": "b", "s": 6, "u": 8, "d": None, "m": None, "t": None},
    {"k": "a", "s": 7, "u": 7, "d": 1.0, "m": "-5.00", "t": "q"},
]
SCHEMA = "k STRING, s BIGINT, u BIGINT, d DOUBLE, m DECIMAL(10,2), t STRING"


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    directory = tmp_path_factory.mktemp("typed")
    for part in (RECORDS[:3], list(reversed(RECORDS[3:6])), RECORDS[6:]):
        write_batch(directory, part)
    return directory


def value(record, name):
    found = record[name]
    return Decimal(found) if name == "m" and found is not None else found


def running(name, fn):
    state, out = {}, []
    for r in RECORDS:
        before, item = state.get(r["k"]), value(r, name)
        state[r["k"]] = before if item is None else item if before is None else fn(before, item)
        out.append((r["k"], r["s"], state[r["k"]]))
    return sorted(out, key=repr)


def both(spark, source, tmp_path, operator):
    """Results on a stream and in batch."""
    streamed = run_to_end(operator().apply(stream_of(spark, source, SCHEMA)), tmp_path)
    batch = operator().apply(spark.read.schema(SCHEMA).json(str(source)))
    assert [(f.name, f.dataType) for f in streamed.schema] == [(f.name, f.dataType) for f in batch.schema]
    return streamed, batch


@pytest.mark.parametrize("name, kind", [("d", T.DoubleType()), ("m", T.DecimalType(20, 2)), ("u", T.LongType())])
def test_totals_of_any_number(spark, source, tmp_path, name, kind):
    for out in both(spark, source, tmp_path, lambda: stateful.RunningTotal("k", "s", name)):
        assert out.schema["total"].dataType == kind
        assert rows_of(out) == running(name, lambda a, b: a + b)


def test_reduce_of_text(spark, source, tmp_path):
    for out in both(spark, source, tmp_path, lambda: stateful.ReduceByKey("k", "s", "t", lambda a, b: a + b)):
        assert rows_of(out) == running("t", lambda a, b: a + b)


def test_retractions(spark, source, tmp_path):
    expected, state = [], {}
    for r in RECORDS:
        if r["k"] in state:
            expected.append((r["k"], r["s"], False, state[r["k"]]))
        before = state.get(r["k"])
        state[r["k"]] = before if r["d"] is None else r["d"] + (before or 0)
        expected.append((r["k"], r["s"], True, state[r["k"]]))
    for out in both(spark, source, tmp_path, lambda: stateful.RetractLog("k", "s", "d")):
        assert rows_of(out) == sorted(expected, key=repr)


def test_users_and_inner_keys_may_be_null(spark, source, tmp_path):
    users, views, expected = {}, {}, []
    for r in RECORDS:
        users.setdefault(r["k"], set()).add(r["u"])
        views[r["k"]] = views.get(r["k"], 0) + 1
        expected.append((r["k"], r["s"], views[r["k"]], len(users[r["k"]])))
    for out in both(spark, source, tmp_path / "a", lambda: stateful.ViewsAndUsers("k", "s", "u")):
        assert rows_of(out) == sorted(expected, key=repr)
    outer, inner, expected = {}, {}, []
    for r in RECORDS:
        m = value(r, "m")
        for table, key in ((outer, r["k"]), (inner, (r["k"], r["u"]))):
            table[key] = table.get(key) if m is None else m + (table.get(key) or 0)
        expected.append((r["k"], r["s"], r["u"], outer[r["k"]], inner[r["k"], r["u"]]))
    for out in both(spark, source, tmp_path / "b", lambda: stateful.TwoLevelTotals("k", "u", "s", "m")):
        assert rows_of(out) == sorted(expected, key=repr)


def test_lists_and_buckets(spark, source):
    """In batch; a stream with expiry only ends when stopped (test_streaming_state.py)."""
    rows = spark.read.schema(SCHEMA).json(str(source))
    live, expected = {}, []
    for r in RECORDS:
        live.setdefault(r["k"], []).append(r["d"])
        expected += [(r["k"], r["s"], e) for e in live[r["k"]]]
    assert rows_of(stateful.LiveList("k", "s", "d", "1 hour").apply(rows)) == sorted(expected, key=repr)
    out = stateful.MinuteBuckets("k", "s", "t", "m", "1 hour").apply(rows)
    assert out.schema["total"].dataType == T.DecimalType(20, 2)
    assert rows_of(out) == sorted([(r["k"], r["s"], r["t"], value(r, "m")) for r in RECORDS], key=repr)


@pytest.mark.parametrize("payload", ["m", ["t", "d"]])
def test_lookup_carries_any_payload(spark, source, tmp_path, payload):
    def parts(frame):
        facts, changes = frame.where("s % 2 = 0 OR s = 7"), frame.where("s % 2 = 1 AND s < 7")
        named = changes.selectExpr("k", "s", "d AS name", "CASE WHEN s = 5 THEN 'delete' ELSE 'put' END AS op")
        return stateful.lookup_input(facts, named, "k", "s", payload)

    got = stateful.VersionedLookup("k", "s").apply(parts(spark.read.schema(SCHEMA).json(str(source))))
    by_seq = {r["s"]: r for r in RECORDS}

    def carried(s):
        r = by_seq[s]
        return value(r, "m") if payload == "m" else T.Row(t=r["t"], d=r["d"])

    names = {2: 0.5, 4: 0.5, 6: None, 7: 0.5}
    assert {r.s: (r.payload, r.name) for r in got.collect()} == {s: (carried(s), n) for s, n in names.items()}


class FakeMap:
    """Map state that counts what is asked of it."""

    def __init__(self):
        self.rows, self.reads, self.writes = {}, 0, 0

    def containsKey(self, key):
        return key in self.rows

    def getValue(self, key):
        self.reads += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self.rows[key] = value

    def removeKey(self, key):
        self.rows.pop(key, None)


class FakeHandle:
    def __init__(self):
        self.maps, self.timers = {}, []

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, FakeMap())

    def registerTimer(self, at):
        self.timers.append(at)


class Expired:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


class Watermark:
    def getCurrentWatermarkInMs(self):
        return 0


def test_a_timer_reads_what_it_emits():
    operator = stateful.FlushAtWatermarkBoundary("k", "s", "ts", "v", 10)
    operator.types = {"k": T.StringType(), "s": T.LongType(), "ts": T.LongType(), "v": T.StringType()}
    operator.result = T.Row(*operator.results().fieldNames())
    handle = FakeHandle()
    operator.init(handle)
    rows = [T.Row(k="a", s=i, ts=i, v=str(i)) for i in range(5000)]
    for start in range(0, 5000, 1000):  # micro-batches, each out of order
        assert not list(operator.handleInputRows(("a",), iter(rows[start : start + 1000][::-1]), Watermark()))
    assert sorted(handle.timers) == list(range(10, 5001, 10))
    buffer = handle.maps["buffer"]
    for boundary in (10, 5000):
        buffer.reads = 0
        out = list(operator.handleExpiredTimer(("a",), Watermark(), Expired(boundary)))
        assert [r.s for r in out] == list(range(boundary - 10, boundary)) and buffer.reads == 10
    assert len(buffer.rows) == 4980 and len(handle.maps["sizes"].rows) == 498


def test_state_is_written_once_per_key_and_batch():
    state = FakeMap()
    cached = stateful.CachedMap(state, size=4)
    for i in range(1000):
        n = (cached.get((i % 3,)) or (0,))[0]
        cached.put((i % 3,), (n + 1,))
    assert state.writes == 0
    cached.write()
    assert state.rows == {(0,): (334,), (1,): (333,), (2,): (333,)} and state.writes == 3
    for i in range(100):  # more entries than are held
        cached.put((i,), ((cached.get((i,)) or (0,))[0] + 1,))
    cached.write()
    assert state.rows[(0,)] == (335,) and state.rows[(99,)] == (1,) and len(state.rows) == 100


def test_sums_keep_their_digits():
    big = Decimal("9" * 36 + ".99")
    assert stateful.add(big, Decimal("0.01")) == Decimal("1" + "0" * 36)
    assert stateful.sum_type(T.DecimalType(35, 2)) == T.DecimalType(38, 2)
    with pytest.raises(TypeError):
        stateful.sum_type(T.DateType())
    assert stateful.add(None, None) is None and stateful.add(None, datetime.date.min) == datetime.date.min
