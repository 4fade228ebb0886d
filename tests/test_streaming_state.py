"""Keyed state, expiry and timers against the batch operators."""

from __future__ import annotations

import time
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_DIR, rows_of
from streams import run_to_end, stream_of, wait_until, write_batch
from weir.functions.times import minute_label
from weir.operators import joins, keyed_state, running
from weir.plans.tables import events
from weir.streaming import stateful
from weir.streaming.windows import with_event_time

SCHEMA = (
    "event_id BIGINT, user_id BIGINT, event_type STRING, ts_ms BIGINT, cents BIGINT, k INT"
)


@pytest.fixture(scope="module")
def rows(spark):
    return (
        events(spark, SMALL_DIR)
        .where("event_id < 120")
        .select("event_id", "user_id", "event_type", "ts_ms", "cents", "k")
        .cache()
    )


@pytest.fixture(scope="module")
def source(rows, tmp_path_factory):
    directory = tmp_path_factory.mktemp("events")
    data = [r.asDict() for r in rows.orderBy("event_id").collect()]
    write_batch(directory, data[:50])
    write_batch(directory, list(reversed(data[50:])))
    return directory


@pytest.fixture(scope="module")
def stream(spark, source):
    return stream_of(spark, source, SCHEMA)


def test_running_total(rows, stream, tmp_path):
    out = stateful.RunningTotal("user_id", "event_id", "cents").apply(
        stream, "user_id BIGINT, event_id BIGINT, total BIGINT"
    )
    expected = running.running_sum(rows, ["user_id"], "event_id", "cents")
    columns = ["user_id", "event_id", "total"]
    assert rows_of(run_to_end(out, tmp_path), *columns) == rows_of(expected, *columns)


def test_reduce_in_batch(rows):
    out = stateful.ReduceByKey("user_id", "event_id", "cents", max).apply(
        rows, "user_id BIGINT, event_id BIGINT, reduced BIGINT"
    )
    expected = running.running_reduce(rows, ["user_id"], "event_id", "cents", "max")
    columns = ["user_id", "event_id", "reduced"]
    assert rows_of(out, *columns) == rows_of(expected, *columns)


def test_retract_log(rows, stream, tmp_path):
    out = stateful.RetractLog("user_id", "event_id", "cents").apply(
        stream, "user_id BIGINT, event_id BIGINT, is_add BOOLEAN, total BIGINT"
    )
    expected = running.retract_changelog(rows, ["user_id"], "event_id", "cents")
    assert rows_of(run_to_end(out, tmp_path)) == rows_of(expected)


def test_views_and_users(rows, stream, tmp_path):
    out = stateful.ViewsAndUsers("event_type", "event_id", "user_id").apply(
        stream, "event_type STRING, event_id BIGINT, pv BIGINT, uv BIGINT"
    )
    expected = running.running_views_and_users(rows, ["event_type"], "user_id", "event_id")
    columns = ["event_type", "event_id", "pv", "uv"]
    assert rows_of(run_to_end(out, tmp_path), *columns) == rows_of(expected, *columns)


def test_two_levels(rows, stream, tmp_path):
    out = stateful.TwoLevelTotals("event_type", "user_id", "event_id", "cents").apply(
        stream, "o STRING, event_id BIGINT, i STRING, outer_total BIGINT, inner_total BIGINT"
    )
    expected = running.running_two_level(rows, "event_type", "user_id", "event_id", "cents")
    columns = ["event_id", "outer_total", "inner_total"]
    assert rows_of(run_to_end(out, tmp_path), *columns) == rows_of(expected, *columns)


def test_versioned_lookup(rows, stream, tmp_path):
    def parts(frame):
        facts = frame.where("event_type = 'purchase'").select("event_id", "user_id", "cents")
        changes = frame.where("event_type in ('view', 'signup')").select(
            "event_id",
            "user_id",
            F.col("k").cast("string").alias("name"),
            F.when(F.col("event_type") == "signup", "delete").otherwise("put").alias("op"),
        )
        return facts, changes

    # one source for both sides, so that they advance through the files together
    kind = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    both = stream.where("event_type in ('purchase', 'view', 'signup')").select(
        "user_id", "event_id", F.col("cents").alias("payload"), kind.alias("kind"),
        F.col("k").cast("string").alias("name"),
        F.when(F.col("event_type") == "signup", "delete").otherwise("put").alias("op"),
    )
    schema = "user_id BIGINT, event_id BIGINT, cents BIGINT, name STRING"
    out = stateful.VersionedLookup("user_id", "event_id").apply(both, schema)
    expected = joins.versioned_lookup(*parts(rows), "user_id", "event_id")
    columns = ["user_id", "event_id", "cents", "name"]
    assert rows_of(run_to_end(out, tmp_path), *columns) == rows_of(expected, *columns)
    laid_out = stateful.lookup_input(*parts(rows), "user_id", "event_id", "cents")
    batch = stateful.VersionedLookup("user_id", "event_id").apply(laid_out, schema)
    assert rows_of(batch, *columns) == rows_of(expected, *columns)


def test_event_time_timer(spark, tmp_path):
    records = [(0, 1_000), (1, 9_000), (2, 10_000), (3, 25_000), (4, 26_000)]
    for seq, ts in records:
        write_batch(tmp_path / "in", [{"k": "a", "seq": seq, "ts": ts, "v": seq}])
    write_batch(tmp_path / "in", [{"k": "end", "seq": 9, "ts": 10**9, "v": 0}])
    schema = "k STRING, seq BIGINT, ts BIGINT, v BIGINT"
    timed = with_event_time(stream_of(spark, tmp_path / "in", schema), "ts")
    out = stateful.FlushAtWatermarkBoundary("k", "seq", "ts", "v", "10 seconds").apply(
        timed, "k STRING, seq BIGINT, v BIGINT, flush_ms BIGINT"
    )
    got = run_to_end(out, tmp_path / "cp").where("k = 'a'")
    batch = keyed_state.flush_at_watermark_boundary(
        spark.createDataFrame([(s, t) for s, t in records], "seq BIGINT, ts BIGINT"),
        ["seq"], "ts", "10 seconds",
    )
    assert rows_of(got, "seq", "flush_ms") == rows_of(batch, "seq", "flush_ms")
    assert rows_of(batch, "seq", "flush_ms") == [
        (0, 10_000), (1, 10_000), (2, 20_000), (3, 30_000), (4, 30_000)
    ]


class Clocked:
    """A query on the processing clock, fed file by file; it must be stopped."""

    def __init__(self, frame, checkpoint, directory):
        self.name = "c" + uuid.uuid4().hex
        self.spark, self.directory, self.seq = frame.sparkSession, directory, 0
        self.query = (
            frame.writeStream.format("memory").queryName(self.name).outputMode("append")
            .option("checkpointLocation", str(checkpoint))
            .trigger(processingTime="500 milliseconds").start()
        )

    def put(self, *values, key="a"):
        """Add one record per value and wait until they came out (as ``seq``)."""
        batch = [{"k": key, "seq": self.seq + i, "v": v} for i, v in enumerate(values)]
        self.seq += len(batch)
        write_batch(self.directory, batch)

    def rows(self):
        return self.spark.table(self.name)

    def await_rows(self, n):
        assert wait_until(lambda: self.rows().count() >= n), self.query.exception()


SIMPLE = "k STRING, seq BIGINT, v BIGINT"


def test_state_expiry(spark, tmp_path):
    """Live after a short pause, gone after one longer than the expiry time."""
    ttl = "20 seconds"
    operators = {
        "value": (stateful.RunningTotal("k", "seq", "v", ttl), "k STRING, seq BIGINT, o BIGINT"),
        "list": (stateful.LiveList("k", "seq", "s", ttl), "k STRING, seq BIGINT, o STRING"),
        "map": (
            stateful.MinuteBuckets("k", "seq", "s", "v", ttl),
            "k STRING, seq BIGINT, m STRING, o BIGINT",
        ),
    }
    queries = {}
    for name, (operator, schema) in operators.items():
        directory = tmp_path / name
        directory.mkdir()
        frame = stream_of(spark, directory, SIMPLE).withColumn("s", F.lit("m"))
        queries[name] = Clocked(operator.apply(frame, schema), tmp_path / f"cp_{name}", directory)
    try:
        for q in queries.values():
            q.put(1)
        for q in queries.values():
            q.await_rows(1)
        for q in queries.values():
            q.put(1)
        for name, q in queries.items():
            q.await_rows(3 if name == "list" else 2)
        time.sleep(25)
        for q in queries.values():
            q.put(1)
        for name, q in queries.items():
            q.await_rows(4 if name == "list" else 3)
        assert rows_of(queries["value"].rows(), "seq", "o") == [(0, 1), (1, 2), (2, 1)]
        assert rows_of(queries["map"].rows(), "seq", "o") == [(0, 1), (1, 2), (2, 1)]
        assert rows_of(queries["list"].rows(), "seq") == [(0,), (1,), (1,), (2,)]
    finally:
        for q in queries.values():
            q.query.stop()


def test_clock_timer(spark, tmp_path):
    (tmp_path / "in").mkdir()
    frame = stream_of(spark, tmp_path / "in", SIMPLE)
    out = stateful.FlushAtClockBoundary("k", "seq", "v", "2 seconds").apply(
        frame, "k STRING, seq BIGINT, v BIGINT, flush_ms BIGINT"
    )
    clocked = Clocked(out, tmp_path / "cp", tmp_path / "in")
    try:
        clocked.put(7, 8, 9)
        clocked.await_rows(3)
        flushed = clocked.rows().collect()
        assert [r.v for r in flushed] == [7, 8, 9]
        assert len({r.flush_ms for r in flushed}) == 1 and flushed[0].flush_ms % 2000 == 0
        clocked.put(5)
        clocked.await_rows(4)
    finally:
        clocked.query.stop()


def test_minute_buckets_in_batch(rows):
    labelled = rows.withColumn("minute", minute_label(F.col("ts_ms")))
    out = stateful.MinuteBuckets("user_id", "event_id", "minute", "cents", "10 minutes").apply(
        labelled, "user_id BIGINT, event_id BIGINT, minute STRING, total BIGINT"
    )
    expected = keyed_state.minute_bucket_total(rows, ["user_id"], "ts_ms", "event_id", "cents")
    columns = ["user_id", "event_id", "minute", "total"]
    assert rows_of(out, *columns) == rows_of(expected, *columns)
