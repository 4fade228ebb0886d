"""Streaming windows, joins and late output against the batch operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_DIR, rows_of
from streams import finish, run_to_end, stream_of, write_batch
from weir.operators import joins, lateness, windows
from weir.plans.tables import events, shuffled_arrival
from weir.streaming import carried, counts, feedback, stateful
from weir.streaming import joins as stream_joins
from weir.streaming import windows as stream_windows

SCHEMA = "event_id BIGINT, event_type STRING, ts_ms BIGINT, cents BIGINT"
FAR = 4_000_000_000_000


@pytest.fixture(scope="module")
def rows(spark):
    return (
        events(spark, SMALL_DIR)
        .where("event_id < 300")
        .select("event_id", "event_type", "ts_ms", "cents")
        .cache()
    )


@pytest.fixture(scope="module")
def source(rows, tmp_path_factory):
    """The events in three files, then a far-future record that closes all windows."""
    directory = tmp_path_factory.mktemp("events")
    data = [r.asDict() for r in rows.orderBy("event_id").collect()]
    for start in range(0, len(data), 100):
        write_batch(directory, data[start : start + 100])
    end = {"event_id": -1, "event_type": "end", "ts_ms": FAR, "cents": 0}
    write_batch(directory, [end])
    return directory


def timed(spark, source, delay="0 seconds"):
    return stream_windows.with_event_time(stream_of(spark, source, SCHEMA), "ts_ms", delay)


def closed(frame):
    return frame.where(F.col("window_start") < FAR - 10**9)


@pytest.mark.parametrize("delay", ["0 seconds", "2 hours"])
def test_tumbling(spark, rows, source, tmp_path, delay):
    got = run_to_end(
        stream_windows.tumble_sum(timed(spark, source, delay), ["event_type"], "cents", "1 hour"),
        tmp_path,
    )
    expected = windows.tumble_sum(rows, ["event_type"], "ts_ms", "cents", "1 hour")
    columns = ["window_start", "window_end", "event_type", "total"]
    assert rows_of(closed(got), *columns) == rows_of(expected, *columns)


def test_unkeyed_tumbling(spark, rows, source, tmp_path):
    got = run_to_end(
        stream_windows.tumble_sum(timed(spark, source), [], "cents", "1 hour"), tmp_path
    )
    expected = windows.window_all_sum(rows, "ts_ms", "cents", "1 hour")
    assert rows_of(closed(got)) == rows_of(expected)


def test_sliding(spark, rows, source, tmp_path):
    frame = stream_windows.slide_sum(
        timed(spark, source), ["event_type"], "cents", "2 hours", "1 hour"
    )
    expected = windows.slide_sum(rows, ["event_type"], "ts_ms", "cents", "2 hours", "1 hour")
    assert rows_of(closed(run_to_end(frame, tmp_path))) == rows_of(expected)


def test_sessions(spark, rows, source, tmp_path):
    frame = stream_windows.session_sum(timed(spark, source), ["event_type"], "cents", "2 hours")
    expected = windows.session_sum(rows, ["event_type"], "ts_ms", "cents", "2 hours")
    columns = ["event_type", "window_start", "window_end", "total"]
    assert rows_of(closed(run_to_end(frame, tmp_path)), *columns) == rows_of(expected, *columns)


def test_cumulative(spark, rows, source, tmp_path):
    frame = stream_windows.window_cumulative(
        timed(spark, source), "event_type", "cents", "1 day"
    )
    expected = windows.window_cumulative(rows, ["event_type"], "ts_ms", "cents", "1 day")
    columns = ["window_start", "event_type", "total"]
    assert rows_of(closed(run_to_end(frame, tmp_path)), *columns) == rows_of(expected, *columns)


def test_arrival_time_windows(spark, source, tmp_path):
    stamped = stream_windows.with_arrival_time(stream_of(spark, source, SCHEMA))
    totals = run_to_end(
        stream_windows.tumble_sum(stamped, ["event_type"], "cents", "10 seconds"),
        tmp_path,
        mode="update",
    )
    assert totals.where("window_end - window_start = 10000").count() == totals.count() > 0


def test_window_joins(spark, rows, source, tmp_path):
    def side(kind, **names):
        frame = timed(spark, source).where(F.col("event_type").isin(kind, "end"))
        return frame.select("etime", (F.col("ts_ms") % 3).alias("k"), *[
            F.col(c).alias(n) for n, c in names.items()
        ])

    def batch_side(kind, **names):
        frame = rows.where(F.col("event_type") == kind)
        return frame.select((F.col("ts_ms") % 3).alias("k"), *[
            F.col(c).alias(n) for n, c in names.items()
        ])

    for how in ("inner", "left"):
        frame = stream_joins.window_join(
            side("purchase", l="event_id"), side("click", r="event_id"), ["k"], "1 day", how
        )
        got = run_to_end(frame, tmp_path / how).where("l >= 0")
        expected = joins.window_join(
            batch_side("purchase", l="event_id", lt="ts_ms"),
            batch_side("click", r="event_id", rt="ts_ms"),
            ["k"], "1 day", "lt", "rt", how,
        )
        assert rows_of(got, "l", "r") == rows_of(expected, "l", "r")


@pytest.mark.parametrize("hot", [None, "k = 1"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_divided_window_joins(spark, rows, source, tmp_path, how, hot):
    def side(kind, **names):
        frame = timed(spark, source).where(F.col("event_type").isin(kind, "end"))
        return frame.select("etime", (F.col("ts_ms") % 3).alias("k"), *[F.col(c).alias(n) for n, c in names.items()])

    def batch_side(kind, **names):
        frame = rows.where(F.col("event_type") == kind)
        return frame.select((F.col("ts_ms") % 3).alias("k"), *[F.col(c).alias(n) for n, c in names.items()])

    frame = stream_joins.window_join(
        side("purchase", l="event_id"), side("click", r="event_id"), ["k"], "1 day", how, left_id="l", spread=4, hot=hot
    )
    got = run_to_end(frame, tmp_path).where("l >= 0")
    expected = joins.window_join(
        batch_side("purchase", l="event_id", lt="ts_ms"), batch_side("click", r="event_id", rt="ts_ms"),
        ["k"], "1 day", "lt", "rt", how,
    )
    assert rows_of(got, "l", "r") == rows_of(expected, "l", "r")


def test_a_hot_key_is_spread_over_tasks(spark, rows):
    """A third of the left rows in one (window, key): no task joins more than its share."""
    left = spark.range(9000).select(
        F.timestamp_millis(F.lit(0)).alias("etime"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("l")
    )
    right = spark.range(10).select(F.timestamp_millis(F.lit(0)).alias("etime"), F.col("id").alias("k"), F.col("id").alias("r"))
    joined = stream_joins.window_join(left, right.hint("shuffle_hash"), ["k"], "1 day", left_id="l", spread=16, hot="k = 0")
    plain = stream_joins.window_join(left, right, ["k"], "1 day")
    assert rows_of(joined, "l", "k", "r") == rows_of(plain, "l", "k", "r")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) > 3000 and max(r["count"] for r in sizes) < 1500


@pytest.mark.parametrize("cuts", [[40], [7, 7, 7, 7, 12], [1] * 13 + [27], [3, 30, 0, 7]])
def test_count_windows_over_micro_batches(spark, tmp_path, cuts):
    data = [{"seq": i, "v": None if i % 6 == 0 else i, "k": "ab"[i % 3 == 0]} for i in range(40)]
    schema = "seq BIGINT, v BIGINT, k STRING"
    writer = counts.CountWindowWriter(str(tmp_path / "out"), "seq", "v", 5)
    at = 0
    for n, size in enumerate(cuts):
        part = spark.createDataFrame([tuple(r.values()) for r in data[at : at + size]], schema)
        writer(part, n)
        writer(part, n)  # a replay
        at += size
    batch = windows.count_window_sum(spark.createDataFrame([tuple(r.values()) for r in data], schema), "seq", "v", 5)
    assert rows_of(writer.read(spark), "window_index", "total") == rows_of(batch, "window_index", "total")
    assert batch.count() == 8


def test_count_windows_per_key_on_a_stream(spark, tmp_path):
    data = [{"seq": i, "v": i / 4, "k": "ab"[i % 3 == 0]} for i in range(40)]
    for start, end in ((0, 11), (11, 12), (12, 40)):
        write_batch(tmp_path / "in", data[start:end][::-1])
    frame = stream_of(spark, tmp_path / "in", "seq BIGINT, v DOUBLE, k STRING")
    got = run_to_end(stateful.CountWindows("k", "seq", "v", 5).apply(frame), tmp_path / "cp")
    batch = windows.count_window_sum(spark.read.json(str(tmp_path / "in")), "seq", "v", 5, keys=["k"])
    assert rows_of(got, "k", "window_index", "total") == rows_of(batch, "k", "window_index", "total")
    assert rows_of(batch.groupBy("k").count()) == [("a", 5), ("b", 2)]


def run_carried(spark, directory, schema, writer, checkpoint):
    query = (
        stream_of(spark, directory, schema).writeStream.foreachBatch(writer)
        .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    )
    finish(query)


def test_late_output_and_replay(spark, rows, tmp_path):
    arrived = shuffled_arrival(rows).orderBy("arrival", "event_id").collect()
    data = [r.asDict() for r in arrived]
    for start in range(0, len(data), 110):
        write_batch(tmp_path / "in", data[start : start + 110])
    end = {"event_id": 10**6, "event_type": "end", "ts_ms": FAR, "cents": 0, "arrival": 10**6}
    write_batch(tmp_path / "in", [end])
    order = ["arrival", "event_id"]
    writer = carried.late_splitting_sum(
        str(tmp_path / "state"), ["event_type"], order, "ts_ms", "cents", "1 hour"
    )
    schema = SCHEMA + ", arrival BIGINT"
    run_carried(spark, tmp_path / "in", schema, writer, tmp_path / "cp")

    def check():
        flagged = lateness.flag_late(shuffled_arrival(rows), order, "ts_ms", "1 hour")
        late = lateness.late_rows(flagged)
        assert late.count() > 0
        assert rows_of(writer.late(spark), "event_id") == rows_of(late, "event_id")
        expected = lateness.normal_window_sum(flagged, ["event_type"], "ts_ms", "cents")
        columns = ["window_start", "window_end", "event_type", "first_ts", "total"]
        assert rows_of(writer.closed(spark), *columns) == rows_of(expected, *columns)

    check()
    replayed = spark.createDataFrame(data[110:220], schema)
    writer(replayed, 1)
    check()


def test_late_golden_case(spark, tmp_path):
    schema = "ts BIGINT, k STRING, v BIGINT, seq BIGINT"
    batches = [[(1_000, 1)], [(12_000, 10)], [(2_000, 100), (9_999, 1000)], [(30_000, 5)]]
    seq = 0
    for batch in batches:
        records = []
        for ts, v in batch:
            records.append({"ts": ts, "k": "a", "v": v, "seq": seq})
            seq += 1
        write_batch(tmp_path / "in", records)
    writer = carried.late_splitting_sum(
        str(tmp_path / "state"), ["k"], ["seq"], "ts", "v", "10 seconds"
    )
    run_carried(spark, tmp_path / "in", schema, writer, tmp_path / "cp")
    assert rows_of(writer.late(spark), "v") == [(100,), (1000,)]
    assert rows_of(writer.closed(spark), "window_start", "total") == [(0, 1), (10_000, 10)]


def test_top_n(spark, rows, source, tmp_path):
    writer = carried.top_n_per_window(
        str(tmp_path / "state"), ["event_type"], ["event_id"], "ts_ms", "cents", "1 day"
    )
    run_carried(spark, source, SCHEMA, writer, tmp_path / "cp")
    expected = windows.window_top_n(
        rows, ["event_type"], "ts_ms", "cents", "event_id", "1 day", 3
    )
    columns = ["window_start", "event_type", "ts_ms", "cents", "rank"]
    assert rows_of(writer.closed(spark), *columns) == rows_of(expected, *columns)


def test_sql_windows_on_a_stream(spark, rows, source, tmp_path):
    text = (
        "SELECT unix_millis(window.start) AS window_start, event_type, sum(cents) AS total "
        f"FROM {{orders}} GROUP BY {windows.hop_columns('10 hours', '2 hours')}, event_type"
    )
    got = run_to_end(windows.sql_windows(spark, text, orders=timed(spark, source)), tmp_path)
    expected = windows.slide_sum(rows, ["event_type"], "ts_ms", "cents", "10 hours", "2 hours")
    columns = ["window_start", "event_type", "total"]
    assert rows_of(closed(got), *columns) == rows_of(expected, *columns)


def test_grouped_sums_in_update_mode(spark, rows, source, tmp_path):
    stream = stream_of(spark, source, SCHEMA).where("event_type <> 'end'")
    totals = windows.sql_windows(
        spark, "SELECT event_type, sum(cents) AS total FROM {t} GROUP BY event_type", t=stream
    )
    got = run_to_end(totals, tmp_path, "update").groupBy("event_type").agg(F.max("total"))
    assert rows_of(got) == rows_of(rows.groupBy("event_type").agg(F.sum("cents")))


def test_feedback_on_a_stream(spark, tmp_path):
    for batch in ([10, 3], [0, -1]):
        write_batch(tmp_path / "in", [{"v": v} for v in batch])
    writer = feedback.IterateEach(
        str(tmp_path / "out"), lambda p: {"v": p["v"] - 3}, lambda p: p["v"] > 0
    )
    run_carried(spark, tmp_path / "in", "v BIGINT", writer, tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(got, "v") == [(-2,), (-3,), (-4,), (0,)]


def test_empty_micro_batches(spark, tmp_path):
    schema = "ts BIGINT, k STRING, v BIGINT, seq BIGINT"
    writer = carried.late_splitting_sum(
        str(tmp_path / "state"), ["k"], ["seq"], "ts", "v", "10 seconds"
    )
    empty = spark.createDataFrame([], schema)
    batches = [empty, spark.createDataFrame([(1_000, "a", 1, 0)], schema), empty,
               spark.createDataFrame([(2_000, "a", 2, 1), (10_000, "a", 4, 2)], schema)]
    for batch_id, batch in enumerate(batches):
        writer(batch, batch_id)
    assert rows_of(writer.closed(spark), "window_start", "total") == [(0, 3)]
    assert writer.late(spark).isEmpty()
