"""Groups in sorted Arrow streams, and the operators that hand them to user functions."""

from __future__ import annotations

import itertools
import math

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_of
from weir.operators import custom, groups, windows

KEYS = st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "a", ""]))


def table(rows, size):
    columns = list(zip(*rows)) or [(), (), ()]
    types = [pa.int64(), pa.string(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["k", "t", "v"]).to_batches(size)


@settings(max_examples=200, deadline=None)
@given(st.lists(KEYS, max_size=30), st.integers(1, 12))
def test_groups_equal_groupby(keys, size):
    keys.sort(key=repr)
    rows = [(*k, i) for i, k in enumerate(keys)]
    expected = [(k, [r[2] for r in g]) for k, g in itertools.groupby(rows, lambda r: r[:2])]
    got = [
        (k, [v for b in g for v in b.column("v").to_pylist()])
        for k, g in groups.each_group(iter(table(rows, size)), ["k", "t"])
    ]
    assert got == expected
    # groups that are not read are passed over
    assert [k for k, _ in groups.each_group(iter(table(rows, size)), ["k", "t"])] == [k for k, _ in expected]


def test_nan_is_one_group():
    values = [1.0, math.nan, math.nan, None, None]
    batches = pa.table({"x": pa.array(values, pa.float64())}).to_batches(2)
    assert [sum(b.num_rows for b in g) for _, g in groups.each_group(iter(batches), ["x"])] == [1, 2, 2]


def test_a_group_is_read_one_batch_at_a_time():
    """Batches are drawn from the source as the function reads."""
    drawn = []

    def source():
        for i in range(50):
            drawn.append(i)
            yield pa.RecordBatch.from_pydict({"k": [1, 1], "v": [i, i]})

    (_, group) = next(groups.each_group(source(), ["k"]))
    for i, _ in enumerate(group):
        assert len(drawn) <= i + 1


@pytest.mark.parametrize("first", [0, 1])
def test_sides_in_either_order(first):
    rows = [("a", 0, 1), ("a", 0, 2), ("a", 1, 3), ("b", 1, 4), ("c", 0, 5), ("d", 0, 6), ("d", 1, 7)]
    kept = [pa.struct([("x", pa.int64())])] * 2
    columns = [
        pa.array([r[0] for r in rows]),
        pa.array([r[1] for r in rows], pa.int32()),
        *[pa.array([{"x": r[2]} if r[1] == i else None for r in rows], kept[i]) for i in (0, 1)],
    ]
    for size in (1, 2, 3, 100):
        batches = pa.table(columns, names=["k", "_side", "_rows0", "_rows1"]).to_batches(size)
        got = {}
        for key, group in groups.each_group(iter(batches), ["k"], ["_side"]):
            sides = groups.Sides(group, "_side", ("_rows0", "_rows1"))
            read = {i: [v for b in sides.read(i) for v in b.column("x").to_pylist()] for i in (first, 1 - first)}
            got[key[0]] = (read[0], read[1])
        assert got == {"a": ([1, 2], [3]), "b": ([], [4]), "c": ([5], []), "d": ([6], [7])}


def test_full_windows_larger_than_a_batch(spark):
    """One window of one key in many batches, rows in order, beside many small ones."""
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        rows = spark.range(3000).select(
            F.when(F.col("id") < 2000, None).otherwise(F.col("id") % 100).alias("k"), F.lit(5).cast("bigint").alias("ts"), "id"
        )

        def read(key, batches):
            ids = []
            sizes = []
            for b in batches:
                sizes.append(b.num_rows)
                ids += b.column("id").to_pylist()
            yield key[2], len(ids), ids == sorted(ids), max(sizes)

        got = custom.window_apply(rows.repartition(5), ["k"], "ts", 10, read, "k bigint, n int, ordered boolean, most int", ["id"])
        found = rows_of(got)
        assert len(found) == 101 and all(r[2] and r[3] <= 50 for r in found)
        assert dict((r[0], r[1]) for r in found) == {None: 2000, **{i: 10 for i in range(100)}}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_functions_may_give_nothing_or_many(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "ts bigint, k string")

    def each(key, batches):
        if key[2] == "a":
            for b in batches:
                for t in b.column("ts").to_pylist():
                    yield (t,)
                    yield (-t,)

    assert rows_of(custom.window_apply(rows, ["k"], "ts", 10, each, "t bigint")) == [(-1,), (-2,), (1,), (2,)]
    assert custom.window_apply(rows, ["k"], "ts", 10, lambda key, b: None, "t bigint").count() == 0


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_reduced_windows_with_state(spark, monkeypatch, block):
    """Non-commutative carry over NULL and sparse windows, across blocks."""
    monkeypatch.setattr(windows, "BLOCK", block)
    rows = [(t, k, v) for k in ("a", None) for t, v in [(0, "p"), (3, "q"), (12, None), (25, "r"), (26, "s"), (90, "t"), (1000, "u")]]
    frame = spark.createDataFrame(rows, "ts bigint, k string, v string").repartition(3)

    def emit(key, reduced, state):
        if reduced != "u":
            yield key[0], key[1], key[2], reduced, state

    got = custom.window_reduce_process(
        frame, ["k"], "ts", "v", 10, max, lambda a, b: a + b, emit, "s bigint, e bigint, k string, reduced string, state string"
    )
    expected = [
        (s, s + 10, k, r, state) for k in ("a", None) for s, r, state in [(0, "q", "q"), (20, "s", "qs"), (90, "t", "qst")]
    ]
    assert rows_of(got) == sorted(expected, key=repr)
