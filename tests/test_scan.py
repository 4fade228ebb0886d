"""Hot-key scans against plain window functions, across chunk borders."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL_DIR, rows_of
from weir.operators import joins, keyed_state, lateness, running, scan, windows
from weir.operators.scan import KeyedScan
from weir.plans.tables import events, shuffled_arrival


@pytest.fixture(scope="module")
def skewed(spark):
    """Events with a third of all rows on one key."""
    rows = events(spark, SMALL_DIR).select("event_id", "user_id", "event_type", "ts_ms", "cents", "k")
    user = F.when(F.col("event_id") % 3 == 0, 999).otherwise(F.col("user_id"))
    return rows.withColumn("user_id", user).cache()


SIZES = [{"chunks": 1}, {"chunks": 2}, {"chunks": 16}, {"chunks": 4096}, {}]
UP_TO_NOW = (Window.unboundedPreceding, Window.currentRow)


@pytest.mark.parametrize("sizes", SIZES, ids=str)
def test_folds_equal_plain_windows(skewed, sizes):
    window = Window.partitionBy("user_id").orderBy("event_id")
    so_far = window.rowsBetween(*UP_TO_NOW)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    sparse = F.when(F.col("k") > 80, F.col("k"))
    expected = skewed.select(
        "event_id",
        F.sum("cents").over(so_far),
        F.count("*").over(so_far),
        F.max("cents").over(so_far),
        F.min("cents").over(so_far),
        F.max("cents").over(before),
        F.first("k").over(so_far),
        F.last(sparse, True).over(so_far),
        F.lag("ts_ms").over(window),
    )
    scanned = KeyedScan(skewed, ["user_id"], ["event_id"], **sizes).add(
        total=scan.running_sum(F.col("cents")),
        n=scan.running_count(),
        top=scan.running_max(F.col("cents")),
        low=scan.running_min(F.col("cents")),
        top_before=scan.max_before(F.col("cents")),
        first=scan.first_seen("k"),
        known=scan.last_known(sparse),
        before=scan.previous(F.col("ts_ms")),
    )
    got = scanned.result().select(
        "event_id", "total", "n", "top", "low", "top_before", "first.k", "known", "before"
    )
    assert rows_of(got) == rows_of(expected)


@pytest.mark.parametrize("sizes", SIZES, ids=str)
def test_null_keys_and_orders_and_sparse_orders(spark, sizes):
    """A hot NULL key, orders 1,000,003 apart, and NULL order values."""
    rows = [(i * 1_000_003, None if i % 3 == 0 else i % 5, i % 4 or None) for i in range(2000)]
    rows += [(None, None, 7), (None, 1, None)]
    frame = spark.createDataFrame(rows, "s bigint, k int, v bigint")
    window = Window.partitionBy("k").orderBy("s")
    so_far = window.rowsBetween(*UP_TO_NOW)
    expected = frame.select(
        "k", "s", F.sum("v").over(so_far), F.first("s").over(so_far), F.last("v", True).over(so_far)
    )
    got = KeyedScan(frame, ["k"], ["s"], **sizes).add(
        total=scan.running_sum(F.col("v")), first=scan.first_seen("s"), known=scan.last_known(F.col("v"))
    )
    assert rows_of(got.result(), "k", "s", "total", "first.s", "known") == rows_of(expected)


def _scanned(frame, **sizes):
    return KeyedScan(frame, ["k"], ["s"], **sizes)


def test_a_heavy_key_is_cut_evenly(spark):
    """The prefix of a key is as long as its chunks, not as its rows."""
    frame = spark.range(50_000).select((F.col("id") * 1_000_003).alias("s"), F.lit(1).alias("k"))
    groups = _scanned(frame, chunks=64).frame.groupBy(scan.CHUNK).count().collect()
    assert 60 <= len(groups) <= 64
    assert max(r["count"] for r in groups) <= 2 * 50_000 / 64


@pytest.mark.parametrize("shares", [8, 64, 1000])
@pytest.mark.parametrize("order", ["s", "-s", "s % 97", "xxhash64(s)"])
def test_only_heavy_keys_have_summaries(spark, shares, order):
    """Zipf-like keys: whatever the order, keys above two and a half shares are cut into
    chunks of about a share, light ones never, and summaries are no more than shares."""
    n = 40_000
    rows = spark.range(n).select(
        F.expr("CASE WHEN id % 3 = 0 THEN NULL ELSE floor(pow(10000, (id % 7919) / 7919.0)) END").cast("int").alias("k"),
        F.col("id").alias("s"),
    ).withColumn("s", F.expr(order).cast("bigint"))
    scanned = _scanned(rows, chunks=shares)
    share = n / shares
    seen = 0
    for r in scanned.frame.groupBy("k").agg(
        F.count("*").alias("n"), F.max(scan.CHUNK).alias("top"), F.count_distinct("s").alias("orders")
    ).collect():
        if r.n > 2.5 * share:
            assert r.top is not None
            if r.orders > 1000:
                assert r.top + 1 >= r.n / share / 2
        if r.n < 0.8 * share:
            assert r.top is None
        seen += r.top is not None
    summaries = scanned.summaries(n=scan.running_count())
    assert seen and summaries.count() <= shares
    if order in ("s", "-s"):
        assert summaries.agg(F.max("_part_n")).first()[0] <= 3 * share


def test_light_keys_need_no_summaries(spark):
    frame = spark.range(10_000).select(F.col("id").alias("s"), (F.col("id") % 997).alias("k"))
    scanned = _scanned(frame)
    assert not scanned.divided
    plan = scanned.add(n=scan.running_count()).result()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_chunks_follow_rows_and_partitions(spark, monkeypatch):
    frame = spark.range(10_000).select(F.col("id").alias("s"), F.lit(5).alias("k"))
    few = _scanned(frame).summaries(n=scan.running_count()).count()
    assert few <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(scan, "CHUNK_ROWS", 100)
    for keys in (["k"], []):
        many = KeyedScan(frame, keys, ["s"]).summaries(n=scan.running_count())
        assert 90 <= many.count() <= 100 and many.agg(F.max("_part_n")).first()[0] <= 210


def test_given_chunks(spark):
    rows = [(i % 3 or None, i, i) for i in range(300)] + [(None, None, 7), (1, None, None)]
    frame = spark.createDataFrame(rows, "k int, s bigint, v bigint")
    so_far = Window.partitionBy("k").orderBy("s").rowsBetween(*UP_TO_NOW)
    expected = frame.select("k", "s", F.sum("v").over(so_far))
    got = KeyedScan(frame, ["k"], ["s"], chunk=F.floor(F.col("s") / 7)).add(t=scan.running_sum(F.col("v")))
    assert rows_of(got.result(), "k", "s", "t") == rows_of(expected)


@pytest.mark.parametrize("chunks", [1, 4, 64, 4096])
def test_whole_table_scans(skewed, chunks):
    arrived = shuffled_arrival(skewed)
    order = Window.orderBy("arrival", "event_id")
    size = 3_600_000
    start = F.col("ts_ms") - F.col("ts_ms") % size
    seen = F.max("ts_ms").over(order.rowsBetween(Window.unboundedPreceding, -1))
    expected = arrived.select("event_id", F.coalesce(start + size <= seen, F.lit(False)))
    flagged = lateness.flag_late(
        arrived, ["arrival", "event_id"], "ts_ms", size, chunks=chunks
    )
    assert rows_of(flagged, "event_id", "late") == rows_of(expected)

    now = F.max("ts_ms").over(order.rowsBetween(*UP_TO_NOW))
    flushed = keyed_state.flush_at_watermark_boundary(
        arrived, ["arrival", "event_id"], "ts_ms", size, chunks=chunks
    )
    expected = arrived.select("event_id", now - now % size + size)
    assert rows_of(flushed, "event_id", "flush_ms") == rows_of(expected)

    counted = windows.count_window_sum(
        skewed, "event_id", "cents", 7, chunks=chunks
    )
    values = [r.cents for r in skewed.orderBy("event_id").collect()]
    full = len(values) // 7
    assert rows_of(counted, "window_index", "total") == sorted(
        ((i, sum(values[7 * i : 7 * i + 7])) for i in range(full)), key=repr
    )


def test_operators_agree_with_and_without_splitting(skewed):
    split = {"chunks": 64}
    facts = skewed.where("event_type = 'purchase'").select("event_id", "user_id", "cents")
    changes = skewed.where("event_type in ('view', 'signup')").select(
        "event_id",
        "user_id",
        F.col("k").cast("string").alias("name"),
        F.when(F.col("event_type") == "signup", "delete").otherwise("put").alias("op"),
    )
    cases = [
        lambda **s: running.running_sum_concat_key(skewed, ["user_id", "k"], "event_id", "cents", **s),
        lambda **s: running.running_views_and_users(skewed, ["event_type"], "user_id", "event_id", **s),
        lambda **s: running.running_two_level(skewed, "event_type", "user_id", "event_id", "cents", **s),
        lambda **s: running.retract_changelog(skewed, ["user_id"], "event_id", "cents", **s),
        lambda **s: keyed_state.value_total_ttl(
            skewed, ["user_id"], "ts_ms", "event_id", "cents", "3 hours", **s
        ),
        lambda **s: joins.versioned_lookup(facts, changes, "user_id", "event_id", **s),
    ]
    for build in cases:
        assert rows_of(build(**split)) == rows_of(build())


def test_session_sum_equals_builtin_sessions(skewed):
    timed = skewed.withColumn("ts", F.timestamp_millis("ts_ms"))
    builtin = timed.groupBy(F.session_window("ts", "10 minutes").alias("w"), "user_id").agg(
        F.sum("cents").alias("total")
    )
    expected = builtin.select(
        "user_id", F.unix_millis("w.start"), F.unix_millis("w.end"), "total"
    )
    got = windows.session_sum(skewed, ["user_id"], "ts_ms", "cents", "10 minutes")
    assert rows_of(got, "user_id", "window_start", "window_end", "total") == rows_of(expected)


@pytest.mark.parametrize("size,slide", [(10, 5), (10, 3), (10, 10)])
def test_sliding_windows_equal_builtin(skewed, size, slide):
    timed = skewed.withColumn("ts", F.timestamp_millis("ts_ms"))
    builtin = timed.groupBy(
        F.window("ts", f"{size} hours", f"{slide} hours").alias("w"), "event_type"
    ).agg(F.sum("cents").alias("total"))
    got = windows.slide_sum(
        skewed, ["event_type"], "ts_ms", "cents", f"{size} hours", f"{slide} hours"
    )
    assert rows_of(got, "window_start", "event_type", "total") == rows_of(
        builtin.select(F.unix_millis("w.start"), "event_type", "total")
    )


@pytest.mark.parametrize("sizes", SIZES, ids=str)
def test_fold_with_any_function(skewed, sizes):
    texts = skewed.select("event_id", "user_id", F.col("cents").cast("string").alias("t"))
    got = running.running_fold(texts, ["user_id"], "event_id", "t", max, **sizes)
    window = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(*UP_TO_NOW)
    expected = texts.select("event_id", F.max("t").over(window))
    assert rows_of(got, "event_id", "folded") == rows_of(expected)
    ends = running.running_fold(
        texts.withColumn("t", F.substring("t", -1, 1)), ["user_id"], "event_id", "t",
        lambda a, b: a + b, **sizes,
    )
    kept = {}
    for row in texts.orderBy("event_id").collect():
        kept[row.user_id] = kept.get(row.user_id, "") + row.t[-1]
    longest = ends.groupBy("user_id").agg(F.max_by("folded", "event_id").alias("f")).collect()
    assert {r.user_id: r.f for r in longest} == kept


@pytest.mark.parametrize("sizes", SIZES, ids=str)
def test_fold_skips_nulls(spark, sizes):
    values = {1: [5, None, 3], 2: [None, None], None: [None, 8, None, 4], 3: [7] * 50}
    rows = [(k, i, v) for k, vs in values.items() for i, v in enumerate(vs)]
    frame = spark.createDataFrame(rows, "k int, s bigint, v bigint")
    got = running.running_fold(frame, ["k"], "s", "v", lambda a, b: a | b, **sizes)
    expected = []
    for k, vs in values.items():
        total = None
        for i, v in enumerate(vs):
            total = v if total is None else total if v is None else total | v
            expected.append((k, i, total))
    assert rows_of(got, "k", "s", "folded") == sorted(expected, key=repr)


@pytest.mark.parametrize("sizes", SIZES, ids=str)
def test_distinct_and_two_levels_by_brute_force(spark, sizes):
    rows = [(None if i % 3 == 0 else i % 2, None if i % 11 == 0 else (i * 7) % 13, i, None if i % 5 == 0 else i % 4) for i in range(900)]
    rows += [(77, 1, i, 1) for i in range(900, 905)]
    frame = spark.createDataFrame(rows, "k int, u int, s bigint, v bigint")
    users, views, outer, inner = {}, {}, {}, {}
    counted, totals = [], []
    for k, u, s, v in rows:
        users.setdefault(k, set()).add(u)
        views[k] = views.get(k, 0) + 1
        counted.append((s, views[k], len(users[k])))
        for table, key in ((outer, k), (inner, (k, u))):
            before = table.get(key)
            table[key] = before if v is None else v + (before or 0)
        totals.append((s, outer[k], inner[k, u]))
    got = running.running_views_and_users(frame, ["k"], "u", "s", **sizes)
    assert got.columns == [*frame.columns, "pv", "uv"]
    assert rows_of(got, "s", "pv", "uv") == sorted(counted, key=repr)
    got = running.running_two_level(frame, "k", "u", "s", "v", **sizes)
    assert rows_of(got, "s", "outer_total", "inner_total") == sorted(totals, key=repr)


@pytest.mark.parametrize("block", [1, 2, 5, 4096])
def test_sessions_across_blocks(spark, monkeypatch, block):
    """Sessions within, across and over many blocks, and NULL keys."""
    monkeypatch.setattr(windows, "BLOCK", block)
    times = [0, 3, 10, 20, 31, 200, 205, 500, 501, *range(600, 800, 9), 2000, 2010, 2021]
    rows = [(k, t + i, 1 + i) for i, k in enumerate(["a", None, "b"]) for t in times]
    frame = spark.createDataFrame(rows, "k string, t bigint, v bigint")
    expected = []
    for i, k in enumerate(["a", None, "b"]):
        open_ = None
        for t in [x + i for x in times]:
            if open_ and t - open_[1] <= 10:
                open_ = (open_[0], t, open_[2] + 1 + i)
                continue
            if open_:
                expected.append((k, open_[0], open_[1] + 10, open_[2]))
            open_ = (t, t, 1 + i)
        expected.append((k, open_[0], open_[1] + 10, open_[2]))
    got = windows.session_sum(frame, ["k"], "t", "v", 10)
    assert rows_of(got, "k", "window_start", "window_end", "total") == sorted(expected, key=repr)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_cumulative_windows_across_blocks(skewed, monkeypatch, block):
    monkeypatch.setattr(windows, "BLOCK", block)
    width = 3_600_000
    sums = windows.tumble_sum(skewed, ["user_id"], "ts_ms", "cents", width, "s")
    so_far = Window.partitionBy("user_id").orderBy("window_start").rowsBetween(*UP_TO_NOW)
    expected = sums.select("user_id", "window_start", F.sum("s").over(so_far))
    got = windows.window_cumulative(skewed, ["user_id"], "ts_ms", "cents", width)
    assert rows_of(got, "user_id", "window_start", "total") == rows_of(expected)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("pairs_per_task", [1, 6, 100, 10**9])
def test_heavy_join_groups_are_divided(skewed, how, pairs_per_task):
    left = skewed.where("event_type = 'purchase'").select(
        F.col("event_id").alias("l"), "user_id", F.col("ts_ms").alias("lt")
    )
    right = skewed.where("event_type in ('click', 'view')").select(
        F.col("event_id").alias("r"), "user_id", F.col("ts_ms").alias("rt")
    )
    plain = joins.window_join(left, right, ["user_id"], "1 day", "lt", "rt", how)
    divided = joins.window_join(
        left, right, ["user_id"], "1 day", "lt", "rt", how, "l", "r", pairs_per_task
    )
    assert divided.columns == plain.columns
    assert plain.count() > left.count()
    assert rows_of(divided) == rows_of(plain)


def test_copies_grow_with_the_root_of_the_pairs(spark):
    side = spark.range(4000).select(F.col("id").alias("l"), F.lit(1).alias("k"))
    other = side.withColumnRenamed("l", "r")
    grids = joins._grids(side, other, ["k"], 10_000)
    copied = joins._in_cells(side.join(grids, "k", "left"), ["k"], side.columns, "l", True)
    assert copied.count() == 4000 * 40
    assert joins.divided_join(side, other, ["k"], "l", "r", "inner", 10_000).count() == 4000 * 4000


def test_heavy_lists_are_divided(skewed):
    def live(**options):
        return keyed_state.list_ttl(
            skewed, ["user_id"], "ts_ms", "event_id", "event_type", "12 hours", **options
        )

    assert rows_of(live(pairs_per_task=5)) == rows_of(live())
