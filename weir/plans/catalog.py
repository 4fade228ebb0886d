"""Every registered query, bound to the parquet tables.

Events are minutes apart in the tables, so window sizes, gaps and expiry times
are hours where a live stream would use seconds.
"""

from __future__ import annotations

import operator
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions import text as tx
from weir.functions import times
from weir.operators import (
    custom,
    iterate,
    joins,
    keyed_state,
    lateness,
    placement,
    records,
    running,
    windows,
)
from weir.plans.tables import as_lines, events, events_of, shuffled_arrival, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LETTER_PLACES = 4  # places 1 to 3 of the first-letter rule, and an unused 0
LINE = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("word", T.StringType()),
        T.StructField("n", T.IntegerType()),
    ]
)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Records


@query
def parse_delimited(spark, sf_dir):
    lines = as_lines(events(spark, sf_dir), "ts_ms", "event_type", "cents")
    return records.parse_delimited(lines, LINE)


@query
def map_upper(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type")
    return records.map_upper(rows, "event_type")


@query
def custom_map_operator(spark, sf_dir):
    def upper(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pc.utf8_upper(batch.column(1))], names=["event_id", "event_type"]
        )

    rows = events(spark, sf_dir).select("event_id", "event_type")
    return records.map_batches(rows, upper, rows.schema)


@query
def flatmap_words(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return records.flat_map_words(rows, "text")


@query
def word_count(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("text")
    return records.word_count(records.flat_map_words(rows, "text"))


@query
def word_count_filtered(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("text")
    return records.word_count(records.flat_map_words(rows, "text"), exclude="the")


@query
def filter_predicates(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type", "k")
    return records.filter_each(
        rows,
        {
            "not_error": records.not_equal("event_type", "error"),
            "not_prefixed": records.not_prefixed("event_type", "err"),
            "positive": records.positive("k"),
            "not_positive": records.not_positive("k"),
        },
    )


@query
def validate_fail_fast(spark, sf_dir):
    clean = events(spark, sf_dir).where(records.not_equal("event_type", "error"))
    return records.validate_fail_fast(clean.select("event_id", "event_type"), "event_type")


@query
def json_skip_bad(spark, sf_dir):
    spoilt = F.when(F.col("event_id") % 10 == 0, "bad").otherwise(F.col("props"))
    rows = table(spark, sf_dir, "events").select("event_id", spoilt.alias("value"))
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return records.json_skip_bad(rows, schema, defaults={"k": 0})


@query
def side_output_routes(spark, sf_dir):
    mixed = F.when(F.col("event_id") % 5 == 0, F.col("event_type")).otherwise(
        F.col("event_id").cast("string")
    )
    rows = events(spark, sf_dir).select("event_id", mixed.alias("value"))
    return records.tagged_outputs(rows)


@query
def co_map_union(spark, sf_dir):
    return records.co_map(
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "supplier"),
        {"name": F.col("c_name")},
        {"name": F.upper("s_name")},
    )


@query
def union_all(spark, sf_dir):
    kinds = [events_of(spark, sf_dir, kind) for kind in ("click", "view", "click")]
    return records.union_all(*kinds).select("event_id", "event_type")


@query
def union_filter_fail_fast(spark, sf_dir):
    clicks = events_of(spark, sf_dir, "click").select("event_id", "event_type")
    topic = events(spark, sf_dir).select("event_id", "event_type")
    merged = records.union_all(records.validate_fail_fast(clicks, "event_type"), topic)
    kept = merged.where(records.not_prefixed("event_type", "error"))
    return kept.select("event_id", F.encode("event_type", "UTF-8").cast("string").alias("value"))


@query
def scalar_functions(spark, sf_dir):
    kind, ms, cents = F.col("event_type"), F.col("ts_ms"), F.col("cents")
    fields = tx.split_fields(F.concat_ws(",", kind, F.col("k").cast("string"), F.lit("")), ",")
    words = F.array(kind, F.lit("view"), F.lit("a"))
    entries = [
        F.struct(F.lit(name).alias("key"), F.col(name).cast("bigint").alias("value"))
        for name in ("cents", "k")
    ]
    amounts = F.map_from_entries(F.array(*entries))
    return events(spark, sf_dir).select(
        "event_id",
        F.size(fields).alias("n_fields"),
        F.upper(kind).alias("upper_type"),
        kind.startswith("c").alias("starts_c"),
        (kind == "view").alias("is_view"),
        F.concat(F.col("user_id").cast("string"), F.lit(" --> "), kind).alias("glued"),
        tx.parse_integer(fields[1]).alias("parsed_int"),
        tx.parse_double(F.concat(F.col("k").cast("string"), F.lit(".5"))).alias("parsed_double"),
        cents.cast("string").alias("cents_text"),
        F.octet_length(F.encode(kind, "UTF-8")).alias("n_bytes"),
        (cents + F.col("k") - F.lit(3)).alias("arithmetic"),
        ((F.col("k") - 50) % 2).alias("signed_remainder"),
        times.next_boundary_ms(ms, 10_000).alias("boundary_ms"),
        times.minute_label(ms).alias("minute"),
        F.coalesce(F.when(F.col("k") > 50, F.col("k")), F.lit(0)).alias("or_zero"),
        F.least(F.col("k"), F.lit(3)).alias("at_most_3"),
        F.size(F.array_distinct(words)).alias("set_size"),
        F.aggregate(F.map_values(amounts), F.lit(0).cast("bigint"), lambda a, b: a + b).alias(
            "map_total"
        ),
    )


# Joins


@query
def join_window_inner(spark, sf_dir):
    left, right = _purchases_and_clicks(spark, sf_dir)
    joined = _daily_join(left, right, "inner")
    return joined.select("left_id", "user_id", "cents", "click_k")


@query
def join_window_left_outer(spark, sf_dir):
    left, right = _purchases_and_clicks(spark, sf_dir)
    joined = _daily_join(left, right, "left")
    return joined.select("left_id", "left_ms", "user_id", "cents", "right_ms", "click_k")


def _purchases_and_clicks(spark, sf_dir):
    left = events_of(spark, sf_dir, "purchase").select(
        F.col("event_id").alias("left_id"), F.col("ts_ms").alias("left_ms"), "user_id", "cents"
    )
    right = events_of(spark, sf_dir, "click").select(
        F.col("event_id").alias("right_id"),
        F.col("ts_ms").alias("right_ms"),
        "user_id",
        F.col("k").alias("click_k"),
    )
    return left, right


def _daily_join(left, right, how):
    return joins.window_join(
        left, right, ["user_id"], "1 day", "left_ms", "right_ms", how, "left_id", "right_id"
    )


@query
def join_versioned_lookup(spark, sf_dir):
    rows = events(spark, sf_dir)
    facts = rows.where(F.col("event_type") == "purchase").select("event_id", "user_id", "cents")
    changes = rows.where(F.col("event_type").isin("view", "signup")).select(
        "event_id",
        "user_id",
        F.col("k").cast("string").alias("name"),
        F.when(F.col("event_type") == "signup", "delete").otherwise("insert").alias("op"),
    )
    return joins.versioned_lookup(facts, changes, "user_id", "event_id")


@query
def broadcast_lookup(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").withColumn("r_regionkey", F.col("n_regionkey"))
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("n_nationkey")
    )
    located = joins.lookup_join(nations, regions, ["r_regionkey"])
    return joins.lookup_join(customers, located, ["n_nationkey"]).select(
        "c_custkey", "n_name", "r_name"
    )


# Running aggregates


def _amounts(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "user_id", "event_type", "cents")


@query
def running_sum(spark, sf_dir):
    rows = _amounts(spark, sf_dir).drop("event_type")
    return running.running_sum(rows, ["user_id"], "event_id", "cents").drop("cents")


@query
def running_reduce(spark, sf_dir):
    """A reducer that Spark has no running form of: bits seen in any value so far."""
    rows = _amounts(spark, sf_dir).drop("user_id")
    folded = running.running_fold(
        rows, ["event_type"], "event_id", "cents", operator.or_, "reduced"
    )
    return folded.drop("cents")


@query
def running_sum_concat_key(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "k", "cents")
    return running.running_sum_concat_key(rows, ["user_id", "k"], "event_id", "cents")


@query
def ad_pv_uv_running(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "event_id", F.col("k").alias("ad"), "event_type", "user_id"
    )
    return running.running_views_and_users(
        rows, ["ad", "event_type"], "user_id", "event_id"
    ).select("event_id", "ad", "event_type", "pv", "uv")


@query
def ad_pv_uv_total(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("k").alias("ad"), "event_type", "user_id")
    return running.total_views_and_users(rows, ["ad", "event_type"], "user_id")


@query
def income_province_city(spark, sf_dir):
    rows = _amounts(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("province"),
        F.col("user_id").alias("city"),
        "cents",
    )
    return running.running_two_level(rows, "province", "city", "event_id", "cents").drop("cents")


@query
def table_group_sum(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("user_id").alias("id"), "cents")
    return running.group_sum(rows, ["id"], "cents", "cnt")


@query
def sql_group_sum(spark, sf_dir):
    stu = events(spark, sf_dir).select(
        F.col("event_type").alias("id"), F.col("cents").alias("cnt")
    )
    return windows.sql_windows(
        spark, "SELECT id, sum(cnt) AS cnt FROM {stu} GROUP BY id", stu=stu
    )


@query
def retract_changelog(spark, sf_dir):
    rows = _amounts(spark, sf_dir)
    return running.retract_changelog(rows, ["user_id"], "event_id", "cents")


@query
def upsert_latest(spark, sf_dir):
    rows = _amounts(spark, sf_dir).drop("event_type")
    return running.final_totals(rows, ["user_id"], "event_id", "cents")


# Windows


def _timed(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "event_type", "ts_ms", "cents")


@query
def tumble_sum(spark, sf_dir):
    return windows.tumble_sum(_timed(spark, sf_dir), ["event_type"], "ts_ms", "cents", "1 hour")


@query
def tumble_sum_by_time(spark, sf_dir):
    return windows.tumble_sum(_timed(spark, sf_dir), ["ts_ms"], "ts_ms", "cents", "1 hour")


@query
def session_sum(spark, sf_dir):
    return windows.session_sum(
        _timed(spark, sf_dir), ["event_type"], "ts_ms", "cents", "10 minutes"
    )


@query
def slide_sum(spark, sf_dir):
    return windows.slide_sum(
        _timed(spark, sf_dir), ["event_type"], "ts_ms", "cents", "2 hours", "1 hour"
    )


def _orders(spark, sf_dir):
    return events(spark, sf_dir).select(
        times.as_timestamp(F.col("ts_ms")).alias("etime"),
        F.col("event_type").alias("uid"),
        F.col("cents").alias("money"),
    )


@query
def sql_hop_sum(spark, sf_dir):
    return windows.sql_windows(
        spark,
        "SELECT unix_millis(window.start) AS window_start, uid, sum(money) AS total_money "
        f"FROM {{orders}} GROUP BY {windows.hop_columns('5 hours', '1 hour')}, uid",
        orders=_orders(spark, sf_dir),
    )


@query
def sql_tumble_sum(spark, sf_dir):
    return windows.sql_windows(
        spark,
        "SELECT unix_millis(window.start) AS window_start, uid, sum(money) AS total_money "
        "FROM {orders} GROUP BY window(etime, '1 hour'), uid",
        orders=_orders(spark, sf_dir),
    )


@query
def proc_tumble_reduce(spark, sf_dir):
    arrived = _timed(spark, sf_dir).withColumnRenamed("ts_ms", "arrived_ms")
    return windows.tumble_sum(
        arrived, ["event_type"], "arrived_ms", "cents", "1 hour", out="reduced"
    )


@query
def window_top3(spark, sf_dir):
    top = windows.window_top_n(
        _timed(spark, sf_dir), ["event_type"], "ts_ms", "cents", "event_id", "1 hour", 3
    )
    return top.select("window_start", "event_type", "event_id", "cents", "rank")


@query
def window_reduce_fn(spark, sf_dir):
    rows = _timed(spark, sf_dir)
    return custom.window_reduce(rows, ["event_type"], "ts_ms", "cents", "1 hour", operator.or_)


@query
def window_reduce_carry_fn(spark, sf_dir):
    """Of each hour and type: bits seen in any value, and of these the ones seen in an
    odd number of hours so far."""

    def emit(key, reduced, state):
        yield key[0], key[2], reduced, state, state.bit_count()

    schema = "window_start bigint, event_type string, reduced bigint, odd bigint, n_odd bigint"
    return custom.window_reduce_process(
        _timed(spark, sf_dir), ["event_type"], "ts_ms", "cents", "1 hour", operator.or_, operator.xor, emit, schema
    )


@query
def window_apply_fn(spark, sf_dir):
    """Of each hour and type: records, and the change from its first to its last value."""

    def change(key, batches):
        n, head, tail = 0, None, None
        for batch in batches:
            cents = batch.column("cents")
            head = cents[0].as_py() if head is None else head
            n, tail = n + len(cents), cents[-1].as_py()
        yield key[0], key[2], n, tail - head

    schema = "window_start bigint, event_type string, n bigint, change bigint"
    return custom.window_apply(
        _timed(spark, sf_dir), ["event_type"], "ts_ms", "1 hour", change, schema, ["event_id"]
    )


@query
def cogroup_fn(spark, sf_dir):
    """Per user and day: purchases, clicks, and purchases after the first click."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts_ms")
    buys, clicks = (
        rows.where(F.col("event_type") == kind).drop("event_type") for kind in ("purchase", "click")
    )

    def after(key, clicked, bought):
        n, first = 0, None
        for batch in clicked:
            first = batch.column("event_id")[0].as_py() if first is None else first
            n += batch.num_rows
        later, m = 0, 0
        for batch in bought:
            m += batch.num_rows
            if first is not None:
                later += sum(i > first for i in batch.column("event_id").to_pylist())
        yield key[0], key[2], m, n, later

    schema = "window_start bigint, user_id bigint, buys bigint, clicks bigint, later bigint"
    return custom.window_cogroup(
        clicks, buys, ["user_id"], "1 day", "ts_ms", "ts_ms", after, schema, ["event_id"]
    )


@query
def route_by_rules(spark, sf_dir):
    rules = {"large": F.col("cents") > 5000, "even": F.col("cents") % 2 == 0}
    rows = events(spark, sf_dir).select("event_id", "cents")
    return custom.route_by_rules(rows, rules, "rest")


@query
def flat_map_fn(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")

    def long_words(text):
        return [w for w in (text or "").split(" ") if len(w) >= 12]

    return custom.flat_map(rows, "text", long_words, "word", "string").drop("text")


@query
def window_all_sum(spark, sf_dir):
    return windows.window_all_sum(_timed(spark, sf_dir), "ts_ms", "cents", "1 hour")


@query
def count_window_sum(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "cents")
    return windows.count_window_sum(rows, "event_id", "cents", 7)


@query
def count_window_keyed(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "cents")
    return windows.count_window_sum(rows, "event_id", "cents", 5, keys=["user_id"])


@query
def window_cumulative(spark, sf_dir):
    return windows.window_cumulative(
        _timed(spark, sf_dir), ["event_type"], "ts_ms", "cents", "1 hour"
    )


def _flagged(spark, sf_dir):
    rows = shuffled_arrival(_timed(spark, sf_dir))
    return lateness.flag_late(rows, ["arrival", "event_id"], "ts_ms", "1 hour")


@query
def late_side_output(spark, sf_dir):
    return lateness.late_rows(_flagged(spark, sf_dir))


@query
def late_window_sum(spark, sf_dir):
    return lateness.normal_window_sum(_flagged(spark, sf_dir), ["event_type"], "ts_ms", "cents")


# Keyed state


@query
def value_state_total(spark, sf_dir):
    rows = _amounts(spark, sf_dir).drop("user_id")
    return keyed_state.value_total(rows, ["event_type"], "event_id", "cents").drop("cents")


@query
def value_state_ttl(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts_ms", "cents")
    return keyed_state.value_total_ttl(
        rows, ["user_id"], "ts_ms", "event_id", "cents", "6 hours"
    ).drop("cents", "ts_ms")


@query
def list_state_ttl(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts_ms", "event_type")
    return keyed_state.list_ttl(
        rows, ["user_id"], "ts_ms", "event_id", "event_type", "12 hours"
    ).drop("ts_ms")


@query
def minute_bucket_sum(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts_ms", "cents")
    return keyed_state.minute_bucket_total(
        rows, ["user_id"], "ts_ms", "event_id", "cents"
    ).drop("ts_ms", "cents")


@query
def timer_flush_processing(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts_ms", "cents")
    return keyed_state.flush_at_boundary(rows, "ts_ms", "1 hour")


@query
def timer_flush_event(spark, sf_dir):
    rows = shuffled_arrival(
        events(spark, sf_dir).select("event_id", "user_id", "ts_ms", "cents")
    )
    return keyed_state.flush_at_watermark_boundary(
        rows, ["arrival", "event_id"], "ts_ms", "1 hour"
    )


# Iteration and placement


@query
def iterate_feedback(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", F.col("k").cast("bigint").alias("v"))
    return iterate.iterate_until(rows, lambda p: {"v": p["v"] - 3}, lambda p: p["v"] > 0)


def _placed(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "event_type")


def _places(spark):
    """As many as the session has shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query
def partition_by_key(spark, sf_dir):
    """Rows per key, and the number of places they lie in: one."""
    placed = placement.by_key(_placed(spark, sf_dir), _places(spark), "event_type")
    return (
        records.with_instance(placed)
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("instance").alias("places"))
    )


def _spread(spark, placed):
    """Rows in all, whether every place has some, and whether none has twice the mean
    and 20 more."""
    sizes = records.with_instance(placed).groupBy("instance").agg(F.count(F.lit(1)).alias("n"))
    places = _places(spark)
    fair = F.max("n") <= 2 * F.sum("n") / places + 20
    return sizes.agg(
        F.sum("n").alias("n"),
        (F.count(F.lit(1)) == F.least(F.lit(places), F.sum("n"))).alias("all_places"),
        fair.alias("even"),
    )


@query
def rebalance(spark, sf_dir):
    return _spread(spark, placement.rebalance(_placed(spark, sf_dir), _places(spark)))


@query
def shuffle_random(spark, sf_dir):
    return _spread(spark, placement.shuffle_random(_placed(spark, sf_dir), _places(spark)))


@query
def partition_custom(spark, sf_dir):
    """Every place of the rule has its share of the session's partitions."""
    letters = records.map_columns(
        _placed(spark, sf_dir), word=F.translate("event_type", "cv", "ab")
    )
    spread = max(1, _places(spark) // (LETTER_PLACES - 1))
    rule = placement.first_letter_rule(F.col("word"))
    placed = records.with_instance(placement.by_rule(letters, LETTER_PLACES, rule, spread))
    return placed.withColumn("instance", F.floor(F.col("instance") / spread).cast("int"))
