"""Hand-computed cases for the per-record operators, plus batch on streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows_of
from weir.functions import text as tx
from weir.functions import times
from weir.operators import custom, iterate, joins, placement, records

KEY_INT = T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.IntegerType())])


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


@pytest.mark.parametrize(
    "text,expected",
    [
        ("a,,b,,", ["a", "", "b"]),
        ("", [""]),
        (",", []),
        (",a", ["", "a"]),
        ("a", ["a"]),
        (" , ", [" ", " "]),
    ],
)
def test_split_fields(spark, text, expected):
    got = lines(spark, text).select(tx.split_fields(F.col("value"), ",").alias("f")).first().f
    assert got == expected


@pytest.mark.parametrize("separator", list("|.^$\\*+- ]["))
def test_split_takes_any_character_literally(spark, separator):
    row = lines(spark, f"a{separator}b").select(tx.split_fields(F.col("value"), separator)).first()
    assert row[0] == ["a", "b"]


def test_words_of_whole_text(spark):
    frame = records.flat_map_words(lines(spark, "a b \n\n c"), "value")
    assert [r.word for r in frame.collect()] == ["a", "b", "", "", "c"]


@pytest.mark.parametrize(
    "text,expected",
    [(" 12 ", None), ("+5", 5), ("12.7", None), ("99999999999", None), ("-3", -3), ("", None)],
)
def test_strict_integers(spark, text, expected):
    assert lines(spark, text).select(tx.parse_integer(F.col("value"))).first()[0] == expected


@pytest.mark.parametrize(
    "text,expected", [(" 1.5 ", 1.5), ("12d", 12.0), ("1e3", 1000.0), ("inf", None), ("x", None), (".5", 0.5)]
)
def test_doubles(spark, text, expected):
    assert lines(spark, text).select(tx.parse_double(F.col("value"))).first()[0] == expected


def test_parse_delimited(spark):
    good = lines(spark, "spark,3,extra", "hive,-1")
    assert rows_of(records.parse_delimited(good, KEY_INT)) == [("hive", -1), ("spark", 3)]
    for bad in ("spark", "spark,x", "spark, 3"):
        with pytest.raises(Exception, match="cannot parse n"):
            records.parse_delimited(lines(spark, bad), KEY_INT).collect()
        nulls = records.parse_delimited(lines(spark, bad), KEY_INT, on_error="null")
        assert rows_of(nulls) == [("spark", None)]


def test_parse_all_types(spark):
    schema = T.StructType(
        [
            T.StructField("ts", T.LongType()),
            T.StructField("uid", T.StringType()),
            T.StructField("money", T.DoubleType()),
        ]
    )
    frame = records.parse_delimited(lines(spark, "1000,u1,5.5"), schema)
    assert rows_of(frame) == [(1000, "u1", 5.5)]
    assert frame.schema.simpleString() == "struct<ts:bigint,uid:string,money:double>"


def test_fail_fast(spark):
    assert records.validate_fail_fast(lines(spark, "ok", "an error")).count() == 2
    with pytest.raises(Exception, match="bad record: error 1"):
        records.validate_fail_fast(lines(spark, "ok", "error 1")).collect()


def test_json(spark):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])
    rows = lines(
        spark, '{"name":"x","age":3}', '{"name":"y"}', "bad", "", "null", '{"name":"z","age":"7"}', '{"age":1.5}'
    )
    assert rows_of(records.json_skip_bad(rows, schema, defaults={"age": 0})) == [("x", 3), ("y", 0)]


def test_side_outputs(spark):
    rows = lines(spark, "7", "8", "abc", "-3", "-4", "1.0")
    outputs = records.side_outputs(rows)
    assert {n: sorted(r.value for r in f.collect()) for n, f in outputs.items()} == {
        "even": ["-4", "8"],
        "odd": ["-3", "7"],
        "text": ["1.0", "abc"],
        "main": sorted(["7", "8", "abc", "-3", "-4", "1.0"]),
    }
    tagged = records.tagged_outputs(rows)
    assert tagged.count() == 12
    assert tagged.where("output = 'main'").count() == 6


def test_map_batches_keeps_rows(spark):
    frame = spark.range(100).select("id")
    assert records.map_batches(frame, lambda b: b, "id BIGINT").count() == 100


def test_iterate(spark):
    rows = spark.createDataFrame([(10,), (3,), (0,), (-1,), (100,), (300_000,), (None,)], "v BIGINT")
    out = iterate.iterate_until(rows, lambda p: {"v": p["v"] - 3}, lambda p: p["v"] > 0)
    assert rows_of(out) == sorted([(-2,), (0,), (-3,), (-4,), (-2,), (0,), (None,)], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_custom_partitions(spark):
    rows = lines(spark, "apple", "bee", "cat")
    placed = placement.by_rule(rows, 4, placement.first_letter_rule(F.col("value")))
    assert rows_of(records.with_instance(placed)) == [("apple", 1), ("bee", 2), ("cat", 3)]
    many = spark.range(900).select(F.concat(F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")), "id").alias("value"))
    spread = placement.by_rule(many, 4, placement.first_letter_rule(F.col("value")), spread=5)
    places = records.with_instance(spread).groupBy(F.substring("value", 1, 1), "instance").count().collect()
    assert len(places) == 15 and all(r["instance"] // 5 == "?abc".index(r[0]) for r in places)


def test_placement(spark):
    rows = spark.range(1000).withColumn("key", F.lit("hot"))

    def sizes(frame):
        return [r[1] for r in records.with_instance(frame).groupBy("instance").count().collect()]

    assert sizes(placement.by_key(rows, 4, "key")) == [1000]
    assert len(sizes(placement.by_key(rows, 4, "key", spread=16))) == 4
    assert all(abs(n - 250) <= 2 for n in sizes(placement.rebalance(rows, 4)))
    assert len(sizes(placement.shuffle_random(rows, 4))) == 4


def test_broadcast_only_when_small(spark, monkeypatch):
    small = spark.range(10).withColumnRenamed("id", "k")
    facts = spark.range(100).selectExpr("id % 10 AS k", "id AS f")
    assert _is_broadcast(joins.lookup_join(facts, small, ["k"]))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.lookup_join(facts, small, ["k"])
        assert not _is_broadcast(large)
        assert large.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _is_broadcast(frame) -> bool:
    return "BroadcastHashJoin" in frame._jdf.queryExecution().executedPlan().toString()


def test_durations():
    assert times.duration_ms("10 seconds") == 10_000
    assert times.duration_ms("1 day") == 86_400_000
    assert times.duration_ms(5) == 5
    with pytest.raises(ValueError):
        times.duration_ms("soon")


def test_random_texts_against_plain_python(spark):
    """Splitting, word lists and number parsing on many random short texts."""
    import random
    import re

    random.seed(7)
    texts = ["".join(random.choices("ab1+-. ,\n", k=random.randrange(9))) for _ in range(2000)]

    def split(value, separator):
        if value == "":
            return [""]
        body = value.rstrip(separator)
        return body.split(separator) if body else []

    def integer(value):
        fits = re.fullmatch(r"[+-]?[0-9]+", value)
        return int(value) if fits and -(2**31) <= int(value) < 2**31 else None

    rows = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "id INT, value STRING")
    got = rows.select(
        "id",
        tx.split_fields(F.col("value"), ",").alias("fields"),
        tx.split_fields(F.col("value"), " ").alias("words"),
        tx.parse_integer(F.col("value")).alias("number"),
    ).orderBy("id").collect()
    for row, value in zip(got, texts):
        assert row.fields == split(value, ","), value
        assert row.words == split(value, " "), value
        assert row.number == integer(value), value
    counted = records.word_count(records.flat_map_words(rows.select("value")))
    expected = {}
    for value in texts:
        for line in value.split("\n"):
            for word in split(line, " "):
                expected[word] = expected.get(word, 0) + 1
    assert {r.word: r.cnt for r in counted.collect()} == expected


def test_route_by_rules(spark):
    rows = spark.createDataFrame([(1,), (4,), (9,), (None,)], "v int")
    rules = {"even": F.col("v") % 2 == 0, "big": F.col("v") > 3}
    got = custom.route_by_rules(rows, rules, "rest")
    assert rows_of(got) == sorted([(1, "rest"), (4, "even"), (4, "big"), (9, "big"), (None, "rest")], key=repr)
    assert rows_of(custom.route_by_rules(rows, rules)) == sorted([(4, "even"), (4, "big"), (9, "big")], key=repr)


def test_window_reduce_with_any_function(spark):
    rows = [(i * 10, "a" if i % 3 else None, i if i % 5 else None) for i in range(500)]
    frame = spark.createDataFrame(rows, "ts bigint, k string, v bigint").repartition(7)
    got = custom.window_reduce(frame, ["k"], "ts", "v", 1000, max)
    expected = frame.where("v IS NOT NULL").groupBy((F.floor(F.col("ts") / 1000) * 1000).alias("s"), "k").agg(F.max("v"))
    assert rows_of(got, "window_start", "k", "reduced") == rows_of(expected)


def test_flat_map_and_cogroup_edges(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, t string")
    got = custom.flat_map(rows, "t", lambda t: t.split() if t else None, "w", "string")
    assert rows_of(got, "id", "w") == [(1, "a"), (1, "b")]
    left = spark.createDataFrame([(0, "x"), (5, "y")], "ts bigint, k string")
    right = spark.createDataFrame([(1, "x"), (2, "x"), (3, "z")], "ts bigint, k string")

    def sizes(key, a, b):
        yield key[2], sum(x.num_rows for x in a), sum(x.num_rows for x in b)

    def frames(key, a, b):
        import pandas as pd

        return pd.DataFrame([(key[2], len(a), len(b))], columns=["k", "a", "b"])

    for fn in (sizes, custom.on_frames(frames)):
        both = custom.window_cogroup(left, right, ["k"], 10, "ts", "ts", fn, "k string, a int, b int")
        assert rows_of(both) == [("x", 1, 2), ("y", 1, 0), ("z", 0, 1)]
    none = custom.window_cogroup(left.limit(0), right.limit(0), ["k"], 10, "ts", "ts", sizes, "k string, a int, b int")
    assert none.count() == 0
