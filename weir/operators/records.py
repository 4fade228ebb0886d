"""Per-record operators: parse, project, filter, route, combine. None shuffles;
all of them take batch and streaming frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions import text as tx


def parse_delimited(
    lines: DataFrame,
    schema: T.StructType,
    separator: str = ",",
    column: str = "value",
    on_error: str = "fail",
) -> DataFrame:
    """Split ``column`` and cast field by field to ``schema``; other columns stay.

    Surplus fields are ignored. A missing or malformed field fails the job, or
    becomes NULL with ``on_error='null'``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    parts = lines.withColumn("_parts", tx.split_fields(F.col(column), separator))
    fields = []
    for position, field in enumerate(schema.fields):
        raw = F.get(F.col("_parts"), position)
        value = _typed(raw, field.dataType)
        if on_error == "fail":
            value = tx.require(value, raw, field.name)
        fields.append(value.alias(field.name))
    kept = [c for c in lines.columns if c != column and c not in schema.fieldNames()]
    return parts.select(*kept, *fields)


def _typed(raw: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return raw
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        return tx.parse_integer(raw, data_type.simpleString())
    if isinstance(data_type, T.DoubleType):
        return tx.parse_double(raw)
    raise TypeError(f"no text form for {data_type.simpleString()}")


def map_upper(rows: DataFrame, column: str = "value", out: str | None = None) -> DataFrame:
    return rows.withColumn(out or column, F.upper(column))


def flat_map_words(
    rows: DataFrame, column: str = "value", separator: str = " ", out: str = "word"
) -> DataFrame:
    """One row per word of every line; the text column is dropped."""
    kept = [c for c in rows.columns if c != column]
    lines = rows.select(*kept, F.explode(tx.lines_of(F.col(column))).alias("_line"))
    return lines.select(*kept, F.explode(tx.split_fields(F.col("_line"), separator)).alias(out))


def word_count(words: DataFrame, word: str = "word", exclude: str | None = None) -> DataFrame:
    """Final count per word, optionally leaving one word out."""
    kept = words if exclude is None else words.where(F.col(word) != exclude)
    return kept.groupBy(word).agg(F.count(F.lit(1)).alias("cnt"))


def not_equal(column: str, value: str) -> Column:
    return F.col(column) != value


def not_prefixed(column: str, prefix: str) -> Column:
    return ~F.col(column).startswith(prefix)


def positive(column: str) -> Column:
    return F.col(column) > 0


def not_positive(column: str) -> Column:
    return F.col(column) <= 0


def filter_each(rows: DataFrame, predicates: dict[str, Column], out: str = "predicate") -> DataFrame:
    """The outputs of several filters in one frame: each record once per predicate
    it meets, from a single pass over the input."""
    names = F.array_compact(F.array(*[F.when(p, name) for name, p in predicates.items()]))
    return rows.select("*", F.explode(names).alias(out))


def validate_fail_fast(
    rows: DataFrame, column: str = "value", prefix: str = "error"
) -> DataFrame:
    """Pass records on unchanged; fail the job when one starts with ``prefix``."""
    return rows.withColumn(column, tx.fail_if_prefixed(F.col(column), prefix))


def json_skip_bad(
    rows: DataFrame,
    schema: T.StructType,
    column: str = "value",
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Parse a JSON object per record and drop records that do not fit ``schema``.

    ``defaults`` fills fields that are absent, for targets without NULL.
    """
    bad = "_malformed"
    with_bad = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = rows.withColumn(
        "_json",
        F.from_json(F.col(column), with_bad, {"columnNameOfCorruptRecord": bad}),
    ).where(F.col("_json").isNotNull() & F.col(f"_json.{bad}").isNull())
    defaults = defaults or {}
    fields = []
    for name in schema.fieldNames():
        field = F.col(f"_json.{name}")
        fields.append(
            F.coalesce(field, F.lit(defaults[name])).alias(name)
            if name in defaults
            else field.alias(name)
        )
    kept = [c for c in rows.columns if c != column and c not in schema.fieldNames()]
    return parsed.select(*kept, *fields)


ROUTES = ("even", "odd", "text")


def with_route(rows: DataFrame, column: str = "value") -> DataFrame:
    """Add ``number`` (NULL for text) and ``route``: even, odd or text."""
    number = tx.parse_integer(F.col(column))
    return rows.withColumn("number", number).withColumn(
        "route",
        F.when(F.col("number").isNull(), "text")
        .when(F.col("number") % 2 == 0, "even")
        .otherwise("odd"),
    )


def side_outputs(rows: DataFrame, column: str = "value") -> dict[str, DataFrame]:
    """Output name → frame. ``main`` holds every record, each other output the
    records routed to it."""
    routed = with_route(rows, column)
    outputs = {name: routed.where(F.col("route") == name) for name in ROUTES}
    outputs["main"] = rows
    return outputs


def tagged_outputs(rows: DataFrame, column: str = "value") -> DataFrame:
    """All outputs in one frame: each record once as ``main`` and once under its
    route, from a single pass over the input."""
    routed = with_route(rows, column)
    tags = F.array(F.lit("main"), F.col("route"))
    return routed.select(*rows.columns, F.explode(tags).alias("output"))


def co_map(
    first: DataFrame,
    second: DataFrame,
    map_first: dict[str, Column],
    map_second: dict[str, Column],
) -> DataFrame:
    """Map two inputs of different layouts to one output layout and merge them."""
    return first.select(*[c.alias(n) for n, c in map_first.items()]).unionByName(
        second.select(*[c.alias(n) for n, c in map_second.items()])
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Merge frames of one layout, keeping duplicates."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def map_columns(rows: DataFrame, **columns: Column) -> DataFrame:
    """User-defined one-in/one-out operator made of column expressions."""
    return rows.withColumns(columns)


def map_batches(
    rows: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str
) -> DataFrame:
    """User-defined one-in/one-out operator in Python, over Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(fn, batches)

    return rows.mapInArrow(run, schema)


def with_instance(rows: DataFrame, out: str = "instance") -> DataFrame:
    """Tag each record with the index of the partition processing it."""
    return rows.withColumn(out, F.spark_partition_id())
