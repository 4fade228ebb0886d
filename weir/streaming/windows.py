"""Event-time and processing-time windows over unbounded input.

Every function takes epoch milliseconds (``ts``) and declares its own watermark;
results appear once the watermark passes a window's end (append mode). Spark adds
partial aggregation before the shuffle, so hot keys cost one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.times import as_timestamp
from weir.streaming.stateful import RunningTotal

ETIME = "etime"


def with_event_time(rows: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Bounded out-of-orderness: the watermark trails the largest event time by
    ``delay``. Leave this out for sources without event time."""
    return rows.withColumn(ETIME, as_timestamp(F.col(ts))).withWatermark(ETIME, delay)


def with_arrival_time(rows: DataFrame) -> DataFrame:
    """Processing time: stamp records with the clock of their micro-batch."""
    return rows.withColumn(ETIME, F.current_timestamp()).withWatermark(ETIME, "0 seconds")


def _sum_by(rows: DataFrame, window: Column, keys: list[str], value: str, out: str) -> DataFrame:
    return (
        rows.groupBy(window.alias("_window"), *keys)
        .agg(F.sum(value).alias(out))
        .select(
            F.unix_millis("_window.start").alias("window_start"),
            F.unix_millis("_window.end").alias("window_end"),
            *keys,
            out,
        )
    )


def tumble_sum(
    timed: DataFrame, keys: list[str], value: str, size: str, out: str = "total"
) -> DataFrame:
    return _sum_by(timed, F.window(ETIME, size), keys, value, out)


def slide_sum(
    timed: DataFrame, keys: list[str], value: str, size: str, slide: str, out: str = "total"
) -> DataFrame:
    return _sum_by(timed, F.window(ETIME, size, slide), keys, value, out)


def session_sum(
    timed: DataFrame, keys: list[str], value: str, gap: str, out: str = "total"
) -> DataFrame:
    return _sum_by(timed, F.session_window(ETIME, gap), keys, value, out)


def window_cumulative(
    timed: DataFrame, key: str, value: str, size: str, out: str = "total"
) -> DataFrame:
    """Per closed window and key, the key's total over all windows so far: a
    window aggregate feeding a keyed running total."""
    sums = (
        timed.groupBy(F.window(ETIME, size).alias("_window"), key)
        .agg(F.sum(value).alias("_sum"))
        .select(key, F.unix_millis("_window.start").alias("window_start"), "_sum")
    )
    total = RunningTotal(key, "window_start", "_sum")
    key_type = timed.schema[key].dataType
    return total.apply(
        sums,
        T.StructType(
            [
                T.StructField(key, key_type),
                T.StructField("window_start", T.LongType()),
                T.StructField(out, T.LongType()),
            ]
        ),
    )
