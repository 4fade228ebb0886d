"""Late records against a watermark that moves with every record.

In arrival order the watermark before a record is the largest event time seen so
far minus the allowed disorder; the record is late when its window has already
ended by then. The running maximum needs a total order but not one task: see
``weir.operators.scan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.functions.times import duration_ms
from weir.operators import scan
from weir.operators.scan import KeyedScan
from weir.operators.windows import END, START, with_tumbling_window


def flag_late(
    rows: DataFrame,
    order: list[str],
    ts: str,
    size: str | int,
    delay: str | int = 0,
    seen_before: int | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Add the tumbling window bounds, ``late`` and ``place``, the 1-based place in
    arrival order. ``seen_before`` is the largest event time of earlier input, when
    the rows continue a stream."""
    windowed = with_tumbling_window(rows, ts, size)
    scanned = KeyedScan(windowed, [], order, chunks=chunks).add(
        _seen=scan.max_before(F.col(ts)), place=scan.running_count()
    ).result()
    seen = F.col("_seen")
    if seen_before is not None:
        seen = F.greatest(seen, F.lit(seen_before).cast("bigint"))
    late = F.col(END) <= seen - F.lit(duration_ms(delay))
    return scanned.withColumn("late", F.coalesce(late, F.lit(False))).drop("_seen")


def late_rows(flagged: DataFrame) -> DataFrame:
    """The side output: late records as they came, not aggregated."""
    return flagged.where("late").drop("late", "place", START, END)


def normal_window_sum(
    flagged: DataFrame, keys: list[str], ts: str, value: str, out: str = "total"
) -> DataFrame:
    """Window sums of the records in time. ``first_ts`` is the event time of the
    record that arrived first in the window."""
    return (
        flagged.where(~F.col("late"))
        .groupBy(START, END, *keys)
        .agg(
            F.min_by(ts, "place").alias("first_ts"),
            F.sum(value).alias(out),
        )
    )
