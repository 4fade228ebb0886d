"""Windowed joins of two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.streaming.windows import ETIME


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    size: str,
    how: str = "inner",
    *,
    left_id: str | None = None,
    spread: int = 1,
    hot: str | None = None,
) -> DataFrame:
    """Pair records of equal key and tumbling window. Both sides carry ``etime``
    with a watermark, which also clears the join state; in a left join an unmatched
    record appears once the watermark has passed its window.

    A (key, window) is one task's rows and state. With ``spread`` it is divided into so
    many cells: a left record lies in one, by its ``left_id``, and a right record is
    copied to all, so every pair meets once and left records without a partner still
    appear once. ``hot``, an SQL predicate on the keys, limits this to the keys that
    need it; give the smaller side as the right one."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if spread > 1 and left_id is None:
        raise ValueError("give left_id to divide keys")
    on = ["_window", *keys, "_cell"]
    cells = F.lit(spread) if hot is None else F.when(F.expr(hot), spread).otherwise(1)
    one = F.pmod(F.xxhash64(left_id), cells.cast("bigint")) if spread > 1 else F.lit(0).cast("bigint")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), cells.cast("bigint") - 1)) if spread > 1 else one
    joined = in_windows(left, size).withColumn("_cell", one).join(
        in_windows(right, size).withColumn("_cell", every), on, how
    )
    return joined.withColumn("window_start", F.unix_millis("_window.start")).drop("_window", "_cell")


def in_windows(rows: DataFrame, size: str) -> DataFrame:
    return rows.withColumn("_window", F.window(ETIME, size)).drop(ETIME)
