"""Time and count windows. Sizes are given in text (``'10 seconds'``) or
milliseconds; the event-time column ``ts`` holds epoch milliseconds.

Windows are plain integer arithmetic on that column, so the sums combine
map-side, and a hot key or a hot window costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weir.functions.times import duration_ms, window_start_ms
from weir.operators import scan
from weir.operators.scan import KeyedScan

START, END = "window_start", "window_end"


def with_tumbling_window(rows: DataFrame, ts: str, size: str | int) -> DataFrame:
    width = duration_ms(size)
    start = window_start_ms(F.col(ts), width)
    return rows.withColumns({START: start, END: start + F.lit(width)})


def with_sliding_window(rows: DataFrame, ts: str, size: str | int, slide: str | int) -> DataFrame:
    """One row per window holding the record."""
    width, step = duration_ms(size), duration_ms(slide)
    last = window_start_ms(F.col(ts), step)
    reach = (width - 1) // step
    oldest = last - F.lit(reach * step)
    starts = F.filter(
        F.sequence(oldest, last, F.lit(step)), lambda s: s + F.lit(width) > F.col(ts)
    )
    return rows.withColumn(START, F.explode(starts)).withColumn(
        END, F.col(START) + F.lit(width)
    )


def tumble_sum(
    rows: DataFrame, keys: list[str], ts: str, value: str, size: str | int, out: str = "total"
) -> DataFrame:
    return (
        with_tumbling_window(rows, ts, size)
        .groupBy(START, END, *keys)
        .agg(F.sum(value).alias(out))
    )


def window_all_sum(
    rows: DataFrame, ts: str, value: str, size: str | int, out: str = "total"
) -> DataFrame:
    """Tumbling sum over all keys together."""
    return tumble_sum(rows, [], ts, value, size, out)


def slide_sum(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    size: str | int,
    slide: str | int,
    out: str = "total",
) -> DataFrame:
    """Sliding sum. When the slide divides the size, records are first summed into
    panes of one slide each, and only the panes are copied into their windows."""
    width, step = duration_ms(size), duration_ms(slide)
    if width % step == 0:
        pane = window_start_ms(F.col(ts), step).alias("_pane")
        rows = rows.groupBy(pane, *keys).agg(F.sum(value).alias(value))
        ts = "_pane"
    return (
        with_sliding_window(rows, ts, width, step)
        .groupBy(START, END, *keys)
        .agg(F.sum(value).alias(out))
    )


def session_sum(
    rows: DataFrame, keys: list[str], ts: str, value: str, gap: str | int, out: str = "total"
) -> DataFrame:
    """Sum per session; a pause longer than ``gap`` starts a new one, and a pause
    of exactly ``gap`` does not. ``window_end`` is the last record plus the gap.

    Records in one gap-wide slot always share a session, so they are combined first
    (map-side too). ``BLOCK`` slots in a row make a block, and each block is cut into
    sessions on its own. Those in the middle of a block are closed; only its first and
    its last may go on in a neighbour. So a key's blocks are joined by two rows each.
    """
    width = duration_ms(gap)
    slots = rows.groupBy(*keys, F.floor(F.col(ts) / F.lit(width)).alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.sum(value).alias("_sum")
    )
    block = [*keys, "_block"]
    blocks = slots.withColumn("_block", F.floor(F.col("_slot") / F.lit(BLOCK)))
    parts = _sessions(blocks, block, ["_slot"], width)
    every = Window.partitionBy(*block)
    marked = parts.withColumn("_most", F.max("_session").over(every))
    open_ended = (F.col("_session") == 0) | (F.col("_session") == F.col("_most"))
    ends = marked.where(open_ended).drop("_session", "_most")
    joined = _sessions(ends, keys, ["_block", "_first"], width)
    closed = marked.where(~open_ended)
    names = [*keys, "_first", "_last", "_sum"]
    return joined.select(*names).unionByName(closed.select(*names)).select(
        *keys, F.col("_first").alias(START), (F.col("_last") + F.lit(width)).alias(END), F.col("_sum").alias(out)
    )


#: Slots or windows in a row that one task orders.
BLOCK = 4096


def _sessions(parts: DataFrame, group: list[str], order: list[str], width: int) -> DataFrame:
    """(group, _session, _first, _last, _sum): parts of a group joined where the pause
    is at most ``width``, numbered from 0."""
    ordered = Window.partitionBy(*group).orderBy(*order)
    pause = F.col("_first") - F.lag("_last").over(ordered)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("_starts", F.when(pause > width, 1).otherwise(0)).withColumn(
        "_session", F.sum("_starts").over(so_far)
    )
    return numbered.groupBy(*group, "_session").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_sum").alias("_sum")
    )


def window_top_n(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    seq: str,
    size: str | int,
    n: int = 3,
) -> DataFrame:
    """The ``n`` largest values per key and window, earlier arrivals first among
    equals. Each task keeps only its own best ``n`` per group before the shuffle,
    so a hot group costs ``n`` rows per task."""
    windowed = with_tumbling_window(rows, ts, size)
    best = Window.partitionBy(START, *keys).orderBy(F.desc(value), seq)
    return windowed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def window_cumulative(
    rows: DataFrame, keys: list[str], ts: str, value: str, size: str | int, out: str = "total"
) -> DataFrame:
    """Per window and key: the key's total over this and all earlier windows. The
    running part sees one row per key and window, ``BLOCK`` windows of a key at a time."""
    sums = tumble_sum(rows, keys, ts, value, size, "_sum")
    scanned = KeyedScan(sums, keys, [START], chunk=window_block(size)).add(
        **{out: scan.running_sum(F.col("_sum"))}
    )
    return scanned.result().select(START, END, *keys, out)


def window_block(size: str | int) -> Column:
    """Ranges of windows in a row, as chunks of a scan along them."""
    return F.floor(F.col(START) / F.lit(duration_ms(size) * BLOCK))


def count_window_sum(
    rows: DataFrame,
    seq: str,
    value: str,
    size: int = 5,
    out: str = "total",
    chunks: int | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Sum of every ``size`` consecutive records in arrival order, of each key or over
    the whole input; an incomplete last window is not emitted."""
    keys = keys or []
    indexed = KeyedScan(rows, keys, [seq], chunks=chunks).add(_nth=scan.running_count()).result()
    counted = numbered_sums(indexed, keys, F.col("_nth") - 1, value, size, out)
    return counted.where(F.col("n") == size).drop("n")


def numbered_sums(
    rows: DataFrame, keys: list[str], place: Column, value: str, size: int, out: str
) -> DataFrame:
    """(keys, window_index, out, n) of count windows, given each record's place from 0."""
    return rows.groupBy(*keys, F.floor(place / F.lit(size)).alias("window_index")).agg(
        F.sum(value).alias(out), F.count(F.lit(1)).alias("n")
    )


def sql_windows(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text against frames, e.g. ``window(etime, '10 seconds')`` groups.

    Tables appear in the text as ``{name}``. Spark's ``window`` takes the size
    first and the slide second.
    """
    return spark.sql(query, **tables)


def hop_columns(size: str, slide: str) -> str:
    """SQL group expression for a hopping window over ``etime``."""
    return f"window(etime, '{size}', '{slide}')"


def bounds_ms(window: Column) -> tuple[Column, Column]:
    """Epoch-millisecond bounds of a Spark window struct."""
    return (
        F.unix_millis(window["start"].cast("timestamp")),
        F.unix_millis(window["end"].cast("timestamp")),
    )
