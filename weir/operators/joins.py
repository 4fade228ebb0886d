"""Windowed joins, versioned lookup and small-table lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.operators import scan
from weir.operators.scan import KeyedScan
from weir.operators.windows import END, START, with_tumbling_window

BROADCAST_BYTES = 8 * 1024 * 1024
BROADCAST_ROWS = 100_000
PAIRS_PER_TASK = 50_000_000


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    size: str | int,
    left_ts: str,
    right_ts: str,
    how: str = "inner",
    left_id: str | None = None,
    right_id: str | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Pair records of equal key and equal tumbling window. ``how`` is ``inner``
    or ``left``; unmatched left records get NULLs, unmatched right ones vanish.

    The window is part of the join key, so a hot key spreads over its windows, and
    adaptive execution splits partitions that are large in bytes. A (key, window)
    may also be small in bytes and huge in pairs. With unique columns ``left_id``
    and ``right_id`` given, groups of more than ``pairs_per_task`` pairs are found by
    counting and become a grid: the left side is divided over its rows, the right one
    over its columns, and every pair meets in one cell. With equal sides a row is
    copied about as often as the root of the number of cells.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    on = [START, END, *keys]
    left = with_tumbling_window(left, left_ts, size)
    right = with_tumbling_window(right, right_ts, size)
    if left_id is None or right_id is None:
        return left.join(right, on, how)
    return divided_join(left, right, on, left_id, right_id, how, pairs_per_task)


def divided_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_id: str,
    right_id: str,
    how: str = "inner",
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Inner or left equality join that divides the groups with most pairs, see
    ``window_join``. Without such groups the dividing branch is dropped at run time."""
    grids = _grids(left, right, on, pairs_per_task)
    marked_left, marked_right = left.join(grids, on, "left"), right.join(grids, on, "left")
    if how == "inner":
        # one path: groups without a grid are a single cell
        both = _in_cells(marked_left, on, left.columns, left_id, True).join(
            _in_cells(marked_right, on, right.columns, right_id, False), [*on, "_row", "_column"]
        )
        return both.drop("_row", "_column")
    light = F.col("_rows").isNull()
    pairs = marked_left.where(light).select(left.columns).join(
        marked_right.where(light).select(right.columns), on, how
    )
    heavy_left = _in_cells(marked_left.where(~light), on, left.columns, left_id, True)
    heavy_right = _in_cells(marked_right.where(~light), on, right.columns, right_id, False)
    heavy_pairs = heavy_left.join(heavy_right, [*on, "_row", "_column"])
    return pairs.unionByName(heavy_pairs.drop("_row", "_column"))


def _grids(left: DataFrame, right: DataFrame, on: list[str], pairs_per_task: int) -> DataFrame:
    """(on, _rows, _columns) of the groups with more pairs than a task should hold. The
    sides share out the cells so that the rows copied in all are fewest."""
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_left")).join(
        right.groupBy(*on).agg(F.count(F.lit(1)).alias("_right")), on
    )
    pairs = F.col("_left").cast("double") * F.col("_right")
    cells = F.ceil(pairs / F.lit(pairs_per_task))
    shape = F.ceil(F.sqrt(cells * F.col("_left") / F.col("_right")))
    return (
        counts.where(pairs > pairs_per_task)
        .select(*on, cells.alias("_cells"), F.least(shape, cells).alias("_rows"))
        .select(*on, "_rows", F.ceil(F.col("_cells") / F.col("_rows")).alias("_columns"))
    )


def _in_cells(
    rows: DataFrame, on: list[str], columns: list[str], row_id: str, is_left: bool
) -> DataFrame:
    """A left row has a row of the grid by its id and goes to all columns, a right row
    the other way round."""
    own, across = ("_rows", "_columns") if is_left else ("_columns", "_rows")
    mine = F.pmod(F.xxhash64(row_id), F.coalesce(own, F.lit(1).cast("bigint")))
    every = F.sequence(F.lit(0).cast("bigint"), F.coalesce(across, F.lit(1).cast("bigint")) - 1)
    names = ("_row", "_column") if is_left else ("_column", "_row")
    celled = rows.select(*columns, mine.alias(names[0]), F.explode(every).alias(names[1]))
    # a fixed number of partitions: adaptive execution would merge cells that are
    # small in bytes, and with them their pairs, into one task
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return celled.repartition(tasks, *on, "_row", "_column")


def versioned_lookup(
    facts: DataFrame,
    changes: DataFrame,
    key: str,
    seq: str,
    name: str = "name",
    op: str = "op",
    **sizes,
) -> DataFrame:
    """Add to each fact the dimension name current at its place in the sequence.

    ``changes`` upserts ``name`` for a key, or deletes it when ``op`` is
    ``'delete'``. At equal sequence numbers a change applies before the fact.
    Facts seen before any change, or after a delete, get NULL.
    """
    current = F.struct(F.when(F.col(op) != "delete", F.col(name)).alias("name"))
    log = changes.select(key, seq, current.alias("_change"), F.lit(0).alias("_fact"))
    both = facts.withColumn("_fact", F.lit(1)).unionByName(log, allowMissingColumns=True)
    scanned = KeyedScan(both, [key], [seq, "_fact"], **sizes).add(
        _current=scan.last_known(F.col("_change"))
    ).result()
    return scanned.where(F.col("_fact") == 1).select(
        *facts.columns, F.col("_current.name").alias(name)
    )


def lookup_join(
    facts: DataFrame, dimension: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join with a static dimension, copied to every task only when it is small.

    The size is checked on the dimension itself, reading at most
    ``BROADCAST_ROWS`` + 1 rows; a larger one is joined by shuffling, with the
    skew handling of adaptive execution.
    """
    return facts.join(broadcast_if_small(dimension), keys, how)


def broadcast_if_small(dimension: DataFrame) -> DataFrame:
    size = (
        dimension.limit(BROADCAST_ROWS + 1)
        .select(F.octet_length(F.to_json(F.struct("*"))).alias("_bytes"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("_bytes").alias("bytes"))
        .first()
    )
    small = size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(dimension) if small else dimension
