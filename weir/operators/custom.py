"""Operators that take the user's own function.

Functions run on Arrow batches. Where a function is associative, it is applied before
the shuffle, too. Functions of a whole window read it as a stream: the rows of a group
are in one task, one batch at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weir.operators import groups
from weir.operators.groups import Batches
from weir.operators.running import running_fold
from weir.operators.windows import END, START, window_block, with_tumbling_window

Frame = pd.DataFrame


def flat_map(
    rows: DataFrame, column: str, fn: Callable[[Any], list], out: str, item_type: str
) -> DataFrame:
    """Each record gives any number of rows: its columns and one item of ``fn`` of the
    column's value. No item (or NULL for a list) gives no row."""

    @F.pandas_udf(f"array<{item_type}>")
    def items(values: pd.Series) -> pd.Series:
        return values.map(fn)

    return rows.withColumn(out, F.explode(items(F.col(column))))


def route_by_rules(
    rows: DataFrame, rules: dict[str, Column], default: str | None = None, out: str = "tag"
) -> DataFrame:
    """Tagged outputs: a record goes to every tag whose predicate holds, as one row per
    tag, and to ``default`` (or nowhere) if none does. A NULL predicate does not hold."""
    tags = F.array_compact(F.array(*[F.when(rule, F.lit(tag)) for tag, rule in rules.items()]))
    if default is not None:
        tags = F.when(F.size(tags) == 0, F.array(F.lit(default))).otherwise(tags)
    return rows.withColumn(out, F.explode(tags))


def window_reduce(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    size: str | int,
    fn: Callable[[Any, Any], Any],
    out: str = "reduced",
) -> DataFrame:
    """Per key and tumbling window, the values folded by any associative and
    commutative function of two values. Each task folds its own rows first, so one row
    per group and task is shuffled; Python holds one value between rows. NULLs are
    skipped, and a group of NULLs has no result."""
    group = [START, END, *keys]
    timed = with_tumbling_window(rows, ts, size).where(F.col(value).isNotNull())
    timed = timed.select(*group, F.col(value).alias(out))
    partial = _fold_groups(timed, group, out, fn)
    return _fold_groups(partial.repartition(*group), group, out, fn)


def _fold_groups(rows: DataFrame, group: list[str], value: str, fn) -> DataFrame:
    """One row per run of equal groups in the sorted rows of each partition."""

    def fold(key: tuple, part: Batches) -> Iterator[tuple]:
        total = None
        for batch in part:
            for item in batch.column(value).to_pylist():
                total = item if total is None else fn(total, item)
        yield (*key, total)

    run = groups.apply_to_groups(fold, group, to_arrow_schema(rows.schema))
    return rows.sortWithinPartitions(*group).mapInArrow(run, rows.schema)


def window_reduce_process(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    size: str | int,
    fn: Callable[[Any, Any], Any],
    carry: Callable[[Any, Any], Any],
    emit: Callable[[tuple, Any, Any], Iterable[tuple]],
    schema: str,
) -> DataFrame:
    """Pre-aggregated window function with state of its key.

    ``fn`` folds the values of a key's tumbling window, as in ``window_reduce``. The
    state of a key goes from window to window: ``carry(state, reduced)``, any
    associative function, takes in the window's result, which is the state where there
    is none yet. ``emit(key, reduced, state)`` is then called for each window, with the
    key ``(window start, window end, *keys)`` and the state that holds this window,
    and gives any number of result rows.

    One row per key and window is ordered, in blocks of windows: the state that enters a
    block is folded from those before, so no task holds all windows of a key.
    """
    reduced = window_reduce(rows, keys, ts, value, size, fn, "_reduced")
    stated = running_fold(reduced, keys, START, "_reduced", carry, "_state", chunk=window_block(size))
    result = T.StructType.fromDDL(schema)
    arrow, by = to_arrow_schema(result), [START, END, *keys]

    def run(batches: Batches) -> Batches:
        def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
            names = [*by, "_reduced", "_state"]
            for *key, value, state in zip(*(batch.column(c).to_pylist() for c in names)):
                yield from emit(tuple(key), value, state) or ()

        yield from groups.collected((row for batch in batches for row in rows_of(batch)), arrow)

    return stated.mapInArrow(run, result)


def window_apply(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    size: str | int,
    fn: Callable[[tuple, Batches], Iterable[tuple]],
    schema: str,
    order: list[str] | None = None,
) -> DataFrame:
    """Full-window function: ``fn(key, batches)`` sees all rows of a key's tumbling
    window, sorted by ``order``, as a stream of Arrow batches, and gives any number of
    result rows. ``key`` is ``(window start, window end, *keys)``. The rows of a window
    of one key are in one task, which holds one batch of them; use ``window_reduce``
    where an associative function will do."""
    by, result = [START, END, *keys], T.StructType.fromDDL(schema)
    placed = _dealt(with_tumbling_window(rows, ts, size), by).sortWithinPartitions(*by, *(order or []))
    return placed.mapInArrow(groups.apply_to_groups(fn, by, to_arrow_schema(result)), result)


def window_cogroup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    size: str | int,
    left_ts: str,
    right_ts: str,
    fn: Callable[[tuple, Batches, Batches], Iterable[tuple]],
    schema: str,
    left_order: list[str] | None = None,
    right_order: list[str] | None = None,
) -> DataFrame:
    """Co-group function: ``fn(key, left, right)`` is called for every
    ``(window start, window end, *keys)`` that either side has; the other may be empty.

    Both sides go through one shuffle, tagged, and come as streams of Arrow batches in
    their orders. A task holds one batch where ``fn`` reads the left side to its end
    first; if it begins with the right side, the left rows are kept meanwhile."""
    by, result = [START, END, *keys], T.StructType.fromDDL(schema)

    def tagged(rows: DataFrame, ts: str, side: int) -> DataFrame:
        timed = with_tumbling_window(rows, ts, size)
        return timed.select(*by, F.lit(side).alias("_side"), F.struct("*").alias(f"_rows{side}"))

    both = tagged(left, left_ts, 0).unionByName(tagged(right, right_ts, 1), allowMissingColumns=True)
    orders = [f"_rows{i}.{c}" for i, names in enumerate((left_order, right_order)) for c in names or []]
    placed = _dealt(both, by).sortWithinPartitions(*by, "_side", *orders)
    arrow = to_arrow_schema(result)

    def run(batches: Batches) -> Batches:
        def results() -> Iterator[tuple]:
            for key, group in groups.each_group(batches, by, ["_side"]):
                sides = groups.Sides(group, "_side", ("_rows0", "_rows1"))
                yield from fn(key, sides.read(0), sides.read(1)) or ()

        yield from groups.collected(results(), arrow)

    return placed.mapInArrow(run, result)


def _dealt(rows: DataFrame, by: list[str]) -> DataFrame:
    """A fixed number of partitions: adaptive execution would merge those that are small
    in bytes, and with them the calls of a function, into one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def on_frames(fn: Callable[..., Frame]) -> Callable[..., Iterable[tuple]]:
    """A function of whole pandas frames, ``fn(key, frame)`` or ``fn(key, left, right)``,
    for ``window_apply`` and ``window_cogroup``. Each group must fit the task's memory;
    an empty side is an empty frame without columns."""

    def call(key: tuple, *sides: Batches) -> Iterable[tuple]:
        frames = []
        for side in sides:
            held = list(side)
            frames.append(pa.Table.from_batches(held).to_pandas() if held else pd.DataFrame())
        return fn(key, *frames).itertuples(index=False, name=None)

    return call
