"""Running aggregates: one updated result per input row, in arrival order.

``seq`` names an integer arrival order. Keys of any size are fine, see
``weir.operators.scan``. Options in ``**sizes`` go to ``KeyedScan``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.operators import scan
from weir.operators.scan import KeyedScan

REDUCERS = {
    "sum": scan.running_sum,
    "min": scan.running_min,
    "max": scan.running_max,
}


def running_sum(
    rows: DataFrame, keys: list[str], seq: str, value: str, out: str = "total", **sizes
) -> DataFrame:
    return KeyedScan(rows, keys, [seq], **sizes).add(
        **{out: scan.running_sum(F.col(value))}
    ).result()


def running_reduce(
    rows: DataFrame,
    keys: list[str],
    seq: str,
    value: str,
    reducer: str = "sum",
    out: str = "reduced",
    **sizes,
) -> DataFrame:
    """Running fold with a built-in reducer; ``running_fold`` takes any function."""
    return KeyedScan(rows, keys, [seq], **sizes).add(
        **{out: REDUCERS[reducer](F.col(value))}
    ).result()


def running_fold(
    rows: DataFrame,
    keys: list[str],
    seq: str,
    value: str,
    fn: Callable[[Any, Any], Any],
    out: str = "folded",
    **sizes,
) -> DataFrame:
    """Running fold per key with any associative Python function of two values. NULLs
    are skipped: the result stays what it was, NULL before the first value.

    Python sees the sorted rows of a partition as a stream of Arrow batches and holds
    one value between rows. The chunks of heavy keys are folded on their own; the folds
    of a key's earlier chunks are then put before every value of a chunk.
    """
    scanned = KeyedScan(rows, keys, [seq], **sizes)
    group, kind = [scan.KEY, scan.CHUNK], rows.schema[value].dataType
    in_group = Window.partitionBy(*group).orderBy(seq)
    # a fixed number of partitions, as the time of a function does not follow bytes
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scanned.frame.repartition(tasks, *group)
    marked = dealt.withColumn(_STARTS, F.row_number().over(in_group) == 1)
    sort = [scan.KEY, scan.CHUNK, seq]
    if not scanned.divided:
        entered = marked.withColumn(_CARRY, F.lit(None).cast(kind))
    else:
        # with all columns, so that both passes read one shuffle
        ends = _fold_chunks(marked.sortWithinPartitions(*sort), group, value, fn)
        entered = marked.join(_carried(ends, value, fn), group, "left")
    names = rows.columns

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            results = []
            columns = (batch.column(c).to_pylist() for c in (_STARTS, _CARRY, value))
            for starts, carry, item in zip(*columns):
                current = _fold(fn, carry if starts else current, item)
                results.append(current)
            folded = pa.array(results, batch.column(value).type)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], folded], [*names, out])

    sorted_rows = entered.sortWithinPartitions(*sort).select(*names, _STARTS, _CARRY)
    return sorted_rows.mapInArrow(fold, T.StructType([*rows.schema.fields, T.StructField(out, kind)]))


_CARRY, _STARTS = "_carry", "_starts"


def _fold(fn: Callable[[Any, Any], Any], before: Any, value: Any) -> Any:
    """None is no value on either side."""
    if before is None or value is None:
        return value if before is None else before
    return fn(before, value)


def _fold_chunks(rows: DataFrame, group: list[str], value: str, fn: Callable[[Any, Any], Any]) -> DataFrame:
    """One row per chunk of the heavy keys: the fold of its sorted rows."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(head: pa.RecordBatch, total: Any) -> pa.RecordBatch:
            columns = [*[head.column(c) for c in group], pa.array([total], head.column(value).type)]
            return pa.RecordBatch.from_arrays(columns, [*group, value])

        head, total = None, None
        for batch in batches:
            starts = np.flatnonzero(batch.column(_STARTS).to_numpy(zero_copy_only=False)).tolist()
            edges = [0, *[s for s in starts if s], batch.num_rows]
            items = batch.column(value).to_pylist()
            for start, end in zip(edges, edges[1:]):
                if start < end and batch.column(_STARTS)[start].as_py():
                    if head is not None:
                        yield row(head, total)
                    # light keys have no chunk and are not folded here
                    known = batch.column(scan.CHUNK)[start].is_valid
                    head, total = (batch.slice(start, 1) if known else None), None
                if head is not None:
                    for item in items[start:end]:
                        total = _fold(fn, total, item)
        if head is not None:
            yield row(head, total)

    return rows.mapInArrow(ends, rows.select(*group, value).schema)


def _carried(ends: DataFrame, value: str, fn: Callable[[Any, Any], Any]) -> DataFrame:
    """The fold of the key's earlier chunks, per chunk."""
    in_key = Window.partitionBy(scan.KEY).orderBy(scan.CHUNK)
    marked = ends.withColumn(_STARTS, F.row_number().over(in_key) == 1)
    names = [scan.KEY, scan.CHUNK]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            entered = []
            for starts, item in zip(*(batch.column(c).to_pylist() for c in (_STARTS, value))):
                entered.append(None if starts else total)
                total = _fold(fn, entered[-1], item)
            carry = pa.array(entered, batch.column(value).type)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], carry], [*names, _CARRY])

    fields = [*ends.select(*names).schema.fields, T.StructField(_CARRY, ends.schema[value].dataType)]
    return marked.sortWithinPartitions(*names).mapInArrow(fold, T.StructType(fields))


def running_sum_concat_key(
    rows: DataFrame, fields: list[str], seq: str, value: str, out: str = "total", **sizes
) -> DataFrame:
    """Running sum keyed by the fields glued together without a separator, so
    ``('a','bc')`` and ``('ab','c')`` are one key. Each result carries the fields
    of the key's first row."""
    keyed = rows.withColumn("_key", F.concat(*[F.col(f).cast("string") for f in fields]))
    scanned = KeyedScan(keyed, ["_key"], [seq], **sizes).add(
        **{out: scan.running_sum(F.col(value)), "_first": scan.first_seen(*fields)}
    )
    kept = [c for c in rows.columns if c not in (*fields, value)]
    return scanned.result().select(*kept, *[f"_first.{f}" for f in fields], out)


def running_views_and_users(
    rows: DataFrame, keys: list[str], user: str, seq: str, **sizes
) -> DataFrame:
    """Running row count ``pv`` and exact running distinct users ``uv`` per key; NULL
    is a user.

    A row counts a user if it is the user's first in the chunk and no earlier chunk had
    the user. Only heavy keys have chunks: for these, the users of each chunk are
    reduced to those whose smallest chunk is an earlier one. They enter their chunk as
    rows ahead of all others, so that the user's own rows are not the first, together
    with one row of what the earlier chunks counted.
    """
    scanned = KeyedScan(rows, keys, [seq], **sizes)
    frame, group = scanned.frame.withColumn(_KIND, F.lit(_ROW)), [scan.KEY]
    if scanned.divided:
        group = [scan.KEY, scan.CHUNK]
        heavy = frame.where(F.col(scan.CHUNK).isNotNull())
        first = F.min(scan.CHUNK).over(Window.partitionBy(scan.KEY, user))
        users = heavy.groupBy(*group, user).agg(F.count(F.lit(1)).alias("_pv")).withColumn(
            "_new", F.col(scan.CHUNK) == first
        )
        seen = users.where(~F.col("_new")).select(*group, user, F.lit(_SEEN).alias(_KIND))
        per_chunk = users.groupBy(*group).agg(
            F.sum("_pv").alias("_pv"), F.sum(F.col("_new").cast("int")).alias("_uv")
        )
        carried = per_chunk.select(
            *group, *[_earlier(F.col(c)).alias(c) for c in ("_pv", "_uv")], F.lit(_CARRIED).alias(_KIND)
        )
        frame = frame.unionByName(seen, allowMissingColumns=True).unionByName(
            carried, allowMissingColumns=True
        )
    else:
        frame = frame.withColumns({c: F.lit(None).cast("bigint") for c in ("_pv", "_uv")})
    kind, row = F.col(_KIND), F.col(_KIND) == _ROW
    carried_row = (kind == _CARRIED).alias("_carried")  # apart from the rows of a NULL user
    of_user = Window.partitionBy(*group, user, carried_row).orderBy(kind, seq)
    so_far = (
        Window.partitionBy(*group).orderBy(kind, seq).rowsBetween(Window.unboundedPreceding, 0)
    )
    # both windows read the one shuffle by group
    fresh = frame.repartition(*group).withColumn("_fresh", F.row_number().over(of_user) == 1)
    counted = fresh.select(
        *rows.columns,
        _KIND,
        F.sum(F.when(row, 1).otherwise(F.col("_pv"))).over(so_far).alias("pv"),
        F.sum(F.when(row, F.col("_fresh").cast("int")).otherwise(F.col("_uv"))).over(so_far).alias("uv"),
    )
    return counted.where(row).drop(_KIND)


#: What a row is in a chunk, in the order in which they are read.
_KIND = "_kind"
_CARRIED, _SEEN, _ROW = 0, 1, 2


def _earlier(part: Column) -> Column:
    """Sum over the earlier chunks of the key."""
    before = Window.partitionBy(scan.KEY).orderBy(scan.CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return F.sum(part).over(before)


def total_views_and_users(rows: DataFrame, keys: list[str], user: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pv"), F.count_distinct(F.col(user)).alias("uv")
    )


def running_two_level(
    rows: DataFrame, outer: str, inner: str, seq: str, value: str, **sizes
) -> DataFrame:
    """Running total of the outer key (``outer_total``) and of the current
    (outer, inner) pair (``inner_total``).

    Both are scanned in one grouping, (outer, chunk): rows are shuffled once. For outer
    keys that are heavy, one aggregate by (outer, chunk, inner) gives both kinds of
    summary; what enters a chunk, of the outer key and of each pair that the chunk has,
    comes as rows ahead of all others.
    """
    scanned = KeyedScan(rows, [outer], [seq], **sizes)
    frame, group = scanned.frame.withColumn(_KIND, F.lit(_ROW)), [scan.KEY]
    if scanned.divided:
        group = [scan.KEY, scan.CHUNK]
        heavy = frame.where(F.col(scan.CHUNK).isNotNull())
        pairs = heavy.groupBy(*group, inner).agg(F.sum(value).alias("_part"))
        in_pair = Window.partitionBy(scan.KEY, inner).orderBy(scan.CHUNK)
        before = F.sum("_part").over(in_pair.rowsBetween(Window.unboundedPreceding, -1))
        of_pairs = pairs.select(*group, inner, before.alias(value), F.lit(_SEEN).alias(_KIND))
        of_outer = pairs.groupBy(*group).agg(F.sum("_part").alias("_part")).select(
            *group, _earlier(F.col("_part")).alias(value), F.lit(_CARRIED).alias(_KIND)
        )
        frame = frame.unionByName(
            of_pairs.where(F.col(value).isNotNull()), allowMissingColumns=True
        ).unionByName(of_outer, allowMissingColumns=True)
    kind = F.col(_KIND)
    order, so_far = [kind, F.col(seq)], (Window.unboundedPreceding, Window.currentRow)
    by_outer = Window.partitionBy(*group).orderBy(*order).rowsBetween(*so_far)
    by_pair = Window.partitionBy(*group, inner).orderBy(*order).rowsBetween(*so_far)
    totals = frame.withColumns(
        {
            "outer_total": F.sum(F.when(kind != _SEEN, F.col(value))).over(by_outer),
            "inner_total": F.sum(F.when(kind != _CARRIED, F.col(value))).over(by_pair),
        }
    )
    return totals.where(kind == _ROW).select(*rows.columns, "outer_total", "inner_total")


def retract_changelog(
    rows: DataFrame, keys: list[str], seq: str, value: str, out: str = "total", **sizes
) -> DataFrame:
    """Change log of a grouped sum: every row retracts the key's old total
    (``is_add`` false; absent on the key's first row) and adds the new one."""
    scanned = KeyedScan(rows, keys, [seq], **sizes).add(
        _new=scan.running_sum(F.col(value)), _nth=scan.running_count(),
        _valued=scan.running_count_of(F.col(value)),
    ).result()
    added = _change(True, F.col("_new"))
    # a NULL adds nothing; the total before the first value is NULL
    before = F.when(
        F.col("_valued") > F.col(value).isNotNull().cast("int"), F.col("_new") - F.coalesce(value, F.lit(0))
    )
    retracted = _change(False, before)
    changes = F.when(F.col("_nth") == 1, F.array(added)).otherwise(F.array(retracted, added))
    return scanned.select(*keys, seq, F.explode(changes).alias("_change")).select(
        *keys, seq, F.col("_change.is_add").alias("is_add"), F.col("_change.total").alias(out)
    )


def _change(is_add: bool, total: Column) -> Column:
    return F.struct(F.lit(is_add).alias("is_add"), total.alias("total"))


def group_sum(rows: DataFrame, keys: list[str], value: str, out: str = "cnt") -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(value).alias(out))


def final_totals(
    rows: DataFrame, keys: list[str], seq: str, value: str, out: str = "total"
) -> DataFrame:
    """What a table holds after upserting every running total: per key the last
    total and the sequence number it came with. Needs no running totals."""
    return rows.groupBy(*keys).agg(F.max(seq).alias(seq), F.sum(value).alias(out))


def latest_per_key(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last row of every key: the final content of an upserted table. An
    aggregate, so each map task sends one row per key. ``seq`` must be unique
    within a key."""
    others = [c for c in rows.columns if c not in (*keys, seq)]
    return rows.groupBy(*keys).agg(
        F.max(seq).alias(seq), *[F.max_by(c, seq).alias(c) for c in others]
    )
