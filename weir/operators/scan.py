"""Ordered scans (running totals, lags, carried values) that split heavy keys.

A window function puts every row of a key into one task, which is hopeless when one
key (or NULL) holds a third of the table. ``KeyedScan`` finds the keys that are heavier
than a share of the table and cuts them, and only them, at quantiles of their own order.

How keys are found: the table has ``shares`` equal shares, twice the shuffle partitions
or more. Quantiles of a hash of the key, one per share, are taken over all rows. A key
that owns two neighbouring quantiles is heavy; one with two and a half shares always
owns two, so none is missed, and there are at most ``shares`` / 2 of them. A second
aggregate, over the rows of heavy keys alone, cuts each by its own order into about as
many chunks as it has shares. All chunks together are no more than the shares.

* Rows of light keys are in one chunk: a plain window.
* Rows of heavy keys are scanned by (key, chunk). One summary per chunk, combined
  map-side, and a prefix over the summaries of a key give the state that enters a chunk.

Rows are shuffled once, summaries number as many as the chunks at most, and without a
heavy key the plan is that of the window alone. A scan without key is one heavy key.
The cuts decide on balance only; results do not depend on them. Keys are compared as a
struct, so NULL is a key like any other; NULL order values come first, as in a window.

The cuts are found when the scan is built (a job over the key, and one over the order of
heavy keys); no more than ``shares`` numbers reach the driver. Where order values are
dense and unique within a key (windows, slots), ``chunk`` may name ranges of them
instead, and there is no job.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows that a chunk has at most, where there are more than the shares would make.
CHUNK_ROWS = 1 << 23

CHUNK = "_chunk"
KEY = "_scan_key"
HASH = "_scan_hash"


@dataclass(frozen=True)
class Fold:
    """One scanned value.

    ``local``    value inside a chunk, given the chunk's row window
    ``summary``  one value per chunk, given the order expression
    ``carry``    value entering a chunk, given the summary column and the window
                 over the earlier chunks
    ``merge``    combines the entering value (NULL in the first chunk) with ``local``
    """

    local: Callable[[WindowSpec], Column]
    summary: Callable[[Column], Column]
    carry: Callable[[Column, WindowSpec], Column]
    merge: Callable[[Column, Column], Column]


def _through_current(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before_current(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def running_sum(value: Column) -> Fold:
    return Fold(
        local=lambda w: F.sum(value).over(_through_current(w)),
        summary=lambda order: F.sum(value),
        carry=lambda part, w: F.sum(part).over(w),
        merge=lambda before, local: F.coalesce(before + local, local, before),
    )


def running_count() -> Fold:
    return running_sum(F.lit(1).cast("bigint"))


def running_count_of(value: Column) -> Fold:
    """Number of non-NULL values so far."""
    return running_sum(value.isNotNull().cast("bigint"))


def running_max(value: Column) -> Fold:
    return Fold(
        local=lambda w: F.max(value).over(_through_current(w)),
        summary=lambda order: F.max(value),
        carry=lambda part, w: F.max(part).over(w),
        merge=lambda before, local: F.greatest(before, local),
    )


def running_min(value: Column) -> Fold:
    return Fold(
        local=lambda w: F.min(value).over(_through_current(w)),
        summary=lambda order: F.min(value),
        carry=lambda part, w: F.min(part).over(w),
        merge=lambda before, local: F.least(before, local),
    )


def max_before(value: Column) -> Fold:
    """Largest value over strictly earlier rows; NULL on the first row."""
    return Fold(
        local=lambda w: F.max(value).over(_before_current(w)),
        summary=lambda order: F.max(value),
        carry=lambda part, w: F.max(part).over(w),
        merge=lambda before, local: F.greatest(before, local),
    )


def first_seen(*columns: str) -> Fold:
    """The named columns of the key's first row, as a struct."""
    row = F.struct(*columns)
    return Fold(
        local=lambda w: F.first(row).over(_through_current(w)),
        summary=lambda order: F.min_by(row, order),
        carry=lambda part, w: F.first(part).over(w),
        merge=lambda before, local: F.coalesce(before, local),
    )


def last_known(value: Column) -> Fold:
    """Latest non-NULL value up to and including the current row."""
    return Fold(
        local=lambda w: F.last(value, ignorenulls=True).over(_through_current(w)),
        summary=lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        carry=lambda part, w: F.last(part, ignorenulls=True).over(w),
        merge=lambda before, local: F.coalesce(local, before),
    )


def previous(value: Column) -> Fold:
    """The value on the row before; it must not be NULL on any row."""
    return Fold(
        local=lambda w: F.lag(value).over(w),
        summary=lambda order: F.max_by(value, order),
        carry=lambda part, w: F.last(part).over(w),
        merge=lambda before, local: F.coalesce(local, before),
    )


class KeyedScan:
    """Rows prepared for scans per key, in the order given.

    ``order[0]`` must be an integer column; further order columns break its ties.
    Give ``keys=[]`` for one scan over the whole table. ``chunks`` is the number of
    shares; by default it follows the shuffle partitions and the number of rows.

    ``rows`` may be costly to compute; ``order_rows`` then stands in for it when cuts
    are found. ``chunk`` is an integer column that grows with the order, in place of cuts.

    ``divided`` tells whether any key has several chunks, ``frame`` has the rows with
    ``KEY`` and ``CHUNK``.
    """

    def __init__(
        self,
        rows: DataFrame,
        keys: list[str],
        order: list[str],
        *,
        chunks: int | None = None,
        order_rows: DataFrame | None = None,
        chunk: Column | None = None,
    ):
        self.keys = keys
        self.order = order
        self.columns = rows.columns
        key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
        keyed = rows.withColumn(KEY, key)
        if chunk is not None:
            self.divided = True
            first = F.lit(-(1 << 62)).cast("bigint")  # a NULL order comes first
            self.frame = keyed.withColumn(CHUNK, F.coalesce(chunk.cast("bigint"), first))
            return
        cuts = find_cuts(rows if order_rows is None else order_rows, keys, order[0], chunks)
        self.divided = bool(cuts)
        self.frame = _with_chunk(keyed, F.col(order[0]), cuts, bool(keys))

    def add(self, **folds: Fold) -> "KeyedScan":
        """Append one column per fold. Later calls reuse the same shuffle."""
        group, order = [KEY, CHUNK], [F.col(name) for name in self.order]
        rows = Window.partitionBy(*(group if self.divided else [KEY])).orderBy(*order)
        if not self.divided:
            return self._with(
                self.frame.select("*", *[fold.local(rows).alias(name) for name, fold in folds.items()])
            )
        local = self.frame.select(
            "*", *[fold.local(rows).alias(f"_local_{name}") for name, fold in folds.items()]
        )
        carries = self.carries(**folds)
        merged = local.join(carries, group, "left").select(
            *self.frame.columns,
            *[
                fold.merge(F.col(f"_carry_{name}"), F.col(f"_local_{name}")).alias(name)
                for name, fold in folds.items()
            ],
        )
        return self._with(merged)

    def summaries(self, **folds: Fold) -> DataFrame:
        """One row per (key, chunk) of the heavy keys: what ``carry`` folds over."""
        position = F.struct(*self.order)  # never NULL itself, so NULL order values count
        return (
            self.frame.where(F.col(CHUNK).isNotNull())
            .groupBy(KEY, CHUNK)
            .agg(*[fold.summary(position).alias(f"_part_{name}") for name, fold in folds.items()])
        )

    def carries(self, **folds: Fold) -> DataFrame:
        """The state that enters each chunk of the heavy keys."""
        earlier = _before_current(Window.partitionBy(KEY).orderBy(CHUNK))
        return self.summaries(**folds).select(
            KEY,
            CHUNK,
            *[
                fold.carry(F.col(f"_part_{name}"), earlier).alias(f"_carry_{name}")
                for name, fold in folds.items()
            ],
        )

    def map(self, **columns: Column) -> "KeyedScan":
        """Append plain columns between two scans."""
        return self._with(self.frame.withColumns(columns))

    def result(self) -> DataFrame:
        return self.frame.drop(CHUNK, KEY)

    def _with(self, frame: DataFrame) -> "KeyedScan":
        other = object.__new__(KeyedScan)
        other.keys, other.order, other.columns = self.keys, self.order, self.columns
        other.divided, other.frame = self.divided, frame
        return other


def find_cuts(
    rows: DataFrame, keys: list[str], order: str, shares: int | None = None
) -> list[tuple[int, list[int]]]:
    """(hash of the key, cuts of its order) for every heavy key."""
    seq = F.col(order).cast("bigint")
    if not keys:
        wanted = shares or _shares(rows)
        found = _quantiles(rows, seq, wanted)
        if shares is None and found["n"] > CHUNK_ROWS * wanted:
            found = _quantiles(rows, seq, math.ceil(found["n"] / CHUNK_ROWS))
        cuts = sorted(set(found["cuts"] or ()))
        return [(0, cuts)] if cuts else []
    hashed = rows.select(_hash(keys).alias(HASH), seq.alias(order))
    wanted = shares or _shares(rows)
    found = _quantiles(hashed, F.col(HASH), wanted)
    if shares is None and found["n"] > CHUNK_ROWS * wanted:
        wanted = math.ceil(found["n"] / CHUNK_ROWS)
        found = _quantiles(hashed, F.col(HASH), wanted)
    owned: dict[int, int] = {}
    for h in found["cuts"] or ():
        owned[h] = owned.get(h, 0) + 1
    heavy = {h: n for h, n in owned.items() if n > 1}
    if not heavy:
        return []
    most = max(heavy.values())
    each = hashed.where(F.col(HASH).isin(list(heavy))).groupBy(HASH).agg(
        F.percentile_approx(order, _steps(most), _accuracy(most)).alias("cuts")
    )
    # of the finest cuts, a key takes as many as it has shares
    cuts = []
    for h, fine in each.collect():
        n = heavy[h]
        picked = {fine[i * most // n - 1] for i in range(1, n)} if fine else set()
        if picked:
            cuts.append((h, sorted(picked)))
    return cuts


def _hash(keys: list[str]) -> Column:
    """NULLs are told apart from values: they change the hash of what follows. The hash
    has 52 bits, as quantiles are taken of doubles."""
    whole = F.xxhash64(*[part for k in keys for part in (F.col(k).isNull(), F.col(k))])
    return F.shiftrightunsigned(whole, 12)


def _shares(rows: DataFrame) -> int:
    return 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _steps(n: int) -> list[float]:
    return [i / n for i in range(1, n)]


def _accuracy(n: int) -> int:
    """Ranks are off by a tenth of a share at most."""
    return max(10_000, 10 * n)


def _quantiles(rows: DataFrame, value: Column, shares: int):
    if shares < 2:
        return {"n": 0, "cuts": None}
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(value, _steps(shares), _accuracy(shares)).alias("cuts"),
    ).first()


def _with_chunk(
    rows: DataFrame, order: Column, cuts: list[tuple[int, list[int]]], keyed: bool
) -> DataFrame:
    """``CHUNK`` is the number of a heavy key's cuts below the order value (0 for NULL),
    found by halving; NULL for light keys."""
    kept = rows.columns
    if not cuts:
        return rows.withColumn(CHUNK, F.lit(None).cast("int"))
    if keyed:
        # the key's cuts come by a join with at most half as many rows as there are shares
        hashes, lists = zip(*cuts)
        table = rows.sparkSession.createDataFrame(
            pa.table({HASH: pa.array(hashes, pa.int64()), "_cuts": pa.array(lists, pa.list_(pa.int64()))})
        )
        rows = rows.withColumn(HASH, _hash([f"{KEY}.{k}" for k in rows.schema[KEY].dataType.names]))
        rows, cut = rows.join(F.broadcast(table), HASH, "left"), F.col("_cuts")
        heavy = cut.isNotNull()
    else:
        cut, heavy = F.lit(cuts[0][1]), F.lit(True)
    found, step = F.lit(0), 1 << (max(len(c) for _, c in cuts).bit_length() - 1)
    while step:
        # beyond the last cut there is NULL, and nothing is above it
        above = order > F.get(cut, found + (step - 1))
        name = f"_chunk_{step}"
        rows = rows.withColumn(name, found + F.when(above, F.lit(step)).otherwise(0))
        found, step = F.col(name), step // 2
    return rows.select(*kept, F.when(heavy, found).alias(CHUNK))
