"""Groups in streams of sorted Arrow batches.

Rows of a group are neighbours; a group may begin and end anywhere in a batch and run
over many. Places where a group begins are found by comparing whole columns, and a group
is handed on as slices of the batches, which copy nothing. So many small groups cost
little each, and a group of any size never is in memory as a whole.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]
OUT_ROWS = 10_000


def _differs(column: pa.Array) -> np.ndarray:
    """For every row but the first: whether its value is another than the row's before.
    NULL equals NULL, and NaN equals NaN."""
    before, after = column.slice(0, len(column) - 1), column.slice(1)
    other = pc.fill_null(pc.not_equal(before, after), False)
    if pa.types.is_floating(column.type):
        both_nan = pc.and_(pc.is_nan(before), pc.is_nan(after))
        other = pc.and_not(other, pc.fill_null(both_nan, False))
    if column.null_count:
        other = pc.or_(other, pc.xor(before.is_null(), after.is_null()))
    return other.to_numpy(zero_copy_only=False)


def changes(batches: Batches, *names: list[str]) -> Iterator[tuple[pa.RecordBatch, tuple[np.ndarray, ...]]]:
    """Every batch that has rows, with the rows at which any of the named columns takes
    another value, for each list of names. The first row of all is such a row."""
    last: dict[str, pa.Array] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        found = []
        for columns in names:
            other = np.zeros(batch.num_rows, bool)
            other[0] = not last
            for name in columns:
                column = batch.column(name)
                if name in last:
                    column = pa.concat_arrays([last[name], column])
                    other |= _differs(column)
                elif len(column) > 1:
                    other[1:] |= _differs(column)
            found.append(np.flatnonzero(other))
        last = {n: batch.column(n).slice(batch.num_rows - 1) for columns in names for n in columns}
        last = last or {"": pa.nulls(1)}
        yield batch, tuple(found)


def _slices(batches: Batches, by: list[str], within: list[str]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Slices of the batches in which ``by`` and ``within`` do not change, each with
    whether ``by`` has changed."""
    for batch, (groups, parts) in changes(batches, by, [*by, *within]):
        begins = set(groups.tolist())
        edges = [0, *parts[parts > 0].tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield start in begins, batch.slice(start, end - start)


def each_group(
    batches: Batches, by: list[str], within: list[str] | None = None
) -> Iterator[tuple[tuple, Batches]]:
    """(key, slices) of every group. A group's slices can be read until the next group
    is asked for; what has not been read is passed over."""
    pieces = _slices(batches, by, within or [])
    ahead = next(pieces, None)

    def rows() -> Batches:
        nonlocal ahead
        yield ahead[1]
        for begins, piece in pieces:
            if begins:
                ahead = begins, piece
                return
            yield piece
        ahead = None

    while ahead is not None:
        key = tuple(ahead[1].column(name)[0].as_py() for name in by)
        group = rows()
        yield key, group
        for _ in group:
            pass


class Sides:
    """Two sides of one sorted group, told apart by an integer column: 0 comes before 1.
    Read in this order, either side is a stream; where the second is read first, the
    rest of the first is kept."""

    def __init__(self, rows: Batches, side: str, structs: tuple[str, str]):
        self._rows, self._side, self._structs = rows, side, structs
        self._ahead: tuple[deque, deque] = (deque(), deque())

    def read(self, side: int) -> Batches:
        kept = self._ahead[side]
        while True:
            if kept:
                yield kept.popleft()
                continue
            if side == 0 and self._ahead[1]:
                return
            piece = next(self._rows, None)
            if piece is None:
                return
            found = piece.column(self._side)[0].as_py()
            self._ahead[found].append(pa.RecordBatch.from_struct_array(piece.column(self._structs[found])))


def collected(results: Iterable[tuple], schema: pa.Schema) -> Batches:
    """Result rows as batches."""
    held: list[tuple] = []
    for row in results:
        held.append(row)
        if len(held) >= OUT_ROWS:
            yield as_batch(held, schema)
            held = []
    if held:
        yield as_batch(held, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def apply_to_groups(
    fn: Callable[[tuple, Batches], Iterable[tuple]], by: list[str], schema: pa.Schema
) -> Callable[[Batches], Batches]:
    """Body of a ``mapInArrow`` over sorted rows."""

    def run(batches: Batches) -> Batches:
        results = (row for key, group in each_group(batches, by) for row in fn(key, group) or ())
        yield from collected(results, schema)

    return run
