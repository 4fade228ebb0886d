"""Keyed operators with state, expiry and timers on ``transformWithState``.

They give one result per record, also in batch, in the order of a sequence column.
On a stream, a processor sorts the records a key brings in one micro-batch, whose
number the source's rate limit bounds. In batch, Spark sorts them and the processor
streams over them; the batch forms in ``weir.operators`` also split heavy keys and
are the choice for backlogs. State lives in the RocksDB store (``weir.session.configure_streaming``).

State and results have the types of the input's columns: numbers of any type add up as
in Spark's ``sum`` (whole numbers to BIGINT, decimals with ten more digits), and keys,
elements, names and payloads may be of any type. A NULL adds nothing to a total, which
is NULL before the first value; NULL is a user, an inner key and an element like others.

State is read when a key's records begin and written when they end, so a micro-batch
costs each key, or each entry of a map, one read and one write, however many records it
brings. Expiry follows the processing clock and is renewed by writing.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weir.functions.times import duration_ms

#: Entries of a map that a processor holds between writes.
CACHED = 10_000
_EXACT = decimal.Context(prec=100)


def sum_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale)
    raise TypeError(f"values of type {kind.simpleString()} do not add up")


def add(total: Any, value: Any) -> Any:
    """None is no value on either side."""
    if total is None or value is None:
        return value if total is None else total
    return _EXACT.add(total, value) if isinstance(total, decimal.Decimal) else total + value


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


class CachedMap:
    """Map state with the entries that the current key has touched."""

    def __init__(self, state, size: int = CACHED):
        self.state, self.size = state, size
        self.held: dict[tuple, tuple | None] = {}
        self.changed: set[tuple] = set()

    def get(self, entry: tuple) -> tuple | None:
        if entry not in self.held:
            if len(self.held) >= self.size:
                self.write()
            self.held[entry] = tuple(self.state.getValue(entry)) if self.state.containsKey(entry) else None
        return self.held[entry]

    def put(self, entry: tuple, value: tuple) -> None:
        self.held[entry] = value
        self.changed.add(entry)

    def write(self) -> None:
        for entry in self.changed:
            self.state.updateValue(entry, self.held[entry])
        self.held.clear()
        self.changed.clear()


class KeyedOperator(StatefulProcessor):
    """Base: one key column, records handled one by one in sequence order.

    ``results`` gives the columns of the results from those of the input."""

    time_mode = "none"
    presorted = False

    def __init__(self, key: str, seq: str, ttl: str | int | None = None):
        self.key = key
        self.seq = seq
        self.ttl_ms = None if ttl is None else duration_ms(ttl)

    def apply(
        self, rows: DataFrame, schema: T.StructType | str | None = None, mode: str = "append"
    ) -> DataFrame:
        """Run over a streaming or batch frame. ``schema`` names and casts the results,
        by position, where they should differ from the derived ones."""
        self.types = {f.name: f.dataType for f in rows.schema.fields}
        derived = self.results()
        self.result = Row(*derived.fieldNames())
        self.presorted = not rows.isStreaming
        if self.presorted:
            tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            rows = rows.repartition(tasks, self.key)
            rows = rows.sortWithinPartitions(self.key, *self.order_columns())
        time_mode = self.time_mode
        if self.ttl_ms is not None and time_mode == "none":
            time_mode = "processingTime"
        out = rows.groupBy(self.key).transformWithState(
            statefulProcessor=self,
            outputStructType=derived,
            outputMode=mode,
            timeMode=time_mode,
        )
        if schema is None:
            return out
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        pairs = zip(derived.fieldNames(), wanted.fields, strict=True)
        return out.select(*[F.col(name).cast(f.dataType).alias(f.name) for name, f in pairs])

    def results(self) -> T.StructType:
        raise NotImplementedError

    def keyed(self, **more: T.DataType) -> T.StructType:
        return _fields(**{self.key: self.types[self.key], self.seq: self.types[self.seq]}, **more)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.begin()
        for row in self.in_order(rows):
            for values in self.on_record(key[0], row, timerValues):
                yield self.result(*values)
        self.end()

    def begin(self) -> None:
        """Read what the key's records need."""

    def end(self) -> None:
        """Write what they have changed."""

    def in_order(self, rows: Iterator[Row]) -> Iterator[Row]:
        def place(row: Row) -> tuple:
            return tuple((row[c] is not None, row[c]) for c in self.order_columns())

        if not self.presorted:
            yield from sorted(rows, key=place)
            return
        last = None
        for row in rows:
            here = place(row)
            if last is not None and here < last:
                raise RuntimeError("rows of a key are out of order")
            last = here
            yield row

    def order_columns(self) -> list[str]:
        return [self.seq]

    def on_record(self, key, row: Row, timers) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class _OneValue(KeyedOperator):
    """Holds one value per key in ``current``; None is no value."""

    def __init__(self, key: str, seq: str, value: str, ttl: str | int | None = None):
        super().__init__(key, seq, ttl)
        self.value = value

    def value_type(self) -> T.DataType:
        return sum_type(self.types[self.value])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("value", _fields(value=self.value_type()), self.ttl_ms)

    def begin(self) -> None:
        before = self.state.get()
        self.known, self.current = before is not None, before[0] if before else None

    def end(self) -> None:
        self.state.update((self.current,))


class RunningTotal(_OneValue):
    """(key, seq, total so far). With ``ttl`` the total restarts after an idle
    time of that length."""

    def results(self) -> T.StructType:
        return self.keyed(total=self.value_type())

    def on_record(self, key, row, timers):
        self.current = add(self.current, row[self.value])
        yield key, row[self.seq], self.current


class ReduceByKey(_OneValue):
    """(key, seq, folded value) for any Python function of two values. NULLs are skipped."""

    def __init__(self, key: str, seq: str, value: str, fn: Callable):
        super().__init__(key, seq, value)
        self.fn = fn

    def value_type(self) -> T.DataType:
        return self.types[self.value]

    def results(self) -> T.StructType:
        return self.keyed(reduced=self.value_type())

    def on_record(self, key, row, timers):
        value = row[self.value]
        if value is not None:
            self.current = value if self.current is None else self.fn(self.current, value)
        yield key, row[self.seq], self.current


class RetractLog(_OneValue):
    """(key, seq, is_add, total): the old total withdrawn, then the new one."""

    def results(self) -> T.StructType:
        return self.keyed(is_add=T.BooleanType(), total=self.value_type())

    def on_record(self, key, row, timers):
        if self.known:
            yield key, row[self.seq], False, self.current
        self.known = True
        self.current = add(self.current, row[self.value])
        yield key, row[self.seq], True, self.current


class ViewsAndUsers(KeyedOperator):
    """(key, seq, rows so far, distinct users so far). Users are map entries, so a
    record touches one entry and not the whole set."""

    def __init__(self, key: str, seq: str, user: str, ttl: str | int | None = None):
        super().__init__(key, seq, ttl)
        self.user = user

    def results(self) -> T.StructType:
        return self.keyed(pv=T.LongType(), uv=T.LongType())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", "pv BIGINT, uv BIGINT", self.ttl_ms)
        users = handle.getMapState("users", _fields(user=self.types[self.user]), "seen BOOLEAN", self.ttl_ms)
        self.users = CachedMap(users)

    def begin(self) -> None:
        self.pv, self.uv = self.counts.get() or (0, 0)

    def end(self) -> None:
        self.counts.update((self.pv, self.uv))
        self.users.write()

    def on_record(self, key, row, timers):
        user = (row[self.user],)
        fresh = self.users.get(user) is None
        self.users.put(user, (True,))  # renews the entry's time, too
        self.pv, self.uv = self.pv + 1, self.uv + int(fresh)
        yield key, row[self.seq], self.pv, self.uv


class TwoLevelTotals(_OneValue):
    """(outer, seq, inner, outer total, inner total)."""

    def __init__(self, outer: str, inner: str, seq: str, value: str):
        super().__init__(outer, seq, value)
        self.inner = inner

    def results(self) -> T.StructType:
        kind = self.value_type()
        return self.keyed(**{self.inner: self.types[self.inner]}, outer_total=kind, inner_total=kind)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        inner, kind = _fields(inner=self.types[self.inner]), _fields(total=self.value_type())
        self.parts = CachedMap(handle.getMapState("parts", inner, kind))

    def end(self) -> None:
        super().end()
        self.parts.write()

    def on_record(self, key, row, timers):
        name, value = (row[self.inner],), row[self.value]
        self.current = add(self.current, value)
        inner_total = add((self.parts.get(name) or (None,))[0], value)
        self.parts.put(name, (inner_total,))
        yield key, row[self.seq], name[0], self.current, inner_total


class LiveList(KeyedOperator):
    """For each record, all elements of the key younger than ``ttl``:
    (key, seq, element)."""

    def __init__(self, key: str, seq: str, element: str, ttl: str | int):
        super().__init__(key, seq, ttl)
        self.element = element

    def results(self) -> T.StructType:
        return self.keyed(element=self.types[self.element])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.elements = handle.getListState("elements", _fields(element=self.types[self.element]), self.ttl_ms)

    def begin(self) -> None:
        self.live = [e[0] for e in self.elements.get()]
        self.stored = len(self.live)

    def end(self) -> None:
        self.elements.appendList([(e,) for e in self.live[self.stored :]])

    def on_record(self, key, row, timers):
        self.live.append(row[self.element])
        for element in self.live:
            yield key, row[self.seq], element


class MinuteBuckets(KeyedOperator):
    """(key, seq, minute, total of that minute). Entries expire ``ttl`` after they
    were last touched; every read is followed by a write."""

    def __init__(self, key: str, seq: str, minute: str, value: str, ttl: str | int = "1 minute"):
        super().__init__(key, seq, ttl)
        self.minute, self.value = minute, value

    def results(self) -> T.StructType:
        total = sum_type(self.types[self.value])
        return self.keyed(**{self.minute: self.types[self.minute]}, total=total)

    def init(self, handle: StatefulProcessorHandle) -> None:
        minute, total = _fields(minute=self.types[self.minute]), _fields(total=sum_type(self.types[self.value]))
        self.buckets = CachedMap(handle.getMapState("buckets", minute, total, self.ttl_ms))

    def end(self) -> None:
        self.buckets.write()

    def on_record(self, key, row, timers):
        name = (row[self.minute],)
        total = add((self.buckets.get(name) or (None,))[0], row[self.value])
        self.buckets.put(name, (total,))
        yield key, row[self.seq], name[0], total


class CountWindows(KeyedOperator):
    """(key, seq, window_index, total) for every ``size`` records of a key: the record
    that fills the window, the window's number and the sum of its values."""

    def __init__(self, key: str, seq: str, value: str, size: int):
        super().__init__(key, seq)
        self.value, self.size = value, size

    def results(self) -> T.StructType:
        return self.keyed(window_index=T.LongType(), total=sum_type(self.types[self.value]))

    def init(self, handle: StatefulProcessorHandle) -> None:
        kinds = _fields(n=T.LongType(), total=sum_type(self.types[self.value]))
        self.state = handle.getValueState("open", kinds)

    def begin(self) -> None:
        self.n, self.total = self.state.get() or (0, None)

    def end(self) -> None:
        self.state.update((self.n, self.total))

    def on_record(self, key, row, timers):
        self.n, self.total = self.n + 1, add(self.total, row[self.value])
        if self.n % self.size == 0:
            yield key, row[self.seq], self.n // self.size - 1, self.total
            self.total = None


class VersionedLookup(KeyedOperator):
    """Facts with the current dimension name: (key, seq, payload, name). Input rows
    are facts (``kind`` 1) and changes (``kind`` 0) of one key, as laid out by
    ``lookup_input``; at equal sequence numbers the change comes first."""

    def results(self) -> T.StructType:
        return self.keyed(payload=self.types["payload"], name=self.types["name"])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("name", _fields(name=self.types["name"]))

    def begin(self) -> None:
        before = self.state.get()
        self.name, self.changed = before[0] if before else None, False

    def end(self) -> None:
        if self.changed and self.name is None:
            self.state.clear()
        elif self.changed:
            self.state.update((self.name,))

    def order_columns(self):
        return [self.seq, "kind"]

    def on_record(self, key, row, timers):
        if row["kind"] == 1:
            yield key, row[self.seq], row["payload"], self.name
        else:
            self.name, self.changed = None if row["op"] == "delete" else row["name"], True


def lookup_input(
    facts: DataFrame, changes: DataFrame, key: str, seq: str, payload: str | list[str]
) -> DataFrame:
    """Facts and changes in one frame. ``payload`` names a column of the facts, of any
    type, or several, which come as a struct."""
    carried = F.col(payload) if isinstance(payload, str) else F.struct(*payload)
    return facts.select(key, seq, carried.alias("payload"), F.lit(1).alias("kind")).unionByName(
        changes.select(key, seq, F.lit(0).alias("kind"), "name", "op"), allowMissingColumns=True
    )


class FlushAtBoundary(KeyedOperator):
    """Buffer the records of a key and emit them in order at the next boundary:
    (key, seq, value, boundary). Records of one boundary share one timer.

    Records are numbered within their boundary, so a timer looks up those it emits, one
    by one, and costs nothing for the rest of the buffer."""

    def __init__(self, key: str, seq: str, value: str, size: str | int):
        super().__init__(key, seq)
        self.value, self.size_ms = value, duration_ms(size)

    def results(self) -> T.StructType:
        return self.keyed(**{self.value: self.types[self.value]}, flush_ms=T.LongType())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        record = _fields(seq=self.types[self.seq], value=self.types[self.value])
        self.buffer = handle.getMapState("buffer", "boundary BIGINT, nth BIGINT", record)
        self.sizes = CachedMap(handle.getMapState("sizes", "boundary BIGINT", "n BIGINT"))

    def end(self) -> None:
        self.sizes.write()

    def now_ms(self, row, timers) -> int:
        raise NotImplementedError

    def on_record(self, key, row, timers):
        now = self.now_ms(row, timers)
        boundary = now - now % self.size_ms + self.size_ms
        n = (self.sizes.get((boundary,)) or (0,))[0]
        if n == 0:
            self.handle.registerTimer(boundary)
        self.buffer.updateValue((boundary, n), (row[self.seq], row[self.value]))
        self.sizes.put((boundary,), (n + 1,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        boundary = expiredTimerInfo.getExpiryTimeInMs()
        n = (self.sizes.get((boundary,)) or (0,))[0]
        self.sizes.write()
        due = []
        for nth in range(n):
            due.append(tuple(self.buffer.getValue((boundary, nth))))
            self.buffer.removeKey((boundary, nth))
        if n:
            self.sizes.state.removeKey((boundary,))
        for seq, value in sorted(due, key=lambda r: (r[0] is not None, r[0])):
            yield self.result(key[0], seq, value, boundary)


class FlushAtClockBoundary(FlushAtBoundary):
    """Boundaries of the processing clock. The query only ends when stopped."""

    time_mode = "processingTime"

    def now_ms(self, row, timers):
        return timers.getCurrentProcessingTimeInMs()


class FlushAtWatermarkBoundary(FlushAtBoundary):
    """Boundaries of event time: after the larger of the watermark and the
    record's own time ``ts``. Needs a watermark on the input."""

    time_mode = "eventTime"

    def __init__(self, key: str, seq: str, ts: str, value: str, size: str | int):
        super().__init__(key, seq, value, size)
        self.ts = ts

    def now_ms(self, row, timers):
        return max(row[self.ts], timers.getCurrentWatermarkInMs())
