"""Batch forms of keyed state, expiry and timers. Arrival time is a column of
epoch milliseconds (``ts``) instead of the wall clock, so results are repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.functions.times import duration_ms, minute_label, next_boundary_ms
from weir.operators import scan
from weir.operators.joins import PAIRS_PER_TASK, divided_join
from weir.operators.running import running_sum
from weir.operators.scan import KeyedScan


def value_total(
    rows: DataFrame, keys: list[str], seq: str, value: str, out: str = "total", **sizes
) -> DataFrame:
    """Running total per key, never expiring."""
    return running_sum(rows, keys, seq, value, out, **sizes)


def value_total_ttl(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    seq: str,
    value: str,
    ttl: str | int,
    out: str = "total",
    **sizes,
) -> DataFrame:
    """Running total that restarts when a key was idle for ``ttl`` or longer.

    The total since the last restart is the running total minus the running total
    just before that restart. NULL values add nothing; the total is NULL while there
    is no value since the restart. Both scans work on one shuffle.
    """
    idle = F.col(ts) - F.col("_before_ts")
    restarts = F.col("_before_ts").isNull() | (idle >= duration_ms(ttl))
    return (
        KeyedScan(rows, keys, [seq], **sizes)
        .add(
            _before_ts=scan.previous(F.col(ts)),
            _total=scan.running_sum(F.col(value)),
            _valued=scan.running_count_of(F.col(value)),
        )
        .map(_base=F.when(restarts, F.coalesce("_total", F.lit(0)) - F.coalesce(value, F.lit(0))))
        .map(_counted=F.when(restarts, F.col("_valued") - F.col(value).isNotNull().cast("int")))
        .add(_since=scan.last_known(F.col("_base")), _counted_since=scan.last_known(F.col("_counted")))
        .map(**{out: F.when(F.col("_valued") > F.col("_counted_since"), F.col("_total") - F.col("_since"))})
        .result()
        .drop("_before_ts", "_total", "_valued", "_base", "_counted", "_since", "_counted_since")
    )


def list_ttl(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    seq: str,
    element: str,
    ttl: str | int,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """For every record, one row per element still live at its arrival: elements
    of the key that came no later and whose age by ``ts`` is at least 0 and below
    ``ttl``, itself included. (Where ``ts`` falls along ``seq``, an element of a later
    time is not yet live.)

    Live elements sit in the record's own ttl-wide time slot or the one before,
    so this is an equality join on (key, slot): no key is gathered in one place,
    the slots of a hot key spread over the cluster, and slots with very many pairs
    are divided. ``seq`` must be unique.
    """
    width = duration_ms(ttl)
    slot = F.floor(F.col(ts) / F.lit(width))
    records = rows.select(*keys, seq, ts).withColumn("_slot", slot)
    elements = rows.select(
        *keys,
        F.col(seq).alias("element_seq"),
        F.col(ts).alias("_element_ts"),
        F.col(element),
        F.explode(F.array(slot, slot + 1)).alias("_slot"),
    )
    age = F.col(ts) - F.col("_element_ts")
    live = (F.col("element_seq") <= F.col(seq)) & (age >= 0) & (age < width)
    on = [*keys, "_slot"]
    return (
        divided_join(records, elements, on, seq, "element_seq", "inner", pairs_per_task)
        .where(live)
        .drop("_slot", "_element_ts")
    )


def minute_bucket_total(
    rows: DataFrame, keys: list[str], ts: str, seq: str, value: str, out: str = "total", **sizes
) -> DataFrame:
    """Running total per key and wall-clock minute. A bucket is only touched
    during its minute, so expiry frees memory and changes no result."""
    labelled = rows.withColumn("minute", minute_label(F.col(ts)))
    return running_sum(labelled, [*keys, "minute"], seq, value, out, **sizes)


def flush_at_boundary(rows: DataFrame, ts: str, size: str | int, out: str = "flush_ms") -> DataFrame:
    """When each buffered record is emitted: the first boundary strictly after its
    arrival. Within one flush, records keep their arrival order."""
    return rows.withColumn(out, next_boundary_ms(F.col(ts), duration_ms(size)))


def flush_at_watermark_boundary(
    rows: DataFrame,
    order: list[str],
    ts: str,
    size: str | int,
    out: str = "flush_ms",
    chunks: int | None = None,
) -> DataFrame:
    """As ``flush_at_boundary``, counted from the largest event time seen so far
    in arrival order, the record itself included."""
    return (
        KeyedScan(rows, [], order, chunks=chunks)
        .add(_seen=scan.running_max(F.col(ts)))
        .map(**{out: next_boundary_ms(F.col("_seen"), duration_ms(size))})
        .result()
        .drop("_seen")
    )
