"""Windows with late output, as a ``foreachBatch`` writer.

Spark filters late records before any operator can see them. ``CarriedWindows``
decides lateness itself, record by record in arrival order, and keeps its state
as one small table version per micro-batch in a shared folder:

    marks/batch_id=n     largest event time seen up to batch n
    windows/batch_id=n   windows open after n (``closed`` false) and windows that
                         closed in n (``closed`` true)
    late/batch_id=n      late records of n

Batch n reads version n-1 and overwrites version n, so a replayed batch gives the
same files. The mark is written last. State grows with the open windows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weir.functions.times import duration_ms
from weir.operators import lateness, windows
from weir.operators.windows import END, START


class CarriedWindows:
    """``reduce`` turns the records in time of one micro-batch into window rows
    (with ``window_start`` and ``window_end``); ``merge`` folds window rows of
    several micro-batches, distinguished by ``batch``, into one set of rows."""

    def __init__(
        self,
        path: str,
        order: list[str],
        ts: str,
        size: str | int,
        delay: str | int = 0,
        *,
        reduce: Callable[[DataFrame], DataFrame],
        merge: Callable[[DataFrame], DataFrame],
    ):
        self.path = path
        self.order, self.ts = order, ts
        self.size, self.delay_ms = size, duration_ms(delay)
        self.reduce, self.merge = reduce, merge

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = self._mark(spark, batch_id - 1)
        flagged = lateness.flag_late(
            batch, self.order, self.ts, self.size, self.delay_ms, seen_before=seen
        ).persist()
        try:
            newest = flagged.agg(F.max(self.ts)).first()[0]
            mark = max((m for m in (seen, newest) if m is not None), default=None)
            lateness.late_rows(flagged).write.mode("overwrite").parquet(self._late(batch_id))
            fresh = self.reduce(flagged.where(~F.col("late")).drop("late"))
            rows = fresh.withColumn("batch", F.lit(batch_id))
            if batch_id > 0:
                carried = spark.read.parquet(self._windows(batch_id - 1))
                rows = rows.unionByName(carried.where(~F.col("closed")).drop("closed"))
            ended = F.col(END) <= F.lit(mark).cast("bigint") - F.lit(self.delay_ms)
            closed = F.coalesce(ended, F.lit(False))
            self.merge(rows).withColumn("closed", closed).write.mode("overwrite").parquet(
                self._windows(batch_id)
            )
            spark.createDataFrame([(mark,)], "mark BIGINT").coalesce(1).write.mode(
                "overwrite"
            ).parquet(self._marks(batch_id))
        finally:
            flagged.unpersist()

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/late").drop("batch_id")

    def closed(self, spark: SparkSession) -> DataFrame:
        """Windows that have ended, each once."""
        rows = spark.read.parquet(f"{self.path}/windows").where("closed")
        return rows.drop("closed", "batch", "batch_id")

    def _mark(self, spark: SparkSession, batch_id: int) -> int | None:
        if batch_id < 0:
            return None
        return spark.read.schema("mark BIGINT").parquet(self._marks(batch_id)).first()[0]

    def _marks(self, batch_id: int) -> str:
        return f"{self.path}/marks/batch_id={batch_id}"

    def _windows(self, batch_id: int) -> str:
        return f"{self.path}/windows/batch_id={batch_id}"

    def _late(self, batch_id: int) -> str:
        return f"{self.path}/late/batch_id={batch_id}"


def late_splitting_sum(
    path: str,
    keys: list[str],
    order: list[str],
    ts: str,
    value: str,
    size: str | int,
    delay: str | int = 0,
    out: str = "total",
) -> CarriedWindows:
    """Tumbling sum of the records in time; late ones go out unaggregated."""

    def reduce(rows: DataFrame) -> DataFrame:
        return rows.groupBy(START, END, *keys).agg(
            F.min_by(ts, "place").alias("first_ts"), F.sum(value).alias(out)
        )

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(START, END, *keys).agg(
            F.min("batch").alias("batch"),
            F.min_by("first_ts", "batch").alias("first_ts"),
            F.sum(out).alias(out),
        )

    return CarriedWindows(path, order, ts, size, delay, reduce=reduce, merge=merge)


def top_n_per_window(
    path: str,
    keys: list[str],
    order: list[str],
    ts: str,
    value: str,
    size: str | int,
    n: int = 3,
    delay: str | int = 0,
) -> CarriedWindows:
    """The ``n`` largest values per key and window; never more than ``n`` rows of a
    group are shuffled by a task or kept."""
    kept = [START, END, *keys, ts, value, "place"]

    def reduce(rows: DataFrame) -> DataFrame:
        return windows.window_top_n(rows, keys, ts, value, "place", size, n).select(*kept)

    def merge(rows: DataFrame) -> DataFrame:
        best = Window.partitionBy(START, *keys).orderBy(F.desc(value), "batch", "place")
        ranked = rows.drop("rank").withColumn("rank", F.row_number().over(best))
        return ranked.where(F.col("rank") <= n)

    def plain(rows: DataFrame) -> DataFrame:
        return reduce(rows).withColumn("rank", F.lit(0))

    return CarriedWindows(path, order, ts, size, delay, reduce=plain, merge=merge)
