"""Count windows over all records of a stream, as a ``foreachBatch`` writer.

A window of ``size`` records may span micro-batches. What a batch leaves behind is two
numbers and a sum: how many records came so far, and what the open window holds. So a
batch finds the places of its own records by a scan, as in batch, moves them by the
records before, and adds the open window to its first one.

Batch n reads what n - 1 left and overwrites its own files, so a replayed batch gives
the same windows; what it leaves behind is written last. For count windows per key, the
state of a key is the stream engine's: see ``stateful.CountWindows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import scan
from weir.operators.scan import KeyedScan
from weir.operators.windows import numbered_sums


class CountWindowWriter:
    """Windows of ``size`` records in the order of ``seq``; later batches come later."""

    def __init__(self, path: str, seq: str, value: str, size: int, out: str = "total"):
        self.path, self.seq, self.value, self.size, self.out = path, seq, value, size, out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, open_index, open_sum, open_n = self._left(spark, batch_id - 1)
        rows = batch.select(self.seq, self.value).persist()
        try:
            indexed = KeyedScan(rows, [], [self.seq]).add(_nth=scan.running_count()).result()
            place = F.col("_nth") - 1 + F.lit(before)
            sums = numbered_sums(indexed, [], place, self.value, self.size, self.out)
            first = F.col("window_index") == F.lit(open_index)
            carried = F.lit(open_sum).cast(sums.schema[self.out].dataType)
            total = F.when(first, F.coalesce(F.col(self.out) + carried, self.out, carried)).otherwise(F.col(self.out))
            n = F.col("n") + F.when(first, F.lit(open_n)).otherwise(0)
            windows = sums.select("window_index", total.alias(self.out), n.alias("n")).persist()
            try:
                full = windows.where(F.col("n") == self.size).drop("n")
                full.write.mode("overwrite").parquet(f"{self.path}/windows/batch_id={batch_id}")
                self._leave(spark, batch_id, before, (open_index, open_sum, open_n), windows)
            finally:
                windows.unpersist()
        finally:
            rows.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """Full windows, each once."""
        return spark.read.parquet(f"{self.path}/windows").drop("batch_id")

    def _leave(self, spark, batch_id: int, before: int, held: tuple, windows: DataFrame) -> None:
        count = windows.agg(F.sum("n")).first()[0]
        seen = before if count is None else before + count - held[2]
        rest = windows.where(F.col("n") < self.size).first()  # at most the last one
        if rest is not None:
            held = (rest["window_index"], rest[self.out], rest["n"])
        elif count is not None:
            held = (seen // self.size, None, 0)
        kind = windows.schema[self.out].dataType.simpleString()
        spark.createDataFrame(
            [(seen, *held)], f"seen BIGINT, open_index BIGINT, open_sum {kind}, open_n BIGINT"
        ).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/left/batch_id={batch_id}")

    def _left(self, spark: SparkSession, batch_id: int) -> tuple:
        if batch_id < 0:
            return 0, 0, None, 0
        return tuple(spark.read.parquet(f"{self.path}/left/batch_id={batch_id}").first())
