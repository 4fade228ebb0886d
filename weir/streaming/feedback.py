"""Feedback loop over a stream: each micro-batch iterates to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weir.operators.iterate import Again, Step, iterate_until


class IterateEach:
    """``foreachBatch`` writer: the records leaving the loop go to
    ``path/batch_id=n``, which a replay overwrites."""

    def __init__(self, path: str, step: Step, again: Again):
        self.path, self.step, self.again = path, step, again

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        left = iterate_until(batch, self.step, self.again)
        left.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
