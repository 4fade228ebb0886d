"""Several outputs from one pass over each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from weir.operators.records import tagged_outputs


class RoutedFiles:
    """Side outputs as folders ``output=<name>`` under ``path``, one per name, each
    with a version per micro-batch that a replay overwrites."""

    def __init__(self, path: str, column: str = "value"):
        self.path, self.column = path, column

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        tagged = tagged_outputs(batch, self.column)
        target = f"{self.path}/batch_id={batch_id}"
        tagged.write.mode("overwrite").partitionBy("output").parquet(target)


def write_routes(rows: DataFrame, path: str, column: str = "value") -> DataStreamWriter:
    return rows.writeStream.foreachBatch(RoutedFiles(path, column))
