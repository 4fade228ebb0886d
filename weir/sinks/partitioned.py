"""Sink that knows which instance it is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import DataStreamWriter


class InstanceWriter:
    """Calls ``write(instance, epoch, record)`` per record; ``open`` and ``close`` may
    be given to hold a connection for the records of one partition and epoch."""

    def __init__(self, write: Callable[[int, int, Row], None]):
        self.write = write

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.instance, self.epoch = partition_id, epoch_id
        return True

    def process(self, row: Row) -> None:
        self.write(self.instance, self.epoch, row)

    def close(self, error: Exception | None) -> None:
        pass


def foreach_instance(
    rows: DataFrame, write: Callable[[int, int, Row], None]
) -> DataStreamWriter:
    return rows.writeStream.foreach(InstanceWriter(write))
