"""Number sources: a finite sequence and an endless ticker."""

from __future__ import annotations

import time
from collections.abc import Iterator
from hashlib import blake2b

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamReader,
    InputPartition,
    SimpleDataSourceStreamReader,
)
from pyspark.sql.types import StructType


def sequence(spark: SparkSession, count: int = 100) -> DataFrame:
    """0 … count-1 in one partition, as ``n``."""
    return spark.range(0, count, 1, 1).select(F.col("id").cast("int").alias("n"))


class SequenceSource(DataSource):
    """``format("weir_sequence")``: 0 … ``count``-1 in order, ``slice`` per batch."""

    @classmethod
    def name(cls) -> str:
        return "weir_sequence"

    def schema(self) -> str:
        return "n INT"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _SequenceReader(
            int(self.options.get("count", "100")), int(self.options.get("slice", "50"))
        )


class _SequenceReader(SimpleDataSourceStreamReader):
    def __init__(self, count: int, slice_size: int):
        self.count, self.slice_size = count, slice_size

    def initialOffset(self) -> dict:
        return {"next": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = min(start["next"] + self.slice_size, self.count)
        return self.readBetweenOffsets(start, {"next": end}), {"next": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(n,) for n in range(start["next"], end["next"])])


class TickerSource(DataSource):
    """``format("weir_ticker")``: every ``interval`` seconds, each of ``parallelism``
    instances emits ``"<instance> --> <number below 100>"``.

    Numbers are a hash of seed, instance and tick: a replayed batch repeats them.
    """

    @classmethod
    def name(cls) -> str:
        return "weir_ticker"

    def schema(self) -> str:
        return "value STRING"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _TickerReader(self.options)


class _Ticks(InputPartition):
    def __init__(self, instance: int, start: int, end: int):
        self.instance, self.start, self.end = instance, start, end


class _TickerReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.parallelism = int(options.get("parallelism", "2"))
        self.interval = float(options.get("interval", "2"))
        self.seed = int(options.get("seed", "42"))

    def _tick(self) -> int:
        return int(time.time() / self.interval)

    def initialOffset(self) -> dict:
        return {"tick": self._tick()}

    def latestOffset(self) -> dict:
        return {"tick": self._tick()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["tick"] <= start["tick"]:
            return []
        return [_Ticks(i, start["tick"], end["tick"]) for i in range(self.parallelism)]

    def read(self, partition: _Ticks) -> Iterator[tuple]:
        for tick in range(partition.start, partition.end):
            name = f"{self.seed}:{partition.instance}:{tick}".encode()
            number = int.from_bytes(blake2b(name, digest_size=8).digest()) % 100
            yield (f"{partition.instance} --> {number}",)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SequenceSource)
    spark.dataSource.register(TickerSource)
