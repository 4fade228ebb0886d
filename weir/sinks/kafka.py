"""Kafka sink. Spark's Kafka writer delivers at least once; records therefore carry
a stable id as key, by which readers can drop repeats. The file sink is the one
with exactly-once results. Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def sink_options(
    servers: list[str], topic: str, transaction_timeout_ms: int = 60_000
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": ",".join(servers),
        "topic": topic,
        "kafka.transaction.timeout.ms": str(transaction_timeout_ms),
    }


def as_records(rows: DataFrame, value: str = "value", record_id: str | None = None) -> DataFrame:
    """Key and UTF-8 value; without an id column the key is a digest of the value."""
    text = F.col(value).cast("string")
    key = F.sha2(text, 256) if record_id is None else F.col(record_id).cast("string")
    return rows.select(
        F.encode(key, "UTF-8").alias("key"), F.encode(text, "UTF-8").alias("value")
    )


def write_topic(rows: DataFrame, options: dict[str, str], **columns: str) -> DataStreamWriter:
    return as_records(rows, **columns).writeStream.format("kafka").options(**options)
