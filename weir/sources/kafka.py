"""Kafka topic as a stream of text values. Needs the Spark Kafka connector on the
class path; offsets live in the query's checkpoint and are not committed to the
broker, so there is no auto-commit to switch off."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: list[str],
    topic: str,
    group: str | None = None,
    starting: str = "earliest",
    read_committed: bool = False,
    max_offsets: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": ",".join(servers),
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group is not None:
        options["kafka.group.id"] = group
    if read_committed:
        options["kafka.isolation.level"] = "read_committed"
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    rows = spark.readStream.format("kafka").options(**options).load()
    return rows.selectExpr("CAST(value AS STRING) AS value")
