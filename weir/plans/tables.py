"""The parquet tables in the layouts the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions.times import epoch_ms
from weir.session import configure

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Layouts are fixed, so no job runs to infer one from file footers."""
    return configure(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id`` is the arrival order, ``ts_ms`` the event time, ``cents`` the
    value as a whole number (sums of integers do not depend on their order), ``k``
    the number inside ``props``. Unused columns are pruned from the scan."""
    rows = table(spark, sf_dir, "events")
    return rows.select(
        "event_id",
        "user_id",
        "event_type",
        epoch_ms(F.col("ts")).alias("ts_ms"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.from_json("props", "k INT")["k"].alias("k"),
        "props",
    )


def events_of(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == event_type)


def shuffled_arrival(rows: DataFrame) -> DataFrame:
    """An arrival order in which every 7th event comes 50 places late; ties go by
    ``event_id``. The tables themselves hold no late event."""
    delay = F.when(F.col("event_id") % 7 == 0, 50).otherwise(0)
    return rows.withColumn("arrival", F.col("event_id") + delay)


def as_lines(rows: DataFrame, *fields: str) -> DataFrame:
    """Comma lines as they would be typed into a text source."""
    text = F.concat_ws(",", *[F.col(f).cast("string") for f in fields])
    return rows.select(text.alias("value"))
