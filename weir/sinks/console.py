"""Print records, each output under its label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def print_stream(rows: DataFrame, label: str | None = None) -> DataStreamWriter:
    shown = rows if label is None else labelled(rows, label)
    return shown.writeStream.format("console").option("truncate", "false")


def labelled(rows: DataFrame, label: str) -> DataFrame:
    text: Column = F.concat(F.lit(label), F.lit("> "), F.to_json(F.struct(*rows.columns)))
    return rows.select(text.alias("printed"))
