"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.session import ensure_checkpoint_dir

#: A word is a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as BIGINT; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_key(*columns: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that identify a row by content; NULLs are told apart from
    values, and equal rows share a key (their results are equal, too)."""
    parts = [p for c in columns for p in (c.isNull(), c)]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *reversed(parts))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once. Inside a lambda, a plain column
    expression would be computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task; it keeps one such thing."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = build()
    return _KEPT[key]


def forget() -> None:
    """Let go what this worker keeps for another operator's tasks, as it outlives their
    stage, and what Arrow has not given back."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared checkpoint folder and read them back: lineage ends
    there, so a lost executor does not cost the work before."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
