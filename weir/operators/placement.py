"""Where records go: by key, round robin, at random, by rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_key(rows: DataFrame, n: int, *keys: str | Column, spread: int = 1) -> DataFrame:
    """Hash placement. ``spread`` > 1 divides every key over that many random
    sub-keys, for keys too large for one partition."""
    if spread == 1:
        return rows.repartition(n, *keys)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(spread))
    return rows.repartition(n, *keys, salt)


def rebalance(rows: DataFrame, n: int) -> DataFrame:
    """Round robin: even partitions whatever the data."""
    return rows.repartition(n)


def shuffle_random(rows: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return rows.repartition(n, F.rand(seed))


def by_rule(rows: DataFrame, n: int, partition: Column, spread: int = 1) -> DataFrame:
    """Each record goes to the partition its expression names. With ``spread`` > 1
    every named place has that many partitions in a row, which its records share."""
    if spread == 1:
        return rows.repartitionById(n, partition)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(spread)).cast("int")
    return rows.repartitionById(n * spread, partition * spread + salt)


def first_letter_rule(text: Column) -> Column:
    """``a…`` → 1, ``b…`` → 2, anything else → 3."""
    return F.when(text.startswith("a"), 1).when(text.startswith("b"), 2).otherwise(3)
