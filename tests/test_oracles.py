"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import SF_DIR
from weir.plans.catalog import QUERIES
from weir.plans.oracles import ORACLES

TABLES = ["region", "nation", "customer", "supplier", "events", "documents"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def canonical(rows):
    def cell(value):
        if isinstance(value, float) and math.isfinite(value):
            return f"{value:.6f}"
        return str(value)

    return sorted(tuple(cell(v) for v in row) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = canonical(frame.select(*columns).collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = canonical([tuple(row[i] for i in order) for row in cursor.fetchall()])
    assert got == expected


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
