"""Registered corpus queries against their SQL counterparts."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from conftest import SMALL_DIR

from weir.llm.queries import ORACLES, QUERIES


def _key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got = QUERIES[name](spark, SMALL_DIR)
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    expected = sorted(found.fetchall(), key=_key)
    assert sorted(map(tuple, got.select(*names).collect()), key=_key) == expected
