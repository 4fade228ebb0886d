"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry_module
from conftest import SMALL_DIR
from weir.plans.catalog import QUERIES

BUILT = {}


def plan_of(spark, name) -> list[str]:
    if name not in BUILT:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            QUERIES[name](spark, SMALL_DIR).explain()
        BUILT[name] = out.getvalue().splitlines()
    return BUILT[name]


def depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_row_python(spark, name):
    text = "\n".join(plan_of(spark, name))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert "ArrowEvalPython" not in text or name == "flat_map_fn"
    assert "collect_list" not in text and "collect_set" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_only_summaries_reach_a_single_partition(spark, name):
    """Below a one-partition exchange there is an aggregate before any scan."""
    lines = plan_of(spark, name)
    for index, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        child = lines[index + 1]
        assert re.search(r"(Hash|Sort)Aggregate|Window|LocalLimit", child), child
        below = [l for l in lines[index + 1 :] if depth(l) > depth(line)]
        assert any("Aggregate" in l for l in below)


def test_window_sums_combine_before_the_shuffle(spark):
    for name in ("tumble_sum", "session_sum", "slide_sum", "window_all_sum", "word_count"):
        text = "\n".join(plan_of(spark, name))
        first_shuffle = text.rindex("Exchange hashpartitioning")
        assert "partial_" in text[first_shuffle:]


def test_top_n_is_cut_before_the_shuffle(spark):
    text = "\n".join(plan_of(spark, "window_top3"))
    assert text.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    scans = [l for l in plan_of(spark, "count_window_sum") if "FileScan" in l]
    assert scans
    for scan in scans:
        schema = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
        columns = {c.split(":")[0] for c in schema.split(",")}
        assert columns <= {"event_id", "value"}


def row_shuffles(lines: list[str]) -> list[int]:
    """Shuffles with no aggregate between them and the rows they carry."""
    found = []
    for i, line in enumerate(lines):
        if not re.search(r"Exchange (hash|range)partitioning", line) or "Reused" in line:
            continue
        below = []
        for other in lines[i + 1 :]:
            if depth(other) <= depth(line) or "Exchange" in other:
                break
            below.append(other)
        if not any("Aggregate" in l for l in below):
            found.append(i)
    return found


@pytest.mark.parametrize("name", ["running_sum", "value_state_total", "income_province_city", "ad_pv_uv_running", "retract_changelog", "late_window_sum"])
def test_scans_shuffle_rows_once(spark, name):
    """Whether keys are heavy (the second and third) or not, only aggregates pass the
    other exchanges; see test_scan.py for how many rows these have."""
    assert len(row_shuffles(plan_of(spark, name))) == 1, plan_of(spark, name)


def test_light_keys_are_plain_windows(spark):
    lines = plan_of(spark, "running_sum")
    assert sum("Exchange" in l for l in lines) == 1
    assert not any("Join" in l for l in lines)


def test_sessions_are_not_ordered_per_key(spark):
    """Slots are ordered by (key, block); only the ends of blocks by key."""
    lines = plan_of(spark, "session_sum")
    windows = [l for l in lines if re.search(r"[-:] Window ", l)]
    assert any("_block" in l.split("],")[-2] for l in windows)


def test_functions_of_windows_share_one_shuffle(spark):
    for name in ("cogroup_fn", "window_apply_fn"):
        text = "\n".join(plan_of(spark, name))
        assert text.count("Exchange") == 1 and "MapInArrow" in text
        assert "InPandas" not in text


def test_contract(spark):
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
