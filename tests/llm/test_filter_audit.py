"""The filter audit against counts by brute force; the query has SQL besides."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weir.llm import filter_audit

SCHEMA = "doc_id bigint, text string, lang string, part string, region int, n string"


def failing(rows):
    """(part, failing letters, id) of each row."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > least[text],
        }
        yield lang or "", {k for k, v in fails.items() if v}, i


def naive(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs, out, shapley = list(failing(rows)), {}, Counter()
    for part in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(removed)
                out[part, "".join(order), step] = [
                    len(left),
                    len(removed),
                    sum(f in d[1] for d in here) - len(removed),
                    sum(d[1] == {f} for d in here),
                    sum(d[2] in good for d in removed),
                    sum(d[2] in toxic for d in removed),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    said = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(docs, said, filter_audit.text_filters(F.col("text")))
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()}


def test_edges_by_brute_force(spark):
    words = " ".join(f"w{i}" for i in range(120))
    rows = [(i, words + (" #" if i % 3 == 0 else ""), ["en", "de", None, ""][i % 4]) for i in range(60)]
    rows += [(100 + i, None, "en") for i in range(5)] + [(200 + i, "", "de") for i in range(5)]
    rows += [(300, "UP " * 200, "en")] * 3  # repeated rows
    rows += [(301, "UP " * 200, "en"), (301, "up " * 90, None), (301, "a b", None)]  # one id, three texts
    rows += [(None, words, "en"), (None, "new", "en"), (None, "new", "en")]
    rows += [(400, "x " * 200_000, "fr"), (401, "ÄÖÜ" * 100_000, "fr")]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 60, 2)] + [(300, 1, 1), (301, 0, 1), (301, 1, None), (None, 1, 1), (9999, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    assert audited(spark, rows, labels) == naive(rows, labels)


def test_hot_text_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "STRETCH", 3)
    rows = [(i, "same text" if i % 3 else f"text {i}", f"l{i % 7}") for i in range(2000)]
    assert audited(spark, rows, [(i, 1, 0) for i in range(0, 2000, 5)]) == naive(rows, [(i, 1, 0) for i in range(0, 2000, 5)])


def test_empty_tables(spark):
    assert audited(spark, [], []) == {}
    rows = [(1, "a", "en")]
    assert audited(spark, rows, []) == naive(rows, [])


def test_tasks_flush_ranges():
    """A task that holds many ranges gives the same sums as one that holds one."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n = 5000
    ids = np.sort(rng.integers(0, 3000, n))
    rows = []
    for i in ids.tolist():
        h = int(rng.integers(0, 2))
        rows.append((i, h, h, True, f"p{i % 3}", int(rng.integers(0, 16)), 1))
    rows += [(i, 0, 0, False, None, None, None) for i in range(0, 3000, 2)]
    rows.sort(key=lambda r: r[:4])
    names = ["id", "h1", "h2", "entry", "part", "bits", "n"]
    types = [pa.int64()] * 3 + [pa.bool_(), pa.string(), pa.int32(), pa.int64()]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def sums(size, batch):
        held, filter_audit.RANGE = filter_audit.RANGE, size
        try:
            total = Counter()
            for out in filter_audit._count_regions([4], 5)(iter(table.to_batches(batch))):
                for p, r, c in zip(*(out.column(i).to_pylist() for i in range(3))):
                    total[p, r] += c
            return total
        finally:
            filter_audit.RANGE = held

    firsts = {(r[0], r[1]) for r in rows if not r[3]}
    expected = Counter()
    for r in rows:
        if r[3]:
            expected[r[4], r[5] | (16 if (r[0], r[1]) not in firsts else 0)] += 1
    assert sums(1 << 18, 10_000) == sums(64, 17) == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 60)), min_size=1, max_size=5), st.integers(1, 5))
def test_merge_and_gallop(sets, stretch):
    held, filter_audit.STRETCH = filter_audit.STRETCH, stretch
    try:
        lists = [np.array(sorted(s), np.int64) for s in sets]
        got = {i: r for ids, regions in filter_audit.merge(lists) for i, r in zip(ids.tolist(), regions.tolist())}
        assert got == {i: sum(1 << k for k, s in enumerate(sets) if i in s) for i in set().union(*sets)}
        kept = filter_audit.without(lists[0], lists[-1]).tolist()
        assert kept == sorted(sets[0] - sets[-1])
    finally:
        filter_audit.STRETCH = held
    for ids in lists:
        for key in range(-1, 62, 7):
            if len(ids):
                assert filter_audit.gallop(ids, 0, key) == int(np.searchsorted(ids, key, "right"))
