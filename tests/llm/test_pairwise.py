"""Pairwise ranking against plain Python: the fit pair by pair, the scores text by text."""

from __future__ import annotations

import bisect
import math
import zlib

import numpy as np
import pytest
from conftest import SMALL_DIR

from weir.llm import pairwise_quality, quality_rules
from weir.llm.common import read
from weir.llm.queries import QUERIES
from weir.llm.text_stats import describe_all


def indicators(edges, row):
    return [(j, bisect.bisect_left(list(e), row[j])) for j, e in enumerate(edges)]


def fit_by_pairs(edges, pairs, steps):
    """Gradient of the mean of log(1 + exp(-gap)) with a decay, one pair after the other."""
    weights, speed = {}, {}
    for _ in range(steps):
        pull = {}
        for better, worse in pairs:
            gap = sum(weights.get(k, 0.0) for k in better) - sum(weights.get(k, 0.0) for k in worse)
            slope = 1 / (1 + math.exp(gap))
            for k in better:
                pull[k] = pull.get(k, 0.0) + slope
            for k in worse:
                pull[k] = pull.get(k, 0.0) - slope
        for k in {*pull, *weights}:
            speed[k] = 0.9 * speed.get(k, 0.0) + pull.get(k, 0.0) / len(pairs) - 1e-3 * weights.get(k, 0.0)
        for k, v in speed.items():
            weights[k] = weights.get(k, 0.0) + 0.5 * v
    return weights


def test_fit_by_brute_force(monkeypatch):
    monkeypatch.setattr(pairwise_quality, "PAIRS", 200)
    draw = np.random.default_rng(1)
    x = draw.normal(size=(60, 3))
    x[:, 2] = np.round(x[:, 2])  # ties
    y = (x[:, 0] + 0.3 * draw.normal(size=60) > 0).astype(float)
    fitted = pairwise_quality.fit_ranking(x, y, steps=25, seed=3)
    again = np.random.default_rng(3)  # the same pairs
    better = again.choice(np.flatnonzero(y > 0), 200)
    worse = again.choice(np.flatnonzero(y <= 0), 200)
    marks = [indicators(fitted.edges, row) for row in x]
    weights = fit_by_pairs(fitted.edges, [(marks[a], marks[b]) for a, b in zip(better, worse)], 25)
    raw = np.array([sum(weights.get(k, 0.0) for k in m) for m in marks])
    assert np.allclose(fitted.raw(x), raw, atol=1e-9)
    # the share of label 0 lies under the cut
    assert (raw < fitted.cut).sum() == round((1 - y.mean()) * len(y))
    assert raw[y > 0].mean() > raw[y <= 0].mean()


def test_scores_by_brute_force(spark):
    docs, labels = read(spark, SMALL_DIR, "documents"), read(spark, SMALL_DIR, "labels")
    seen = labels.where(~pairwise_quality.held_out(labels["doc_id"]))
    fitted = pairwise_quality.learn(docs, seen)
    starts = np.cumsum([0, *[len(e) + 1 for e in fitted.edges[:-1]]])
    got = {r.doc_id: r for r in QUERIES["op2_pairwise_quality"](spark, SMALL_DIR).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        row = describe_all([text])[1][0]
        raw = sum(float(fitted.weights[starts[j] + b]) for j, b in indicators(fitted.edges, row))
        z = (raw - fitted.cut) / fitted.spread + math.log(0.7 / 0.3)
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        assert got[i].predicted == int(got[i].score >= 0.7)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_fit_on_all_rows_and_pairs(spark, monkeypatch):
    """Edges, weights and cut against plain Python over every labelled row and every pair."""
    monkeypatch.setattr(pairwise_quality, "STEPS", 3)
    draw = np.random.default_rng(5)
    texts = [" ".join(["word", "Word", "x1", "|", "a."][k] for k in draw.integers(0, 3 + i % 3, 5 + i % 41)) for i in range(150)]
    label = [int(i % 3 == 0) for i in range(150)]
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([*enumerate(label), (3, 0), (4, None), (None, 1)], "doc_id bigint, quality int")
    label[3] = 0  # the lowest of two
    monkeypatch.setattr(quality_rules, "MAX_LABELLED", 10)
    monkeypatch.setattr(pairwise_quality, "PAIRS", 10)
    fitted = pairwise_quality.learn(docs, labels)
    x = describe_all(texts)[1]
    for j, edges in enumerate(fitted.edges):
        for e in edges:  # some share of all rows is reached at the edge, not before it
            under, before = (x[:, j] <= e).sum(), (x[:, j] <= e * (1 - 2**-9) - 1e-12).sum()
            assert any(before < k * 150 / 24 <= under for k in range(1, 24))
    marks = [indicators(fitted.edges, row) for row in x]
    ones, zeros = ([i for i in range(150) if label[i] == v] for v in (1, 0))
    weights = fit_by_pairs(fitted.edges, [(marks[a], marks[b]) for a in ones for b in zeros], 3)
    exact = np.array([sum(weights.get(k, 0.0) for k in m) for m in marks])
    got = fitted.raw(x)
    assert np.abs(got - exact).max() < 15 * 2 / pairwise_quality.UNIT  # a weight is rounded in each step
    ordered = np.sort(got)
    assert fitted.cut == pytest.approx((ordered[len(zeros) - 1] + ordered[len(zeros)]) / 2)
    assert fitted.spread == pytest.approx(got.std())
    again = pairwise_quality.learn(docs.repartition(3), labels)
    assert (again.weights == fitted.weights).all() and again.cut == fitted.cut
