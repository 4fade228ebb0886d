"""Quality classifier: Bradley-Terry pairwise ranking.

A document's score is linear in features of its text. It is learned from preference
pairs (a document labelled 1 is preferred to one labelled 0) by logistic loss on the
difference of the two feature vectors, so only the order of scores matters to the
fit. A cut is then set at a quantile of the scores: the share of label 0 among the
training rows falls below it. Reported scores are logistic in the distance from the
cut, which lies at ``cut_score``.

Features are the text statistics of ``text_stats``, each cut into quantile bins
(one indicator a bin): additive, but free in shape. Whole texts are read; labels,
language, source and id are no inputs.

All labelled documents and all their pairs are used; nothing is drawn. The bins' edges are
values of a fine grid at which exact counts of rows reach the quantiles. While it is fitted,
a score is a multiple of 1 / ``UNIT``, so each step counts the scores of both labels over
all rows; these counts give the slope that a row gets from all rows of the other label, and
a second pass sums slopes by indicator. Both sums are of whole numbers, so reruns agree. The
driver holds the edges, the weights and the counts by score, whose sizes don't follow the
rows. ``fit_ranking`` fits arrays in memory on ``PAIRS`` pairs drawn with a seed; ``learn``
doesn't use it.

Defined cases: NULL text is as empty, and both get a score like any other text;
repeated rows score alike; of repeated labels of one document the lowest counts, NULL labels
or ids are left out; without both labels every score is the share of label 1
(0.5 without labels); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import stored
from weir.llm.text_stats import FEATURES, describe_all

PAIRS = 60_000
BINS = 24
STEPS = 24
#: Scores to one: weights are rounded to it.
UNIT = 256
#: Edges are values of 10 binary digits; slopes are summed with 20.
GRID, SLOPE = 2.0**10, 2.0**20
SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"


@dataclass
class Ranking:
    edges: list[np.ndarray]
    weights: np.ndarray
    cut: float
    spread: float
    cut_score: float
    constant: float | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[_codes(self.edges, x)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        shift = np.log(self.cut_score / (1 - self.cut_score))
        z = np.clip((self.raw(x) - self.cut) / self.spread + shift, -500, 500)
        return 1 / (1 + np.exp(-z))


def _starts(edges: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *[len(e) + 1 for e in edges[:-1]]])


def _codes(edges: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Index of the indicator that is 1, for each row and feature."""
    bins = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]
    return np.stack(bins, 1) + _starts(edges)


def fit_ranking(
    x: np.ndarray, y: np.ndarray, *, cut_score: float = 0.7, steps: int = 300, seed: int = 7
) -> Ranking:
    """Full-batch gradient steps with momentum on the pairs."""
    if len(np.unique(y)) < 2:
        constant = float(y.mean()) if len(y) else 0.5
        return Ranking([], np.zeros(0), 0.0, 1.0, cut_score, constant)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    codes = _codes(edges, x)
    size = sum(len(e) + 1 for e in edges)
    draw = np.random.default_rng(seed)
    better = codes[draw.choice(np.flatnonzero(y > 0), PAIRS)]
    worse = codes[draw.choice(np.flatnonzero(y <= 0), PAIRS)]
    weights, speed = np.zeros(size), np.zeros(size)
    for _ in range(steps):
        gap = weights[better].sum(1) - weights[worse].sum(1)
        slope = 1 / (1 + np.exp(np.clip(gap, -500, 500)))
        pull = np.zeros(size)
        for j in range(codes.shape[1]):
            pull += np.bincount(better[:, j], slope, size) - np.bincount(worse[:, j], slope, size)
        speed = 0.9 * speed + pull / PAIRS - 1e-3 * weights
        weights = weights + 0.5 * speed
    raw = weights[codes].sum(1)
    cut = _gap_at(np.sort(raw), 1 - float((y > 0).mean()))
    return Ranking(edges, weights, cut, max(float(raw.std()), 1e-9), cut_score)


def _gap_at(values: np.ndarray, share: float) -> float:
    """The quantile, in the middle of the two neighbouring scores."""
    k = min(max(round(share * len(values)), 1), len(values) - 1)
    return float((values[k - 1] + values[k]) / 2)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking:
    """Fit on all pairs of labelled documents, 1 against 0."""
    spark = docs.sparkSession
    rows = stored(spark, labelled(docs, labels, label), "pairwise-labelled")
    per = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(per) < 2:
        return Ranking([], np.zeros(0), 0.0, 1.0, 0.7, float(next(iter(per), 0.5)))
    edges = _edges(rows)
    coded = stored(spark, _coded(rows, edges), "pairwise-coded")
    size = sum(len(e) + 1 for e in edges)
    weights, speed = np.zeros(size), np.zeros(size)
    for _ in range(STEPS):
        whole = np.rint(weights * UNIT).astype(np.int64)
        pull = _pull(coded, edges, whole, *_slopes(_counts(coded, edges, whole)))
        speed = 0.9 * speed + pull - 1e-3 * weights
        weights = weights + 0.5 * speed
    whole = np.rint(weights * UNIT).astype(np.int64)
    counts = _counts(coded, edges, whole)
    values, n = counts["score"].to_numpy() / UNIT, counts["n"].to_numpy()
    order = np.argsort(values, kind="stable")
    values, n = values[order], n[order]
    below, total = np.cumsum(n), int(n.sum())
    k = min(max(per[False], 1), total - 1)  # the share of label 0, as a number of rows
    cut = (values[np.searchsorted(below, k)] + values[np.searchsorted(below, k + 1)]) / 2
    mean = float((values * n).sum() / total)
    spread = float((((values - mean) ** 2) * n).sum() / total) ** 0.5
    return Ranking(edges, whole / UNIT, float(cut), max(spread, 1e-9), 0.7)


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(id, y, x): every labelled document once. Features are shuffled, not texts."""
    wanted = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).alias("y"))
        .where("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg((F.min("y") > 0).alias("y"))
    )

    def features(batches):
        for part in batches:
            x = describe_all(part.column("text").to_pylist())[1]
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "x"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").where("id IS NOT NULL")
    found = texts.mapInArrow(features, "id bigint, x array<double>").join(wanted, "id")
    # a document may be there more than once; one row stands for each
    return found.groupBy("id").agg(F.first("y").alias("y"), F.min("x").alias("x"))


def _matrix(part: pa.RecordBatch) -> np.ndarray:
    return part.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))


def _edges(rows: DataFrame) -> list[np.ndarray]:
    """For each feature, the smallest grid values that the shares of all rows lie under."""

    def count(batches):
        for part in batches:
            m, e = np.frexp(_matrix(part))
            up = np.ldexp(np.ceil(m * GRID) / GRID, e)
            for j in range(up.shape[1]):
                value, n = np.unique(up[:, j], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), j, np.int32)), pa.array(value), pa.array(n.astype(np.int64))],
                    ["feature", "value", "n"],
                )

    found = rows.select("x").mapInArrow(count, "feature int, value double, n bigint")
    counts = found.groupBy("feature", "value").agg(F.sum("n").alias("n")).toPandas().sort_values(["feature", "value"])
    edges = []
    for j in range(len(FEATURES)):
        of = counts[counts["feature"] == j]
        below = of["n"].cumsum().to_numpy()
        at = np.searchsorted(below, np.arange(1, BINS) * below[-1] / BINS)
        edges.append(np.unique(of["value"].to_numpy()[at]))
    return edges


def _coded(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """(y, bins): a byte for the bin of each feature."""
    starts = _starts(edges)

    def run(batches):
        for part in batches:
            bins = (_codes(edges, _matrix(part)) - starts).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.array([b.tobytes() for b in bins], pa.binary())], ["y", "bins"])

    return rows.select("y", "x").mapInArrow(run, "y boolean, bins binary")


def _read(part: pa.RecordBatch, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(part.column("bins").to_pylist()), np.uint8).reshape(-1, len(starts))
    return part.column("y").to_numpy(zero_copy_only=False).astype(bool), codes + starts


def _counts(coded: DataFrame, edges: list[np.ndarray], whole: np.ndarray):
    """Rows by label and score, as pandas, sorted."""
    starts = _starts(edges)

    def run(batches):
        for part in batches:
            y, codes = _read(part, starts)
            score = whole[codes].sum(1)
            for label in (False, True):
                value, n = np.unique(score[y == label], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), label)), pa.array(value), pa.array(n.astype(np.int64))], ["y", "score", "n"]
                )

    found = coded.mapInArrow(run, "y boolean, score bigint, n bigint")
    return found.groupBy("y", "score").agg(F.sum("n").alias("n")).toPandas().sort_values(["y", "score"])


def _slopes(counts) -> tuple:
    """Scores and slopes of the rows labelled 1 and of those labelled 0: the mean, over all
    rows of the other label, of the chance that the fit gives to the wrong order."""
    one, zero = counts[counts["y"]], counts[~counts["y"]]
    s1, n1, s0, n0 = (t[c].to_numpy() for t in (one, zero) for c in ("score", "n"))
    of_one, of_zero = np.zeros(len(s1)), np.zeros(len(s0))
    for at in range(0, len(s1), 256):
        gap = (s1[at : at + 256, None] - s0) / UNIT
        wrong = 1 / (1 + np.exp(np.clip(gap, -500, 500)))
        of_one[at : at + 256] = wrong @ n0 / n0.sum()
        of_zero += n1[at : at + 256] @ wrong / n1.sum()
    return s1, n1.sum(), of_one, s0, n0.sum(), of_zero


def _pull(coded: DataFrame, edges: list[np.ndarray], whole: np.ndarray, s1, n1, of_one, s0, n0, of_zero) -> np.ndarray:
    """Gradient of the mean over all pairs of log(1 + exp(-gap)), downwards."""
    starts, size = _starts(edges), len(whole)
    tables = ((True, s1, np.rint(of_one * SLOPE)), (False, s0, np.rint(of_zero * SLOPE)))

    def run(batches):
        for part in batches:
            y, codes = _read(part, starts)
            score = whole[codes].sum(1)
            for label, scores, slopes in tables:
                mine = y == label
                slope = slopes[np.searchsorted(scores, score[mine])]
                total = np.bincount(codes[mine].ravel(), np.repeat(slope, len(starts)), size)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), label)), pa.array(at), pa.array(total[at].astype(np.int64))], ["y", "at", "total"]
                )

    found = coded.mapInArrow(run, "y boolean, at bigint, total bigint").groupBy("y", "at").agg(F.sum("total").alias("total"))
    pull = np.zeros(size)
    for r in found.orderBy("y", "at").collect():
        pull[r["at"]] += r["total"] / SLOPE / (n1 if r["y"] else -n0)
    return pull


def held_out(doc_id) -> "F.Column":
    """Rows that the fit must not see: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def rank(docs: DataFrame, ranking: Ranking) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )

    def run(batches):
        for part in batches:
            scores = ranking.score(describe_all(part.column("text").to_pylist())[1])
            predicted = (scores >= ranking.cut_score).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(scores), pa.array(predicted)],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(run, SCHEMA)
