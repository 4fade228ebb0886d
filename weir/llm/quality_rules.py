"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown on a bounded, deterministic sample of labelled documents, with
monotonic constraints on chosen features, and flattened into complete node arrays:
scoring a batch walks all its rows down a tree level by level with numpy indexing.

Sample: at most ``MAX_LABELLED`` labels, those with the smallest hash of the document
id. Everything else (statistics, scores) covers every document and whole texts.

Defined cases: NULL or empty text has no words and fails the base rules; repeated
rows are judged alike, one row each; of repeated labels of one document the lowest
counts; NULL labels or ids are left out; without labels of both classes only the base
rules decide; an empty table gives an empty result. Other columns are never read, so
their names may clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import forget
from weir.llm.text_stats import BASE, FEATURES, describe_all

MAX_LABELLED = 20_000
MIN_WORDS = 50

#: A rise in these may only lower the score.
FALLING = ("symbol_share", "dup_line_share", "repeat_share", "bang_share", "top_word_share")

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
    "score double, kept boolean"
)


@dataclass
class Trees:
    """Complete binary trees of one depth: node j has the children 2j+1 and 2j+2."""

    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # (trees, inner nodes): a value <= cut goes left
    value: np.ndarray  # (trees, leaves)
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        inner = self.feature.shape[1]
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    signs: np.ndarray,
    *,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    smooth: float = 5.0,
    least: int = 10,
) -> Trees:
    """Logistic boosting on quantile bins. ``signs`` holds +1, -1 or 0 per feature:
    the direction the score may move in. A split against it is not taken, and the
    middle of a constrained split's child values bounds both subtrees, so that the
    constraint holds across the whole tree."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    codes = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], 1)
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    features = np.zeros((trees, inner), np.int64)
    cuts = np.full((trees, inner), np.inf)
    values = np.zeros((trees, leaves))
    raw = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for j in range(inner):
            low, high = bounds[j]
            bounds[2 * j + 1] = bounds[2 * j + 2] = (low, high)
            at = np.flatnonzero(node == j)
            best = _split(codes[at], g[at], h[at], edges, signs, low, high, smooth, least)
            if best is None:
                node[at] = 2 * j + 1
                continue
            f, b, left, right = best
            features[t, j], cuts[t, j] = f, edges[f][b]
            node[at] = 2 * j + 1 + (codes[at, f] > b)
            middle = (left + right) / 2
            if signs[f] > 0:
                bounds[2 * j + 1], bounds[2 * j + 2] = (low, middle), (middle, high)
            elif signs[f] < 0:
                bounds[2 * j + 1], bounds[2 * j + 2] = (middle, high), (low, middle)
        leaf = node - inner
        sum_g = np.bincount(leaf, g, leaves)
        sum_h = np.bincount(leaf, h, leaves)
        low = np.array([bounds[inner + k][0] for k in range(leaves)])
        high = np.array([bounds[inner + k][1] for k in range(leaves)])
        values[t] = rate * np.clip(sum_g / (sum_h + smooth), low, high)
        raw += values[t][leaf]
    return Trees(features, cuts, values, base)


def _split(codes, g, h, edges, signs, low, high, smooth, least):
    """Best (feature, bin, left value, right value), or None."""
    if len(codes) < 2 * least:
        return None
    best, gain = None, 1e-9
    all_g, all_h = g.sum(), h.sum()
    whole = all_g**2 / (all_h + smooth)
    for f, cuts in enumerate(edges):
        width = len(cuts) + 1
        if width < 2:
            continue
        left_g = np.cumsum(np.bincount(codes[:, f], g, width))[:-1]
        left_h = np.cumsum(np.bincount(codes[:, f], h, width))[:-1]
        left_n = np.cumsum(np.bincount(codes[:, f], minlength=width))[:-1]
        left = np.clip(left_g / (left_h + smooth), low, high)
        right = np.clip((all_g - left_g) / (all_h - left_h + smooth), low, high)
        gains = left_g**2 / (left_h + smooth) + (all_g - left_g) ** 2 / (all_h - left_h + smooth)
        fits = (left_n >= least) & (len(codes) - left_n >= least) & (signs[f] * (right - left) >= 0)
        gains = np.where(fits, gains - whole, -1)
        b = int(gains.argmax())
        if gains[b] > gain:
            gain, best = gains[b], (f, b, left[b], right[b])
    return best


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_LABELLED
) -> tuple[np.ndarray, np.ndarray]:
    """Features and 0/1 labels of at most ``max_rows`` labelled documents, on the
    driver. The bound makes the broadcast and the collected rows small."""
    picked = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).alias("y"))
        .where("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg(F.min("y").cast("double").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    rows = texts.join(F.broadcast(picked), "id").select("id", "y", "text")

    def features(batches):
        for part in batches:
            forget()
            _, x = describe_all(part["text"])
            yield pd.DataFrame({"id": part["id"], "y": part["y"], "x": list(x)})

    found = rows.mapInPandas(features, "id bigint, y double, x array<double>")
    # a document may be there more than once; one row stands for each
    found = found.groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    frame = found.toPandas().sort_values("id")
    if frame.empty:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    return np.stack(frame["x"].to_numpy()), frame["y"].to_numpy()


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", **options) -> Trees | None:
    x, y = labelled_sample(docs, labels, label)
    if len(np.unique(y)) < 2:
        return None
    signs = np.array([-1 if name in FALLING else 0 for name in FEATURES])
    return fit_trees(x, (y > 0).astype(float), signs, **options)


def judge(docs: DataFrame, trees: Trees | None, threshold: float = 0.5) -> DataFrame:
    """One row per document: base counts, base verdict, score and verdict."""

    def run(batches):
        for part in batches:
            ids, texts = part.column("doc_id"), part.column("text").to_pylist()
            out = verdicts(texts, trees, threshold)
            forget()
            columns = [pa.array(out[name]) for name in out.columns]
            yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", *out.columns])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, SCHEMA)


def verdicts(texts, trees: Trees | None, threshold: float) -> pd.DataFrame:
    base, x = describe_all(texts)
    out = pd.DataFrame(base, columns=list(BASE))
    n, repeats = base[:, 0], base[:, 4]
    out["base_failed"] = (n < MIN_WORDS) | (100 * repeats > 50 * n)
    out["score"] = trees.score(x) if trees is not None else np.ones(len(out))
    out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
    return out


def keep_good(docs: DataFrame, trees: Trees | None, threshold: float = 0.5) -> DataFrame:
    """The documents that pass, with all their columns; row by row, no shuffle."""

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        forget()
        return verdicts(texts, trees, threshold)["kept"]

    return docs.where(kept(F.col("text")))
