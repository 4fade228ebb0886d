"""Character Markov models as DataFrames.

A model of order two over a fixed alphabet of A symbols has A^3 cells (two symbols of
context and the next one). Counts are gathered over all given texts; probabilities
are smoothed by Witten-Bell, so that the order used varies with what was seen: a
known context of two symbols dominates, an unknown one leaves the word to the context
of one symbol, then to single symbols. Two models become one array of log-likelihood
ratios, whose length A^3 is fixed by the alphabet; it is handed to tasks as a scalar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weir.llm.common import let, stored


def cells(text: Column, alphabet: str) -> Column:
    """Cell index of every character; characters outside the alphabet share symbol 0,
    the start is a symbol of its own."""
    width = len(alphabet) + 2
    chars = F.when(F.length(text) > 0, F.split(text, "")).otherwise(F.array().cast("array<string>"))
    codes = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c))
    start = F.lit(width - 1)

    def joined(codes: Column) -> Column:
        return F.transform(
            codes,
            lambda c, i: (
                F.when(i >= 2, F.get(codes, i - 2)).otherwise(start) * (width * width)
                + F.when(i >= 1, F.get(codes, i - 1)).otherwise(start) * width
                + c
            ),
        )

    return let(codes, joined)


def count_cells(samples: DataFrame) -> DataFrame:
    """(cell, pos, neg) from rows (cells, positive): occurrences in either class."""
    each = samples.select(F.explode("cells").alias("cell"), "positive")
    return each.groupBy("cell").agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    )


def ratios(spark: SparkSession, counts: DataFrame, alphabet: str) -> DataFrame:
    """One row with ``model``: array of log P(positive) - log P(negative) by cell."""
    a = len(alphabet) + 2
    counts = stored(spark, counts, "markov-counts")  # used several times below
    dense = spark.range(a**3).select(F.col("id").cast("int").alias("cell"))
    dense = dense.join(counts, "cell", "left").na.fill(0, ["pos", "neg"])
    dense = dense.select(
        "cell",
        (F.col("cell") % a).alias("c"),
        F.expr(f"cell div {a} % {a}").cast("int").alias("b"),
        F.expr(f"cell div {a}").cast("int").alias("ab"),
        "pos",
        "neg",
    )

    def totals(rows: DataFrame, keys: list[str], suffix: str) -> DataFrame:
        sums = [F.sum(x).alias(f"{x}_{suffix}") for x in ("pos", "neg")]
        kinds = [F.count_if(F.col(x) > 0).alias(f"kinds_{x}_{suffix}") for x in ("pos", "neg")]
        return rows.groupBy(*keys).agg(*sums, *kinds)

    pairs = dense.groupBy("b", "c").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    singles = pairs.groupBy("c").agg(F.sum("pos").alias("pos_c"), F.sum("neg").alias("neg_c"))
    everything = singles.agg(F.sum("pos_c").alias("pos_all"), F.sum("neg_c").alias("neg_all"))
    table = (
        dense.join(totals(dense, ["ab"], "ab"), "ab")
        .join(pairs.select("b", "c", F.col("pos").alias("pos_bc"), F.col("neg").alias("neg_bc")), ["b", "c"])
        .join(totals(pairs, ["b"], "b"), "b")
        .join(singles, "c")
        .withColumn("one", F.lit(1))
        .join(everything.withColumn("one", F.lit(1)), "one")
    )

    def log_p(x: str) -> Column:
        p0 = (F.col(f"{x}_c") + 1) / (F.col(f"{x}_all") + a)
        t1 = F.col(f"kinds_{x}_b")
        p1 = F.when(t1 > 0, (F.col(f"{x}_bc") + t1 * p0) / (F.col(f"{x}_b") + t1)).otherwise(p0)
        t2 = F.col(f"kinds_{x}_ab")
        p2 = F.when(t2 > 0, (F.col(x) + t2 * p1) / (F.col(f"{x}_ab") + t2)).otherwise(p1)
        return F.log(p2)

    scored = table.select("cell", (log_p("pos") - log_p("neg")).alias("ratio"))
    packed = F.sort_array(F.collect_list(F.struct("cell", "ratio")))
    return scored.agg(F.transform(packed, lambda x: x["ratio"]).alias("model"))


def _half(cell_list: Column) -> Column:
    return F.pmod(F.xxhash64(cell_list), F.lit(2))


def score(cell_list: Column, even: Column, odd: Column) -> Column:
    """Log-likelihood ratio per character, 0 if empty, by the model that learned from
    the half of the samples which texts like this one are not in."""
    given = F.struct(cell_list.alias("cells"), (_half(cell_list) == 0).alias("first"))

    def rated(g: Column) -> Column:
        def step(acc, cell):
            return acc + F.when(g["first"], F.get(odd, cell)).otherwise(F.get(even, cell))

        n = F.size(g["cells"])
        return F.when(n > 0, F.aggregate(g["cells"], F.lit(0.0), step) / n).otherwise(0.0)

    return let(given, rated)


def with_models(rows: DataFrame, models: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Add ``__even`` and ``__odd``. A model is one row of fixed length, which reaches
    the tasks as a scalar."""
    return rows.withColumns({"__even": models[0].scalar(), "__odd": models[1].scalar()})


def with_score(rows: DataFrame, models: tuple[DataFrame, DataFrame]) -> DataFrame:
    rated = score(F.col("cells"), F.col("__even"), F.col("__odd"))
    return with_models(rows, models).withColumn("score", rated).drop("__even", "__odd")


def learn(
    samples: DataFrame, alphabet: str, empty_cut: float = 0.0
) -> tuple[tuple[DataFrame, DataFrame], DataFrame]:
    """Two models and a cut from rows (cells, positive). Each model learns from one half
    of the samples (by hash, so that equal ones stay together) and rates the other, as
    a model rates what it has seen by the label it saw; the cut is calibrated on these
    ratings of all samples."""
    spark = samples.sparkSession
    models = tuple(
        stored(spark, ratios(spark, count_cells(samples.where(_half(F.col("cells")) == half)), alphabet), "markov-model")
        for half in (0, 1)
    )
    cut = stored(spark, best_cut(with_score(samples, models), empty_cut=empty_cut), "markov-cut")
    return models, cut


def best_cut(scored: DataFrame, bins: int = 200, empty_cut: float = 0.0) -> DataFrame:
    """One row with ``cut``: where the shares of positive samples at or above and of
    negative ones below add up to most, in the middle of the gap between the two
    scores next to it. Scores are binned on [-10, 10], so at most ``20 * bins`` rows
    are ordered; ``empty_cut`` without samples of both classes."""
    clipped = F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.col("score")))
    hist = scored.groupBy(F.floor(clipped * bins).alias("bin")).agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    )
    order = Window.orderBy("bin")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()

    def share_below(name: str) -> Column:
        return F.coalesce(F.sum(name).over(before), F.lit(0)) / F.sum(name).over(every)

    both = (F.sum("neg").over(every) > 0) & (F.sum("pos").over(every) > 0)
    judged = hist.select(
        "bin",
        F.coalesce(F.lag("bin").over(order), F.col("bin")).alias("last"),
        F.when(both, share_below("neg") - share_below("pos")).alias("merit"),
    )
    best = F.max_by((F.col("bin") + F.col("last")) / 2, F.struct("merit", -F.col("bin")))
    return judged.agg(F.when(F.max("merit").isNotNull(), best / bins).otherwise(empty_cut).alias("cut"))
