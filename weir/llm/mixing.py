"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule: knots (t, w) over training time 0..1, linear in
between. Its integral is the source's weight. All words of the corpus are shared out
by these weights (``source_targets``); a target stops at ``max_repeats`` times the
source's size and the excess goes to the others by weight. The cumulative demand of a
source at time t is its target times the integral of its schedule up to t, over the
whole integral. A document that begins at word offset x of its source (in an order by
hash) is trained on at the time when demand reaches x: the inverse of the integral,
in closed form per segment. Further passes over the source add its size to x; a pass
whose middle lies beyond the target is not taken. Documents come back range-sorted by
position.

Scale: the running offset inside a source is a prefix in three levels (256 x 256 hash
buckets, then rows), so no task holds a source; the rows themselves are shuffled once
by (source, bucket) and once for the final range sort. One row per source passes
through one task when weights are shared out: schedules are given per source.

Defined cases: a NULL source is a source of its own; NULL, empty and wordless texts
have size 0 and are never taken; repeated rows are documents of their own; an empty
table gives an empty result. All columns are kept; internal columns start with
``__mix_`` and displace none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import stored, word_count

MAX_REPEATS = 3
P = "__mix_"


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target`` to rows of (source, source_size, weight).

    Sources are ordered by size over weight. The level that would exhaust the words
    when all earlier sources are at their limit is at most the true level, with
    equality at the true split, so the true level is the largest of these.
    """
    limit = max_repeats * F.col("source_size")
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    total = F.sum("source_size").over(every)
    used = F.coalesce(F.sum(limit).over(before), F.lit(0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - used).cast("double") / open_weight
    leveled = sizes.where("weight > 0").withColumn("level", level)
    top = F.max("level").over(every)
    return leveled.withColumn(
        "target", F.least(limit.cast("double"), top * F.col("weight"))
    ).drop("level")


def segments(knots: Column) -> Column:
    """Straight pieces of a schedule with the integral up to their start."""

    def piece(t, i):
        after = F.get(knots, i + 1)
        return F.struct(
            t["t"].alias("t0"),
            t["w"].alias("w0"),
            ((after["w"] - t["w"]) / (after["t"] - t["t"])).alias("slope"),
            ((after["t"] - t["t"]) * (after["w"] + t["w"]) / 2).alias("area"),
        )

    pieces = F.transform(F.slice(knots, F.lit(1), F.size(knots) - 1), piece)

    def start(p, i):
        earlier = F.slice(pieces, F.lit(1), i)
        area = F.aggregate(earlier, F.lit(0.0), lambda a, x: a + x["area"])
        return p.withField("start", area)

    return F.transform(pieces, start)


def integral(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0.0), lambda a, x: a + x["area"])


def invert(pieces: Column, area: Column) -> Column:
    """Time at which the integral of the schedule reaches ``area``."""
    reached = F.filter(pieces, lambda p: p["start"] <= area)
    p = F.get(reached, F.size(reached) - 1)
    rest = area - p["start"]
    root = p["w0"] + F.sqrt(F.greatest(p["w0"] * p["w0"] + 2 * p["slope"] * rest, F.lit(0.0)))
    return p["t0"] + F.when(root > 0, 2 * rest / root).otherwise(0.0)


def mix(
    docs: DataFrame,
    schedules: DataFrame,
    *,
    size: Column | None = None,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """All documents with ``size``, ``source_size``, ``target``, ``taken`` (words) and
    ``positions`` (times in 0..1, one for each pass taken), range-sorted by the first
    position; documents that are not taken come last.

    ``schedules`` has (source, knots array<struct<t, w>>), a row per source.
    """
    placed = _placed(docs, schedules, size, max_repeats)

    def named(name: str, instead: str | None = None) -> str:
        return name if name not in docs.columns else P + (instead or name)

    first = F.get(P + "positions", F.lit(0))
    ranged = placed.repartitionByRange(first.asc_nulls_last(), F.col(P + "row.doc_id")).sortWithinPartitions(
        first.asc_nulls_last(), F.col(P + "row.doc_id")
    )
    return ranged.select(
        P + "row.*",
        F.col(P + "size").alias(named("size", "words")),
        *[F.col(P + c).alias(named(c)) for c in ("source_size", "target", "taken", "positions")],
    )


def training_order(
    docs: DataFrame, schedules: DataFrame, *, size: Column | None = None, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """The columns of ``docs``, a row for each pass taken, range-sorted by position: the
    rows are shuffled once to be placed and once to be sorted."""
    placed = _placed(docs, schedules, size, max_repeats)
    each = placed.select(P + "row", F.explode(P + "positions").alias(P + "position"))
    order = [F.col(P + "position"), F.col(P + "row.doc_id")]
    return each.repartitionByRange(*order).sortWithinPartitions(*order).select(P + "row.*")


def _placed(docs: DataFrame, schedules: DataFrame, size: Column | None, max_repeats: int) -> DataFrame:
    """Each document as a struct, with its size, its source's, and its positions."""
    spark = docs.sparkSession
    mixed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(
        F.struct("*").alias(P + "row"),
        F.col("source").alias(P + "source"),
        (word_count(F.col("text")) if size is None else size).alias(P + "size"),
        mixed.alias(P + "hash"),
        F.xxhash64("text").alias(P + "text"),
    ).withColumns({P + "b1": F.substring(P + "hash", 1, 2), P + "b2": F.substring(P + "hash", 3, 2)})
    plan = stored(spark, _offsets(rows, schedules, max_repeats), "mix")

    # plain columns without NULLs, so that the join and the window share one shuffle
    keys = [P + "named", P + "key", P + "b1", P + "b2"]
    rows = rows.withColumns(_source_key(P + "source"))
    buckets = plan.withColumns({**_source_key("source"), P + "b1": F.col("b1"), P + "b2": F.col("b2")})
    joined = rows.join(buckets.drop("source", "b1", "b2"), keys)
    inside = (
        Window.partitionBy(*keys)
        .orderBy(P + "hash", P + "row.doc_id", P + "text", P + "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    n = F.col(P + "size")
    begin = F.col("before") + F.sum(n).over(inside) - n
    placed = joined.withColumn(P + "begin", begin.cast("double"))
    passes = F.sequence(F.lit(0), F.lit(max_repeats - 1))
    starts = F.transform(passes, lambda k: F.col(P + "begin") + k * F.col("source_size"))
    starts = F.filter(starts, lambda x: (n > 0) & (x + n / 2 < F.col("target")))
    scale = F.when(F.col("target") > 0, F.col("weight") / F.col("target")).otherwise(0.0)
    positions = F.transform(starts, lambda x: F.least(F.lit(1.0), invert(F.col("pieces"), x * scale)))
    return placed.select(
        P + "row",
        P + "size",
        F.col("source_size").alias(P + "source_size"),
        F.col("target").alias(P + "target"),
        (n * F.size(starts)).alias(P + "taken"),
        positions.alias(P + "positions"),
    )


def _source_key(source: str) -> dict[str, Column]:
    """A source as two columns that are never NULL."""
    return {
        P + "named": F.col(source).isNotNull(),
        P + "key": F.coalesce(F.col(source).cast("string"), F.lit("")),
    }


def _offsets(rows: DataFrame, schedules: DataFrame, max_repeats: int) -> DataFrame:
    """(source, b1, b2): words of the source before the bucket, with its target."""
    per = rows.groupBy(
        F.col(P + "source").alias("source"), F.col(P + "b1").alias("b1"), F.col(P + "b2").alias("b2")
    ).agg(F.sum(P + "size").alias("n"))
    per = stored(rows.sparkSession, per, "mix-buckets")
    upper = per.groupBy("source", "b1").agg(F.sum("n").alias("n"))
    sizes = upper.groupBy("source").agg(F.sum("n").alias("source_size"))
    weights = schedules.select(F.col("source").alias("s"), segments(F.col("knots")).alias("pieces"))
    sizes = sizes.join(weights, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    sizes = source_targets(sizes.withColumn("weight", integral(F.col("pieces"))), max_repeats)

    def running(*keys: str, by: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    first = upper.select(
        F.col("source").alias("s1"), F.col("b1").alias("u1"), running("source", by="b1").alias("before1")
    )
    second = per.select("source", "b1", "b2", running("source", "b1", by="b2").alias("before2"))
    both = second.join(first, F.col("source").eqNullSafe(F.col("s1")) & (F.col("b1") == F.col("u1")))
    named = sizes.withColumnRenamed("source", "s2")
    return both.join(named, F.col("source").eqNullSafe(F.col("s2"))).select(
        "source", "b1", "b2", (F.col("before1") + F.col("before2")).alias("before"),
        "source_size", "target", "weight", "pieces",
    )


def training_rows(mixed: DataFrame) -> DataFrame:
    """One row per pass taken, range-sorted by its ``position``."""
    each = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return each.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def cycling_schedules(docs: DataFrame, weights=(5.0, 2.0, 1.0)) -> DataFrame:
    """Weights repeat over the sources by code point, NULL last. The heaviest fades
    over the training, the lightest grows, each around its own weight."""
    sources = docs.select("source").distinct()
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    heaviest, lightest = max(weights), min(weights)
    tilts = [-0.5 if w == heaviest else 0.5 if w == lightest else 0.0 for w in weights]
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), place)
    tilt = F.get(F.array(*[F.lit(x) for x in tilts]), place)
    knots = F.array(
        F.struct(F.lit(0.0).alias("t"), (w * (1 - tilt)).alias("w")),
        F.struct(F.lit(1.0).alias("t"), (w * (1 + tilt)).alias("w")),
    )
    return sources.select("source", knots.alias("knots"))
