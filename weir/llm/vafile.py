"""Exact top-k inner products by vector-approximation files.

Vectors become integers, floor(256 * x). Two files hold them: one with the exact
vectors, one with their cells. A row of the second is a slice of ``SLICE`` vectors:
every dimension is cut into ``CELLS`` equal cells between the slice's least and greatest
value, and a vector keeps one byte a dimension. From its cells an inner product is known
up to a gap that depends on the query and the slice only.

1. Of equal vectors only the k + 1 smallest ids can be in a result (one may be the
   query's own); the others need no look.
2. Queries come in blocks of ``QUERY_BLOCK``; some blocks make a panel, some slices make a
   shelf. A group (panel, shelf) holds the panel and reads the shelf as a sorted stream,
   so its memory is fixed by the block sizes and neither file is copied for each block of
   the other. It returns the vectors whose upper bound reaches the kth best lower bound
   that it has seen.
3. The kth best lower bound of all groups cuts these again, for the whole table.
4. Exact vectors are read in the order of the bounds: a query's first k, then those whose
   bound still reaches the kth exact score. Only vectors that are read leave their file,
   and one that many queries read is dealt to many tasks.

Defined cases: vectors that are NULL, hold NULL or non-finite components, or have
another length than the most frequent one (the larger at a tie) take no part; rows
with a NULL id neither; rows that repeat a query's id are not its candidates, and a
repeated query row is answered once (an id with two vectors asks twice); other repeated
rows are candidates of their own; ties go to the smaller id; fewer candidates than k give
fewer rows; an empty table gives an empty result. Components must be small enough for the
inner product to fit a BIGINT. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import stored

SLICE = 4096
QUERY_BLOCK = 512
CELLS = 256
#: Query blocks of a panel, slices of a shelf.
PANEL, SHELF = 16, 64
_LEAST = np.iinfo(np.int64).min
_PACKED = "ids binary, marks binary, vectors binary, low binary, width binary, n int"
_BOUNDS = "query_id bigint, query_mark bigint, vec_id bigint, mark bigint, upper bigint, lower bigint"
_QUERY = ["query_id", "query_mark"]
_CANDIDATE = ["vec_id", "mark"]


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part, with floor(256 * x)."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    fits = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & fits
    )
    whole = usable.select(
        "vec_id", F.transform("x", lambda c: F.floor(c * 256).cast("bigint")).alias("v")
    )
    sizes = whole.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.agg(F.max_by("size", F.struct("n", "size")).alias("size"))
    return whole.where(F.size("v") == common.scalar())


def candidates(vectors: DataFrame, k: int) -> DataFrame:
    """(vec_id, mark, v, copies): the k + 1 smallest ids of each vector. The mark is a hash
    of the row, and ``copies`` tells how often the row occurs, at most k times. Both steps
    keep at most k + 1 rows of a vector per task before they shuffle."""
    once = vectors.groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"))
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = once.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return few.select("vec_id", F.xxhash64("vec_id", "v").alias("mark"), "v", "copies")


class Approximation:
    """Cells of a slice, and bounds of inner products by them."""

    def __init__(self, low: np.ndarray, width: np.ndarray, cell: np.ndarray):
        self.low, self.width, self.cell = low, width, cell

    @classmethod
    def of(cls, vectors: np.ndarray) -> Approximation:
        low = vectors.min(0)
        width = np.maximum(1, -(-(vectors.max(0) - low + 1) // CELLS))
        return cls(low, width, ((vectors - low) // width).astype(np.uint8))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, queries) largest inner products that the cells allow, and for each
        query how far below these the smallest may lie. Each dimension takes the edge of
        the cell that the query's sign asks for."""
        edge = np.where(queries > 0, self.low + self.width - 1, self.low)
        step = queries * self.width
        cell, across = self.cell, step.T
        if CELLS * np.abs(step.astype(np.float64)).sum(1).max(initial=0) < 2.0**53:  # sums are whole
            cell, across = cell.astype(np.float64), across.astype(np.float64)
        else:
            cell = cell.astype(np.int64)
        upper = (queries * edge).sum(1) + (cell @ across).astype(np.int64)
        return upper, (np.abs(queries) * (self.width - 1)).sum(1)


def _pack(rows: DataFrame, block: int, cells: bool) -> DataFrame:
    """Rows (id, mark, v) packed into blocks, as cells or as they are."""

    def run(batches):
        for part in batches:
            for at in range(0, len(part), block):
                some = part.iloc[at : at + block]
                ids, marks = (some.iloc[:, i].to_numpy(np.int64).tobytes() for i in (0, 1))
                vectors = np.stack(some["v"].to_numpy()).astype(np.int64)
                low = width = b""
                if cells:
                    near = Approximation.of(vectors)
                    low, width, vectors = near.low.tobytes(), near.width.tobytes(), near.cell
                yield pd.DataFrame(
                    [(ids, marks, vectors.tobytes(), low, width, len(some))],
                    columns=["ids", "marks", "vectors", "low", "width", "n"],
                ).astype({"n": np.int32})

    return rows.mapInPandas(run, _PACKED)


class _Panel:
    """Queries of a group, and the k best lower bounds of each so far."""

    def __init__(self, k: int):
        self.k, self.blocks = k, []

    def add(self, row) -> None:
        ids, marks = np.frombuffer(row.ids, np.int64), np.frombuffer(row.marks, np.int64)
        queries = np.frombuffer(row.vectors, np.int64).reshape(row.n, -1)
        self.blocks.append((ids, marks, queries, np.full((self.k, row.n), _LEAST)))

    def scan(self, row):
        """Bounds of a slice that reach the kth best lower one."""
        ids, marks = np.frombuffer(row.ids, np.int64), np.frombuffer(row.marks, np.int64)
        near = Approximation(
            np.frombuffer(row.low, np.int64),
            np.frombuffer(row.width, np.int64),
            np.frombuffer(row.vectors, np.uint8).reshape(row.n, -1),
        )
        for asked, asked_marks, queries, best in self.blocks:
            upper, gap = near.bounds(queries)
            other = ids[:, None] != asked
            lower = np.where(other, upper - gap, _LEAST)
            top = np.concatenate([best, lower])
            top = np.partition(top, len(top) - self.k, axis=0)[len(top) - self.k :]
            best[:] = top
            at, q = np.nonzero(other & (upper >= best.min(0)))
            if len(at):
                yield pd.DataFrame(
                    {
                        "query_id": asked[q],
                        "query_mark": asked_marks[q],
                        "vec_id": ids[at],
                        "mark": marks[at],
                        "upper": upper[at, q],
                        "lower": upper[at, q] - gap[q],
                    }
                )


def _grid(slices: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows of both files, dealt by (shelf, panel) and sorted, a group's queries first."""
    panels, shelves = (
        F.lit(max(1, -(-rows.count() // size))) for rows, size in ((blocks, PANEL), (slices, SHELF))
    )
    every = [F.explode(F.sequence(F.lit(0), n.cast("int") - 1)) for n in (shelves, panels)]
    own = F.xxhash64("marks")
    left = blocks.select("*", F.lit(0).alias("side"), F.pmod(own, panels).cast("int").alias("panel"), every[0].alias("shelf"))
    right = slices.select("*", F.lit(1).alias("side"), F.pmod(own, shelves).cast("int").alias("shelf"), every[1].alias("panel"))
    both = left.unionByName(right).repartition("shelf", "panel")
    return both.sortWithinPartitions("shelf", "panel", "side")


def bounded(slices: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Candidates whose upper bound reaches the kth best lower one of the whole table,
    with ``turn``, their place in the order of the bounds."""
    spark = slices.sparkSession

    def run(batches):
        group, panel = None, None
        for part in batches:
            for row in part.itertuples(index=False):
                if group != (row.shelf, row.panel):
                    group, panel = (row.shelf, row.panel), _Panel(k)
                if row.side == 0:
                    panel.add(row)
                else:
                    yield from panel.scan(row)

    found = stored(spark, _grid(slices, blocks).mapInPandas(run, _BOUNDS), "va-bounds")
    by_lower = Window.partitionBy(*_QUERY).orderBy(F.desc("lower"))
    top = found.select(*_QUERY, "lower", F.row_number().over(by_lower).alias("nth")).where(F.col("nth") <= k)
    kth = top.groupBy(*_QUERY).agg(F.when(F.count(F.lit(1)) == k, F.min("lower")).alias("kth"))
    near = found.join(kth, _QUERY).where("kth IS NULL OR upper >= kth")
    by_upper = Window.partitionBy(*_QUERY).orderBy(F.desc("upper"), *_CANDIDATE)
    return near.select(*_QUERY, *_CANDIDATE, "upper", F.row_number().over(by_upper).alias("turn"))


def _read(exact: DataFrame, asked: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exact scores of pairs. A vector leaves its file once for each part of the queries
    that read it, so that no task gets all pairs of one vector."""
    spark = exact.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.select(*_QUERY, *_CANDIDATE, F.pmod(F.xxhash64(*_QUERY), F.lit(parts)).alias("part"))
    wanted = pairs.select(*_CANDIDATE, "part").distinct().join(exact, _CANDIDATE)
    both = pairs.join(wanted, [*_CANDIDATE, "part"]).join(asked, _QUERY)
    product = F.aggregate(F.zip_with("v", "q", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return stored(spark, both.select(*_QUERY, *_CANDIDATE, "copies", product.alias("score")), "va-read")


def top_k(rows: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): queries are the ids divisible by ``every``."""
    spark = rows.sparkSession
    vectors = stored(spark, integer_vectors(rows), "va-vectors")
    exact = stored(spark, candidates(vectors, k), "va-exact")
    slices = stored(spark, _pack(exact.select("vec_id", "mark", "v"), SLICE, cells=True), "va-cells")
    asked = vectors.where(F.col("vec_id") % every == 0).distinct()
    asked = asked.select(F.col("vec_id").alias("query_id"), F.xxhash64("vec_id", "v").alias("query_mark"), F.col("v").alias("q"))
    asked = stored(spark, asked, "va-asked")
    blocks = stored(spark, _pack(asked.withColumnRenamed("q", "v"), QUERY_BLOCK, cells=False), "va-queries")
    near = stored(spark, bounded(slices, blocks, k), "va-near")

    first = _read(exact, asked, near.where(F.col("turn") <= k))
    by_score = Window.partitionBy(*_QUERY).orderBy(F.desc("score"), "vec_id")
    kth = first.groupBy(*_QUERY).agg(F.min("score").alias("kth"))  # of k rows, where more are left
    open_pairs = near.where(F.col("turn") > k).join(kth, _QUERY).where("upper >= kth")
    scored = first.unionByName(_read(exact, asked, open_pairs))
    apart = scored.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return (
        apart.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
