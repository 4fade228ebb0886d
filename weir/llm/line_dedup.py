"""Line dedup by distinct-site spread.

A line is told by two hashes of its trimmed text. HyperLogLog sketches of the sites
it occurs on are merged by one aggregation. Where the estimate is clear of
``min_sites`` by ``MARGIN`` (six times the sketch's standard error) it decides; near
the threshold the sites are counted exactly. A line on ``min_sites`` or more sites is
boilerplate: it stays in the document with the smallest id and goes everywhere else.

Defined cases: a NULL site is no site; NULL texts stay NULL; blank lines are never
removed; repeated rows are cut alike; a document with a NULL id is never the first;
extra columns are kept, internal ones are structs under ``__line_`` names; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import row_key, stored

MIN_SITES = 10
LG_K = 12
MARGIN = 0.1
_EDGES = " \t\n\x0b\x0c\r"


def _line_key(line: Column) -> Column:
    trimmed = F.btrim(line, F.lit(_EDGES))
    return F.struct(F.xxhash64(trimmed).alias("h1"), F.xxhash64(F.lit(1), trimmed).alias("h2"))


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """One row per document and distinct line: (k1, k2, id, site, h1, h2)."""
    filled = F.filter(F.split("text", "\n"), lambda l: F.btrim(l, F.lit(_EDGES)) != "")
    keys = F.array_distinct(F.transform(filled, _line_key))
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    return docs.select(
        k1.alias("k1"),
        k2.alias("k2"),
        F.col("doc_id").alias("id"),
        F.col(site).alias("site"),
        F.explode(keys).alias("h"),
    ).select("k1", "k2", "id", "site", "h.h1", "h.h2")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Lines on ``min_sites`` sites or more: (h1, h2, first)."""
    spark = lines.sparkSession
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", F.lit(LG_K)).alias("sites"), F.min("id").alias("first")
    )
    estimate = F.hll_sketch_estimate("sites").alias("estimate")
    wide = spread.select("h1", "h2", "first", estimate).where(
        F.col("estimate") >= min_sites * (1 - MARGIN)
    )
    wide = stored(spark, wide, "line-spread")
    clear = F.col("estimate") > min_sites * (1 + MARGIN)
    near = wide.where(~clear).select(F.col("h1").alias("n1"), F.col("h2").alias("n2"), "first")
    exact = (
        lines.join(near, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2")))
        .groupBy("h1", "h2", "first")
        .agg(F.count_distinct("site").alias("n"))
        .where(F.col("n") >= min_sites)
    )
    return stored(
        spark,
        wide.where(clear).select("h1", "h2", "first").unionByName(exact.select("h1", "h2", "first")),
        "line-boilerplate",
    )


def dedup_lines(
    docs: DataFrame, *, site: str = "source", min_sites: int = MIN_SITES, removed: str = "lines_removed"
) -> DataFrame:
    """The documents without repeated boilerplate, and how many lines went in a column
    named ``removed``; where the documents have such a column, ``__line_`` goes before."""
    spark = docs.sparkSession
    lines = _lines(docs, site)
    common = boilerplate(lines, min_sites).select(
        F.col("h1").alias("b1"), F.col("h2").alias("b2"), "first"
    )
    hits = (
        lines.join(common, (F.col("h1") == F.col("b1")) & (F.col("h2") == F.col("b2")))
        .where(F.col("id").isNull() | F.col("first").isNull() | (F.col("id") != F.col("first")))
        .groupBy(F.col("k1").alias("__line_k1"), F.col("k2").alias("__line_k2"))
        .agg(F.collect_set(F.struct("h1", "h2")).alias("__line_cut"))
    )
    hits = stored(spark, hits, "line-hits")
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.select(F.struct("*").alias("__line_row"), k1.alias("__line_k1"), k2.alias("__line_k2"))
    joined = keyed.join(hits, ["__line_k1", "__line_k2"], "left")
    all_lines = F.split("__line_row.text", "\n")
    kept = F.filter(all_lines, lambda l: ~F.array_contains("__line_cut", _line_key(l)))
    cut = F.col("__line_cut").isNotNull()
    names = docs.columns
    return joined.select(
        *[
            F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("__line_row")[name]).alias(name)
            if name == "text"
            else F.col("__line_row")[name].alias(name)
            for name in names
        ],
        F.when(cut, F.size(all_lines) - F.size(kept)).otherwise(0).cast("bigint").alias(removed if removed not in names else f"__line_{removed}"),
    )
