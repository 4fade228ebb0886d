"""Filter interaction audit: what each filter removes, in every order of the filters.

For every part of a table and every filter there is a posting list: the failing
documents, sorted. Everything the audit reports is the size of unions and differences
of such lists: what a filter removes after others is the union with it less the union
without it; what only it removes is the union of all less the union of the others.

Lists are kept per range of ids. In a range, one galloping k-way merge passes over the
lists of a part: it takes a bounded stretch of each list at a time, finds by doubling
how far the other lists reach into the stretch, and notes which lists hold each id. So
one merge sizes all regions of the lists' diagram (two to the number of lists, at most),
and every union and difference is a sum of regions. Two more lists, of good and of
toxic documents, divide the regions further.

A filter may ask for repeats: identical to the text of a smaller id. The smallest id of
each text is found by a combined aggregate; these ids form a list, too, and the failing
list is the difference: all ids less the first ones.

Scale: texts are read once and leave the first stage as two hashes and a few bits. Rows
equal in all of it are counted before ids are cut into ranges, and ranges are cut at
quantiles of (id, hash), so neither copies nor repeated or NULL ids gather in a task. A
task holds ``RANGE`` entries at a time. What is left per part is one number per region.

Defined cases: NULL text is as empty; a NULL part is the empty part; repeated rows count
as often as they come; rows that share an id are documents of their own, and no repeats
of each other; a NULL id is no repeat and has no labels; a document is good (or toxic) if
any of its label rows says so; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import WORD, stored

RANGE = 1 << 18  # entries of a range of ids whose lists are in memory
STRETCH = 1 << 13  # ids of a list that a step of the merge takes at most
REPEATS = "repeats"
REGIONS = "part string, region int, n bigint"


def text_filters(text: Column) -> dict[str, Column | str]:
    """The failure conditions A to E."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 100,
        "B": F.lit(100) * distinct < F.lit(80) * n,
        "C": F.lit(100).cast("bigint") * capitals > F.lit(10).cast("bigint") * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
        "E": REPEATS,
    }


def gallop(ids: np.ndarray, start: int, key: int) -> int:
    """First place from ``start`` on whose id is above ``key``, by doubling steps."""
    low, step = start, 1
    while low + step < len(ids) and ids[low + step] <= key:
        low += step
        step *= 2
    return low + int(np.searchsorted(ids[low : low + step + 1], key, "right"))


def merge(lists: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, regions) of the union of sorted lists in bounded stretches: bit i of a
    region says that list i holds the id."""
    at = [0] * len(lists)
    while True:
        left = [i for i, ids in enumerate(lists) if at[i] < len(ids)]
        if not left:
            return
        last = min(int(lists[i][min(at[i] + STRETCH, len(lists[i])) - 1]) for i in left)
        ids, bits = [], []
        for i in left:
            stop = gallop(lists[i], at[i], last)
            ids.append(lists[i][at[i] : stop])
            bits.append(np.full(stop - at[i], 1 << i, np.int64))
            at[i] = stop
        joined, held = np.concatenate(ids), np.concatenate(bits)
        order = np.argsort(joined, kind="stable")
        joined, held = joined[order], held[order]
        starts = np.flatnonzero(np.r_[True, joined[1:] != joined[:-1]])
        yield joined[starts], np.bitwise_or.reduceat(held, starts)


def without(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Ids that are not among the others: the difference by the same merge."""
    found = [part[regions == 1] for part, regions in merge([ids, others])]
    return np.concatenate(found) if found else ids[:0]


def _regions(parts: np.ndarray, bits: np.ndarray, n: np.ndarray, first: np.ndarray, repeats: list[int], width: int):
    """(part, region, n) of a range of entries in id order. Entries are numbered in
    that order, as ids may repeat; these numbers are what the lists hold."""
    order = np.argsort(parts, kind="stable")
    edges = np.flatnonzero(np.r_[True, parts[order][1:] != parts[order][:-1]])
    for place in np.split(order, edges[1:]):
        lists = [place[bits[place] >> i & 1 == 1] for i in range(width)]
        for i in repeats:  # all ids less the first of each text
            lists[i] = without(place, place[first[place]])
        counts = np.zeros(1 << width, np.int64)
        for ids, regions in merge(lists):
            np.add.at(counts, regions, n[ids])
        counts[0] = n[place].sum() - counts.sum()
        for region in np.flatnonzero(counts):
            yield int(parts[place[0]]), int(region), int(counts[region])


def _count_regions(repeats: list[int], width: int):
    """Reads entries sorted by (id, hashes, kind); kind 0 names the first id of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, ...]] = []
        size, seen = 0, None

        def flush():
            parts, bits, n, first = (np.concatenate(x) for x in zip(*held))
            found = list(_regions(parts, bits, n, first, repeats, width))
            known = list(names)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([known[p] for p, _, _ in found], pa.string()),
                    pa.array([r for _, r, _ in found], pa.int32()),
                    pa.array([c for _, _, c in found], pa.int64()),
                ],
                ["part", "region", "n"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            raw = [batch.column(c) for c in ("id", "h1", "h2")]
            keys = np.stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in raw], 1)
            known = raw[0].is_valid().to_numpy(zero_copy_only=False)
            entry = batch.column("entry").to_numpy(zero_copy_only=False)
            # the last named first before each row, which may be in the batch before
            heads = np.flatnonzero(~entry)
            before = np.searchsorted(heads, np.arange(len(keys)), "right") - 1
            table = np.concatenate([np.zeros((1, 3), np.int64) if seen is None else seen[None], keys[heads]])
            first = ~known | (table[before + 1] == keys).all(1) & ((before >= 0) | (seen is not None))
            if len(heads):
                seen = keys[heads[-1]]
            rows = np.flatnonzero(entry)
            if len(rows):
                coded = batch.column("part").take(pa.array(rows)).dictionary_encode()
                codes = np.array([names.setdefault(p, len(names)) for p in coded.dictionary.to_pylist()], np.int64)
                bits = batch.column("bits").to_numpy(zero_copy_only=False)[rows].astype(np.int64)
                n = batch.column("n").to_numpy(zero_copy_only=False)[rows].astype(np.int64)
                held.append((codes[coded.indices.to_numpy(zero_copy_only=False)], bits, n, first[rows]))
                size += len(rows)
            if size >= RANGE:
                yield flush()
                names.clear()
                size = 0
        if held:
            yield flush()

    return run


def regions(
    docs: DataFrame,
    labels: DataFrame,
    filters: dict[str, Column | str],
    part: str = "lang",
) -> DataFrame:
    """(part, region, n): bit i of a region is the i-th filter's failure; the two bits
    after them mark good and toxic documents. Every document is in one region."""
    spark, width = docs.sparkSession, len(filters)
    repeats = [i for i, fails in enumerate(filters.values()) if isinstance(fails, str)]
    failed = [
        F.when(fails, F.lit(1 << i)).otherwise(0) for i, fails in enumerate(filters.values()) if i not in repeats
    ]
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("bigint").alias("id"),
        F.xxhash64(text).alias("h1"),
        F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint").alias("h2"),
        sum(failed, F.lit(0)).alias("bits"),
    )
    counted = stored(spark, marked.groupBy(*marked.columns).agg(F.count(F.lit(1)).alias("n")), "audit-marks")
    firsts = counted.groupBy("h1", "h2").agg(F.min("id").alias("id")).where("id IS NOT NULL")
    said = labels.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1 << width).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 2 << width).otherwise(0)).alias("toxic"),
    )
    bits = F.col("bits") + F.coalesce(F.col("good"), F.lit(0)) + F.coalesce(F.col("toxic"), F.lit(0))
    columns = ["id", "h1", "h2", "entry", "part", "bits", "n"]
    entries = counted.join(said, "id", "left").withColumn("bits", bits).withColumn("entry", F.lit(True))
    named = firsts.select("id", "h1", "h2", F.lit(False).alias("entry"))
    both = entries.select(*columns).unionByName(named, allowMissingColumns=True)
    key = ["id", "h1", "h2"]
    ranged = both.repartitionByRange(*key).sortWithinPartitions(*key, "entry")
    found = ranged.mapInArrow(_count_regions(repeats, width + 2), REGIONS)
    return found.groupBy("part", "region").agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | str], part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, from sums over regions. Filters
    have names of one character; their orders are named by these."""
    names = "".join(filters)
    width = len(names)
    if width != len(filters):
        raise ValueError("filters have names of one character")
    sizes = regions(docs, labels, filters, part).groupBy("part").agg(
        F.collect_list(F.struct("region", "n")).alias("sizes")  # at most one per region
    )
    orders = ",".join("".join(p) for p in permutations(names))
    steps = sizes.select(
        "part", "sizes", F.explode(F.split(F.lit(orders), ",")).alias("filter_order")
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(width))).alias("step"))

    bits = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(c), F.lit(1 << i))])

    def bit(name: Column) -> Column:
        return F.try_element_at(bits, name)

    earlier = F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    before = F.aggregate(F.split(earlier, ""), F.lit(0), lambda acc, c: acc + F.coalesce(bit(c), F.lit(0)))
    name = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    coded = steps.select(
        "part", "sizes", "filter_order", "step", name.alias("__name"), bit(name).alias("__bit"), before.alias("__before")
    )
    own, prior = F.col("__bit"), F.col("__before")
    every = (1 << width) - 1

    def total(where) -> Column:
        return F.aggregate(
            F.filter("sizes", lambda s: where(s["region"])), F.lit(0).cast("bigint"), lambda acc, s: acc + s["n"]
        )

    def here(r: Column) -> Column:
        return (r.bitwiseAND(own) != 0) & (r.bitwiseAND(prior) == 0)

    removed = Window.partitionBy("part", "__name")
    return coded.select(
        "part",
        "filter_order",
        "step",
        total(lambda r: r.bitwiseAND(prior + own) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda r: (r.bitwiseAND(own) != 0) & (r.bitwiseAND(prior) != 0)).alias("redundant"),
        total(lambda r: r.bitwiseAND(F.lit(every)) == own).alias("unique_fails"),
        total(lambda r: here(r) & (r.bitwiseAND(F.lit(1 << width)) != 0)).alias("good_lost"),
        total(lambda r: here(r) & (r.bitwiseAND(F.lit(2 << width)) != 0)).alias("toxic_lost"),
        "__name",
    ).select("*", F.sum("removed").over(removed).alias("shapley")).drop("__name")
