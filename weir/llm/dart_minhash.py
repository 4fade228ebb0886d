"""Near-duplicate documents by DartMinHash signatures and banded joining.

The elements of a document are its shingles of five words; a shingle is a region
whose size is its weight. Darts hit regions as a Poisson process along the rank axis:
a region of weight 1 is hit at ranks that are sums of hashed exponential gaps, so all
documents that hold the shingle see the same darts. A dart has a hashed coordinate,
and each coordinate of the signature keeps its earliest dart. About k ln k + 2k darts
fill k coordinates whatever the document's length; where one stays empty, the rank
limit is doubled. Two signatures agree in a coordinate with a probability equal to
the (weighted) Jaccard similarity.

Joining:

1. equal texts are one node, with a number; copies never meet in a join;
2. signatures are cut into bands of ``ROWS``; nodes that share a band form a bucket,
   and each links to the bucket's smallest node;
3. links whose signatures (a byte of each coordinate is kept) agree too little go, before
   any text moves; each node's best link is checked exactly: (weighted) Jaccard similarity of
   the shingles >= ``THRESHOLD``; connected components are classes; of the other links,
   those between different classes are checked then;
4. components of all links are classes;
5. in buckets that still hold nodes of different classes besides the smallest, nodes
   meet in blocks of a fixed size: those of the bucket's most frequent class meet only the
   others, which also meet each other. First their signatures meet; nodes that may be
   similar to one of another class meet again with their shingles, are checked exactly,
   too, and components are formed again.

A text moves only if it is checked: rows whose id is not in a bitmap of hashed ids, which
all tasks get, stay where they are. The bitmap has a fixed size; the more ids it holds, the
more other rows pass it and are left out by the join behind it.

So no bucket is cut off: pairs inside one class need no link of their own, all others
in a bucket are looked at. With 26 bands of 5 a pair at similarity 0.8 shares a bucket
with probability 1 - 3e-5.

Defined cases: documents without words (NULL, empty) form classes of their own; texts
of one to four words are one shingle; weights count a shingle once (``counted=True``:
as often as it occurs); the class is the smallest id in it (NULL if it has none);
repeated rows share a class; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import forget, stored
from weir.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 26, 5
K = BANDS * ROWS
#: Signatures that agree in fewer coordinates than this are not similar enough: five
#: standard deviations under the threshold.
MAYBE = THRESHOLD - 5 * (THRESHOLD * (1 - THRESHOLD) / K) ** 0.5
BLOCK = 512
#: Partners of a node that are compared with it in one part.
PARTNERS = 4096
#: Bits of the bitmap of ids.
SLOTS = 2**25
#: Texts that a Python worker holds at once, beside its Arrow batch, and their shingles.
_DOCS_AT_ONCE = 128
_SHINGLES_AT_ONCE = 100_000

_SIGNED = "digest binary, doc_id bigint, bands array<bigint>, brief binary"


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """64-bit hashes of all runs of five words, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        words = [b" ".join(words)] * SHINGLE
    w = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = len(w) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[j : j + n] + np.uint64(j))
    return h


def elements(text: str | None, counted: bool = False) -> np.ndarray:
    """Distinct shingles; counted, the n-th of its kind is an element of its own, so that
    the similarity of two sets is that of the weights."""
    found = np.sort(shingles(text))
    if not counted or not len(found):
        return np.unique(found)
    starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    nth = np.arange(len(found)) - np.repeat(starts, np.diff(np.r_[starts, len(found)]))
    return np.unique(_mix(found + _mix(nth.astype(np.uint64))))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of distinct hashes."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


def dart_signatures(
    docs: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, k: int = K
) -> np.ndarray:
    """Dart ids (n, k) of n documents given as (document, element, weight) triples;
    every document has a positive total weight."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(docs, weights, n)
    limit = (k * np.log(k) + 2 * k) / total
    todo = np.arange(n)
    while len(todo):
        mine = np.isin(docs, todo)
        full = _throw(docs[mine], elements[mine], weights[mine], limit, out, n, k)
        todo = todo[~full[todo]]
        limit[todo] *= 2
    return out


def _throw(docs, elements, weights, limit, out, n: int, k: int) -> np.ndarray:
    """Fill ``out`` with the earliest darts below the limits; which rows are full."""
    # a region is cut into cells of weight 1; the last one may be partly covered
    cells = np.ceil(weights).astype(np.int64)
    row = np.repeat(np.arange(len(docs)), cells)
    index = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
    doc, cover = docs[row], np.minimum(1.0, weights[row] - index)
    seed = _mix(elements[row] + _mix(index.astype(np.uint64)))
    rank = np.zeros(len(row))
    slots, ranks, names = [], [], []
    turn = 0
    while len(doc):
        turn += 1
        draw = _mix(seed + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        rank = rank - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53)
        alive = rank < limit[doc]
        doc, seed, rank, cover, draw = doc[alive], seed[alive], rank[alive], cover[alive], draw[alive]
        name = _mix(draw + np.uint64(1))
        spot = _mix(name + np.uint64(2))
        inside = (_mix(name + np.uint64(3)) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < cover
        slots.append((doc * k + (spot % np.uint64(k)).astype(np.int64))[inside])
        ranks.append(rank[inside])
        names.append(name[inside])
    slot, rank, name = np.concatenate(slots), np.concatenate(ranks), np.concatenate(names)
    order = np.argsort(-rank, kind="stable")  # the earliest dart is written last
    flat, hit = out.reshape(-1), np.zeros(n * k, bool)
    flat[slot[order]] = name[order]
    hit[slot] = True
    return hit.reshape(n, k).all(1)


def _portions(texts: list):
    """Lists of (index, distinct shingles, their counts) of texts with words; apart from a
    longer text of its own, none holds more shingles than ``_SHINGLES_AT_ONCE``."""
    found, total = [], 0
    for i, text in enumerate(texts):
        hashes = shingles(text)
        if not len(hashes):
            continue
        if found and total + len(hashes) > _SHINGLES_AT_ONCE:
            yield found
            found, total = [], 0
        found.append((i, *np.unique(hashes, return_counts=True)))
        total += len(hashes)
    if found:
        yield found


def _slices(batches):
    """Arrow batches in slices of a few texts, as their Python strings take memory."""
    for part in batches:
        forget()
        for at in range(0, part.num_rows, _DOCS_AT_ONCE):
            yield part.slice(at, _DOCS_AT_ONCE)
    part = None
    forget()


def _sign(texts: list, counted: bool) -> tuple[list, list]:
    """Band hashes and the low bytes of the signatures, None for documents without words."""
    bands: list = [None] * len(texts)
    briefs: list = [None] * len(texts)
    for found in _portions(texts):
        sizes = [len(f[1]) for f in found]
        weights = np.concatenate([f[2] for f in found]).astype(float)
        signed = dart_signatures(
            np.repeat(np.arange(len(found)), sizes),
            np.concatenate([f[1] for f in found]),
            weights if counted else np.ones(len(weights)),
            len(found),
        )
        key = np.zeros((len(found), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for j in range(ROWS):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + signed[:, j::ROWS])
        for (i, *_), b, s in zip(found, key.view(np.int64), signed.astype(np.uint8)):
            bands[i], briefs[i] = b, s.tobytes()
    return bands, briefs


def sign_documents(docs: DataFrame, counted: bool = False) -> DataFrame:
    """(digest, doc_id, bands, brief); the digest is that of the text."""

    def run(batches):
        for part in _slices(batches):
            texts = part.column("text").to_pylist()
            bands, briefs = _sign(texts, counted)
            digests = [hashlib.md5((t or "").encode("utf-8", "surrogatepass")).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    part.column("doc_id"),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(briefs, pa.binary()),
                ],
                ["digest", "doc_id", "bands", "brief"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, _SIGNED)


def _id_keys(doc_id: Column) -> list[Column]:
    """An id that may be NULL as two columns that are not."""
    return [F.coalesce(doc_id, F.lit(0)).alias("__dart_id"), doc_id.isNull().alias("__dart_null")]


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows with ``__dart_maybe``: whether their id keys may be among ``ids``; false is
    certain. No row moves."""
    slot = F.pmod(F.xxhash64("__dart_id", "__dart_null"), F.lit(SLOTS)) + 1
    taken = ids.select(slot.alias("slot"), F.bitmap_bucket_number(slot).alias("__dart_bucket"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__dart_bits")
    bitmap = taken.repartition("__dart_bucket").groupBy("__dart_bucket").agg(bits)
    met = rows.withColumns({"__dart_bucket": F.bitmap_bucket_number(slot), "__dart_bit": F.bitmap_bit_position(slot)})
    met = met.join(F.broadcast(bitmap), "__dart_bucket", "left")
    byte = F.substring("__dart_bits", (F.col("__dart_bit") / 8).cast("int") + 1, F.lit(1))
    held = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.expr("shiftleft(1, cast(__dart_bit % 8 AS INT))")) > 0
    return met.withColumn("__dart_maybe", F.coalesce(held, F.lit(False)))


def _texts(docs: DataFrame, nodes: DataFrame, roles: DataFrame) -> DataFrame:
    """(node, role, text) of (node, role). A text comes from the node's first document, so
    that copies are not gathered, and is shuffled once whatever the number of its roles."""
    wanted = roles.groupBy("node").agg(F.collect_list("role").alias("roles"))
    wanted = wanted.join(nodes.select("node", "digest", "first"), "node")
    wanted = wanted.select("digest", *_id_keys(F.col("first")), "node", "roles")
    wanted = stored(docs.sparkSession, wanted, "dart-wanted")
    keys = wanted.columns[:3]  # of the join and of the grouping
    rows = docs.select(*_id_keys(F.col("doc_id").cast("bigint")), "text")
    named = _marked(rows, wanted).where("__dart_maybe")
    named = named.select(F.unhex(F.md5("text")).alias("digest"), "__dart_id", "__dart_null", "text")
    texts = named.join(wanted, keys).groupBy(*keys).agg(*(F.first(c).alias(c) for c in ("node", "roles", "text")))
    return texts.select("node", F.explode("roles").alias("role"), "text")


def _agreeing(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, agree) of the pairs that may be similar by a byte of each coordinate."""
    brief = nodes.select("node", "brief")
    left = pairs.join(brief.withColumnsRenamed({"node": "b", "brief": "brief_b"}), "b")
    both = left.join(brief.withColumnsRenamed({"node": "a", "brief": "brief_a"}), "a")

    def run(batches):
        for part in batches:
            a, b = (
                np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, K) for c in ("brief_a", "brief_b")
            )
            same = (a == b).mean(1)
            keep = np.flatnonzero(same >= MAYBE)
            rows = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [part.column("a").take(rows), part.column("b").take(rows), pa.array(same[keep])], ["a", "b", "agree"]
            )

    rated = both.select("a", "b", "brief_a", "brief_b").mapInArrow(run, "a bigint, b bigint, agree double")
    return stored(pairs.sparkSession, rated, "dart-rated")


def _hub_links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, threshold: float, counted: bool) -> DataFrame:
    """Links to hubs that join all that the pairs would join: each node's best one is
    checked first, then those between classes that are still apart."""
    spark = docs.sparkSession
    rated = _agreeing(nodes, pairs)
    best = rated.groupBy("b").agg(F.max(F.struct("agree", "a")).alias("top"))
    best = stored(spark, best.select(F.col("b").alias("node"), "top.a"), "dart-best")
    links = _verified(docs, nodes, best.select("a", F.col("node").alias("b")), threshold, counted)
    comps = stored(spark, components(links), "dart-components")
    others = rated.join(best.withColumnRenamed("a", "tried"), F.col("b") == F.col("node")).where("a <> tried")
    others = others.select("a", "b")
    for end in ("a", "b"):
        of = comps.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
        others = others.join(of, end, "left").withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))
    apart = stored(spark, others.where("comp_a <> comp_b").select("a", "b"), "dart-apart")
    return links.unionByName(_verified(docs, nodes, apart, threshold, counted))


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, threshold: float, counted: bool) -> DataFrame:
    """Pairs (a, b) of nodes whose texts are similar enough. The texts of an ``a`` and its
    partners make a sorted stream, that of ``a`` first; an ``a`` with many partners is
    divided into parts, so its text moves once per part, not per pair."""
    spark = docs.sparkSession
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    sizes = stored(spark, sizes, "dart-parts")
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    role = F.struct("a", "part", "order").alias("role")
    partners = pairs.join(sizes, "a").select(F.col("b").alias("node"), "a", part, F.lit(1).alias("order"))
    heads = sizes.select(
        F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("order")
    )
    texts = _texts(docs, nodes, partners.unionByName(heads).select("node", role))
    stream = texts.select("node", "role.*", "text").repartition("a", "part").sortWithinPartitions("a", "part", "order")

    def run(batches):
        head: tuple = (None, None)
        for rows in _slices(batches):
            kept = []
            columns = (rows.column(c).to_pylist() for c in ("a", "part", "order", "node", "text"))
            for a, part, order, node, text in zip(*columns):
                if order == 0:
                    head = ((a, part), elements(text, counted))
                    continue
                assert head[0] == (a, part)
                if similarity(head[1], elements(text, counted)) >= threshold:
                    kept.append((a, node))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in kept], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    return stored(spark, stream.mapInArrow(run, "a bigint, b bigint"), "dart-links")


def _open_links(
    docs: DataFrame,
    members: DataFrame,
    comps: DataFrame,
    nodes: DataFrame,
    threshold: float,
    counted: bool,
) -> DataFrame:
    """Links between different classes in one bucket, apart from those of its smallest
    node, which have been checked. Members of the bucket's most frequent class and the
    others are dealt to blocks of a fixed size; each block of the one meets each of the
    other, and the others' blocks meet each other. They meet with their signatures first;
    shingles go only to meetings with a pair that may be similar. Only links that join two
    classes of a meeting are returned, so they are fewer than its rows."""
    spark = docs.sparkSession
    members = members.join(comps, "node", "left").select("band", "node", F.coalesce("comp", "node").alias("comp"))
    per = members.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy("band").agg(
        F.max_by("comp", "n").alias("main"),
        F.max("n").alias("n_main"),
        (F.sum("n") - F.max("n")).alias("n_other"),
    )
    mixed = stored(spark, mixed.where("n_other > 0"), "dart-mixed")
    rest = stored(
        spark, members.join(mixed, "band").withColumn("main", F.col("comp") == F.col("main")), "dart-rest"
    )

    def pack(batches):
        for part in _slices(batches):
            sets = [elements(t, counted).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"]
            )

    main_blocks, other_blocks = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n_main", "n_other"))
    zero = F.lit(0)
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("main"), main_blocks).otherwise(other_blocks)).cast("int")

    def cells(last: Column, cell) -> Column:
        return F.transform(F.sequence(zero, last - 1), cell)

    def cell(crossed: bool, i: Column, j: Column) -> Column:
        return F.struct(F.lit(crossed).alias("crossed"), i.alias("i"), j.alias("j"))

    own = F.col("mine")
    of_main = cells(other_blocks, lambda j: cell(True, own, j))
    to_main = cells(main_blocks, lambda i: cell(True, i, own))
    to_others = cells(other_blocks, lambda j: cell(False, F.least(own, j), F.greatest(own, j)))
    met = F.when(F.col("main"), of_main).when(F.col("n_other") == 1, to_main).otherwise(F.concat(to_main, to_others))
    dealt = (
        rest.join(nodes.select("node", "brief"), "node")
        .withColumn("mine", mine)
        .withColumn("cell", F.explode(met))
        .select("band", "node", "comp", "brief", "main", "mine", "cell.*")
    )

    def sides(part: pd.DataFrame) -> tuple:
        crossed, i, j = (part[c].iloc[0] for c in ("crossed", "i", "j"))
        if crossed:
            left, right = part[part["main"]], part[~part["main"]]
        else:
            left, right = part[part["mine"] == i], part[part["mine"] == j]
        matrix = np.stack([np.frombuffer(s, np.uint8) for s in right["brief"]]) if len(right) else None
        return crossed, i, j, left, right, matrix

    def near(part: pd.DataFrame) -> pd.DataFrame:
        """The rows that may be similar to one of another class."""
        *_, left, right, matrix = sides(part)
        keep: set = set()
        comps = right["comp"].to_numpy()
        for row in left.itertuples() if matrix is not None else ():
            same = (matrix == np.frombuffer(row.brief, np.uint8)).mean(1)
            found = np.flatnonzero((same >= MAYBE) & (comps != row.comp))
            if len(found):
                keep.add(row.Index)
                keep.update(right.index[found])
        return part.loc[sorted(keep)]

    meeting = dealt.groupBy("band", "crossed", "i", "j").applyInPandas(near, dealt.schema)
    meeting = stored(spark, meeting, "dart-meeting")
    wanted = meeting.select("node", F.lit(0).alias("role")).distinct()
    sets = _texts(docs, nodes, wanted).select("node", "text").mapInArrow(pack, "node bigint, shingles binary")
    sets = stored(spark, sets, "dart-rest-sets")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        crossed, i, j, left, right, matrix = sides(part)
        parent = {c: c for c in part["comp"]}

        def root(c):
            while parent[c] != c:
                c = parent[c]
            return c

        found = []
        names, comps, packed = (right[c].tolist() for c in ("node", "comp", "shingles"))
        for at, row in enumerate(left.itertuples(index=False)):
            if matrix is None:
                break
            same = (matrix == np.frombuffer(row.brief, np.uint8)).mean(1)
            mine = np.frombuffer(row.shingles, np.uint64)
            for k in np.flatnonzero(same >= MAYBE):
                if not crossed and i == j and k <= at:
                    continue
                a, b = root(row.comp), root(comps[k])
                if a != b and similarity(mine, np.frombuffer(packed[k], np.uint64)) >= threshold:
                    parent[b] = a
                    found.append((row.node, names[k]))
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    met = meeting.join(sets, "node")
    return met.groupBy("band", "crossed", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def near_duplicate_classes(
    docs: DataFrame, *, threshold: float = THRESHOLD, counted: bool = False
) -> DataFrame:
    """(doc_id, node, class_id, class_node) for every row of ``docs``: the digest of its
    text, the class and the text that stands for it, that of its smallest id."""
    spark = docs.sparkSession
    signed = stored(spark, sign_documents(docs, counted), "dart-signed")
    nodes = signed.where("bands IS NOT NULL").groupBy("digest").agg(
        F.first("bands").alias("bands"),
        F.first("brief").alias("brief"),
        F.min("doc_id").alias("first"),
    )
    # joins go by a number, as digests neither compress nor aggregate by hash
    nodes = stored(spark, nodes.withColumn("node", F.monotonically_increasing_id()), "dart-nodes")
    bands = nodes.select(F.explode("bands").alias("band"), "node")
    ends = bands.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    buckets = stored(spark, ends.where("hub <> last").select("band", "hub"), "dart-buckets")
    members = stored(spark, bands.join(buckets, "band").where("node <> hub"), "dart-members")
    pairs = members.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    pairs = stored(spark, pairs, "dart-pairs")
    links = _hub_links(docs, nodes, pairs, threshold, counted)
    comps = stored(spark, components(links), "dart-components")
    more = stored(spark, _open_links(docs, members, comps, nodes, threshold, counted), "dart-open")
    if not more.isEmpty():
        links = links.unionByName(more)
        comps = stored(spark, components(links), "dart-components")
    of = nodes.select("node", "digest", "first").join(comps, "node", "left")
    of = of.select("digest", "first", F.coalesce("comp", "node").alias("comp"))
    first = F.struct(F.col("first").isNull().alias("none"), "first", "digest")
    stands = of.groupBy("comp").agg(F.min(first).alias("stand"))
    named = stored(
        spark,
        of.join(stands, "comp").select(
            "digest", F.col("stand.first").alias("class_id"), F.col("stand.digest").alias("class_node")
        ),
        "dart-classes",
    )
    rows = signed.select("doc_id", "digest", F.col("bands").isNull().alias("wordless"))
    return rows.join(named, "digest", "left").select(
        "doc_id",
        F.col("digest").alias("node"),
        F.when(F.col("wordless"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("wordless"), F.col("digest")).otherwise(F.col("class_node")).alias("class_node"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns;
    documents without words all stay."""
    spark = docs.sparkSession
    classes = near_duplicate_classes(docs, **options)
    stands = F.col("class_node").eqNullSafe(F.col("node")) & F.col("class_id").eqNullSafe(F.col("doc_id"))
    verdicts = classes.select(F.col("node").alias("__dart_node"), *_id_keys(F.col("doc_id")), stands.alias("stands"))
    verdicts = stored(spark, verdicts, "dart-verdicts")
    # an id of one row, which stays, needs no look at the others; its row does not move
    per = verdicts.groupBy("__dart_id", "__dart_null").agg(F.count(F.lit(1)).alias("n"), F.every("stands").alias("all"))
    unsure = per.where("n > 1 OR NOT all")
    unsure = stored(spark, unsure.select("__dart_id", "__dart_null"), "dart-unsure")
    keys = ["__dart_node", "__dart_id", "__dart_null"]  # of the join and of the grouping: rows are shuffled once
    chosen = _marked(verdicts.where("stands"), unsure).where("__dart_maybe").select(*keys).distinct()
    chosen = stored(spark, chosen, "dart-chosen")
    row = docs.select(F.struct("*").alias("__dart_row"), *_id_keys(F.col("doc_id").cast("bigint")))
    row = _marked(row, unsure)
    text = F.coalesce(F.col("__dart_row.text"), F.lit(""))
    sure = ~F.col("__dart_maybe") | ~text.rlike(r"[^\x20\x09-\x0D]")
    stay = row.where(sure).select("__dart_row.*")
    met = row.where(~sure).select("__dart_row", F.unhex(F.md5(text)).alias("__dart_node"), *keys[1:])
    met = met.join(chosen, keys, "left_semi")
    one = met.groupBy(*keys).agg(F.first("__dart_row").alias("__dart_row"))
    return stay.unionByName(one.select("__dart_row.*"))
