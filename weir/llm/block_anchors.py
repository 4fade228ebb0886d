"""Substring dedup: exact repeats found by fixed-block anchors.

A repeat of ``WINDOW`` = 50 words or more holds at least one whole block of ``BLOCK``
= 25 words of its source, where a document's blocks start at words 0, 25, 50, ...

1. Index and probes: the hashes of all blocks, and of the 25 words from every word on,
   are dealt by hash into buckets; packed, an entry takes six bytes. A probe that
   equals a block which occurs elsewhere, too, is a hit.
2. Extension: the hits go back to their documents, and every 50-word window around a
   hit is looked up by a 96-bit digest: the smallest document with each digest decides
   which windows repeat, so hits grow to the maximal repeats with any smaller document.
3. Words covered by a repeated window are removed.

Scale: nothing is paired. Step 1 holds one bucket's distinct blocks; probes stream by,
however often one passage occurs, and the number of buckets follows the input. Step 2
shuffles windows around hits only, combined map-side. A document that equals one with
a smaller id is removed as a whole without step 2.

Defined cases: NULL and empty texts have no words; documents of fewer than 50 words
lose none; documents with a NULL id lose none and are no source; rows with equal ids
are no source for each other; extra columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import row_key, stored

WINDOW = 50
BLOCK = 25
_AT_ONCE = 1_000_000  # words held by a task while it packs
_PER_ROW = 128  # probes in a packed row, on average

_PACKED = (
    "bucket int, kind int, page bigint, hashes binary, places binary, "
    "k1 binary, k2 binary, starts binary"
)
_HITS = "page bigint, places binary, k1 binary, k2 binary, starts binary"
_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, waiting binary, h1 array<bigint>, h2 array<int>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def rolling(words: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of ``length`` words from every word on, by doubling runs."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, size, done, out = words, 1, 0, np.zeros(n, np.uint64)
    while True:
        if length & size:
            shift = np.uint64(pow(base, size, 1 << 64))
            out = out * shift + run[done : done + n]
            done += size
        if done == length:
            return _mix(out)
        run = run[:-size] * np.uint64(pow(base, size, 1 << 64)) + run[size:]
        size *= 2


def _pack_probes(buckets: int):
    """Packs the blocks (kind 0), probes (1) and document places (2) of its rows."""
    page_words = _PER_ROW * buckets
    place = np.uint16 if page_words <= 1 << 16 else np.uint32
    bits = buckets.bit_length() - 1

    def flush(docs: list) -> pa.RecordBatch:
        sizes = np.array([len(d[2]) for d in docs])
        starts = np.cumsum(sizes) - sizes
        words = np.concatenate([d[2] for d in docs])
        k1 = np.array([d[0] for d in docs], np.int64)
        k2 = np.array([d[1] for d in docs], np.int64)
        digest = hashlib.md5(words.tobytes() + k1.tobytes()).digest()
        name = int.from_bytes(digest[:6], "little") << 12
        position = np.arange(len(words)) - np.repeat(starts, sizes)
        ends = np.repeat(sizes, sizes)
        hashes = rolling(words, BLOCK)
        inside = position[: len(hashes)] + BLOCK <= ends[: len(hashes)]
        at = np.flatnonzero(inside)
        rows: list[list] = [[] for _ in range(8)]

        def pack(kind: int, at: np.ndarray) -> None:
            h = hashes[at]
            group = (at // page_words) * buckets + (h >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            group, h, at = group[order], h[order].astype(np.uint32), at[order]
            cuts = np.flatnonzero(np.diff(group)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(group)]):
                if a == b:
                    continue
                page, bucket = divmod(int(group[a]), buckets)
                places = (at[a:b] - page * page_words).astype(place)
                row = (bucket, kind, name + page, h[a:b].tobytes(), places.tobytes(), None, None, None)
                for column, value in zip(rows, row):
                    column.append(value)

        pack(0, at[position[at] % BLOCK == 0])
        pack(1, at)
        for page in range(-(-len(words) // page_words)):
            low, high = page * page_words, (page + 1) * page_words
            here = (starts < high) & (starts + sizes > low)
            row = (
                (name + page) % buckets, 2, name + page, None, None,
                k1[here].tobytes(), k2[here].tobytes(), (starts[here] - low).astype(np.int64).tobytes(),
            )
            for column, value in zip(rows, row):
                column.append(value)
        types = [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 5
        names = ["bucket", "kind", "page", "hashes", "places", "k1", "k2", "starts"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)

    def run(batches):
        docs: list = []
        held = 0
        for part in batches:
            for k1, k2, text in zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "text"))):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                if len(words) < WINDOW:
                    continue
                docs.append((k1, k2, word_hashes(words)))
                held += len(words)
                if held >= _AT_ONCE:
                    yield flush(docs)
                    docs, held = [], 0
        if docs:
            yield flush(docs)

    return run


def _find_hits(wide: bool):
    """Streams the rows of each bucket: blocks first, then probes. The first probe of
    a block waits until a second one shows that the block repeats."""
    place = np.uint32 if wide else np.uint16

    def run(batches):
        bucket, pieces = None, []
        blocks = None
        for part in batches:
            out: list[tuple] = []
            for row in part.select(["bucket", "kind", "page", "hashes", "places", "k1", "k2", "starts"]).to_pylist():
                if row["kind"] == 2:
                    out.append((row["page"], None, row["k1"], row["k2"], row["starts"]))
                    continue
                if row["bucket"] != bucket:
                    bucket, pieces, blocks = row["bucket"], [], None
                h = np.frombuffer(row["hashes"], np.uint32)
                if row["kind"] == 0:
                    pieces.append(h)
                    if len(pieces) > 256:
                        pieces = [np.unique(np.concatenate(pieces))]
                    continue
                if blocks is None:
                    blocks = np.unique(np.concatenate(pieces)) if pieces else np.zeros(0, np.uint32)
                    count = np.zeros(len(blocks), np.uint8)
                    first_page = np.zeros(len(blocks), np.int64)
                    first_place = np.zeros(len(blocks), place)
                if not len(blocks):
                    continue
                slot = np.minimum(np.searchsorted(blocks, h), len(blocks) - 1)
                hit = np.flatnonzero(blocks[slot] == h)
                if not len(hit):
                    continue
                slot, places = slot[hit], np.frombuffer(row["places"], place)[hit]
                which, at, times = np.unique(slot, return_index=True, return_counts=True)
                before = count[which]
                for k in which[(before == 1)]:
                    out.append((int(first_page[k]), first_place[k].tobytes(), None, None, None))
                alone = (before == 0) & (times == 1)
                first_page[which[alone]], first_place[which[alone]] = row["page"], places[at[alone]]
                count[which] = np.where(alone, 1, 2)
                shown = np.ones(len(places), bool)
                shown[at[alone]] = False
                if shown.any():
                    out.append((row["page"], places[shown].tobytes(), None, None, None))
            types = [pa.int64()] + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                ["page", "places", "k1", "k2", "starts"],
            )

    return run


def _hits_by_document(hits: DataFrame, wide: bool) -> DataFrame:
    """(k1, k2, marks): word positions of the hits, from those of one page."""
    place = np.uint32 if wide else np.uint16

    def run(part: pd.DataFrame) -> pd.DataFrame:
        found = [np.frombuffer(p, place) for p in part["places"] if p is not None]
        maps = part[part["starts"].notna()]
        rows = []
        if found and len(maps):
            at = np.unique(np.concatenate(found)).astype(np.int64)
            first = maps.iloc[0]
            starts = np.frombuffer(first["starts"], np.int64)
            k1, k2 = np.frombuffer(first["k1"], np.int64), np.frombuffer(first["k2"], np.int64)
            doc = np.searchsorted(starts, at, side="right") - 1
            for d in np.unique(doc):
                marks = (at[doc == d] - starts[d]).astype(np.int32)
                rows.append((k1[d], k2[d], marks.tobytes()))
        return pd.DataFrame(rows, columns=["k1", "k2", "marks"])

    return hits.groupBy("page").applyInPandas(run, "k1 bigint, k2 bigint, marks binary")


def _cut(words: list[bytes], gone: np.ndarray) -> tuple[int, str]:
    """Number of words removed, and the digest of the others."""
    kept = [w for w, g in zip(words, gone) if not g] if gone.any() else words
    return len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _digests(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window: 64 and 31 bits."""
    second = rolling(_mix(hashes), WINDOW, 0xD1342543DE82EF95)
    return rolling(hashes, WINDOW).view(np.int64), (second >> np.uint64(33)).astype(np.int32)


def _open_windows(batches):
    """Finished rows, or the compressed text and the windows around its hits."""
    unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
    for part in batches:
        out: list[tuple] = []
        columns = ("doc_id", "packed", "is_copy", "marks")
        for doc_id, packed, is_copy, marks in zip(*(part.column(c).to_pylist() for c in columns)):
            words = unpack.decompress(packed).split()
            n = len(words)
            starts = np.zeros(0, np.int64)
            if marks and n >= WINDOW and not is_copy:
                hit = np.unique(np.concatenate([np.frombuffer(m, np.int32) for m in marks])).astype(np.int64)
                near = np.zeros(n + 1, np.int64)  # windows from hit - 25 to hit hold it
                np.add.at(near, np.maximum(hit - (WINDOW - BLOCK), 0), 1)
                np.add.at(near, np.minimum(hit + 1, n), -1)
                starts = np.flatnonzero(np.cumsum(near)[: n - WINDOW + 1] > 0)
            if len(starts):
                h1, h2 = _digests(word_hashes(words))
                out.append((doc_id, n, None, None, pack.compress(b" ".join(words)), h1[starts], h2[starts]))
            else:
                gone = np.full(n, bool(is_copy) and n >= WINDOW)
                out.append((doc_id, n, *_cut(words, gone), None, None, None))
        types = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "waiting", "h1", "h2"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)


def _close(batches):
    """Remove what repeated windows cover."""
    unpack = zstandard.ZstdDecompressor()
    for part in batches:
        out: list[tuple] = []
        columns = ("doc_id", "n_words", "waiting", "repeats")
        for doc_id, n, waiting, repeats in zip(*(part.column(c).to_pylist() for c in columns)):
            words = unpack.decompress(waiting).split()
            gone = np.zeros(len(words) + 1, np.int64)
            if repeats:
                h1, _ = _digests(word_hashes(words))
                starts = np.flatnonzero(np.isin(h1, np.array(repeats, np.int64)))
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + WINDOW, -1)
            out.append((doc_id, n, *_cut(words, np.cumsum(gone)[:-1] > 0)))
        types = [pa.int64()] * 3 + [pa.string()]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)


def _compressed(batches):
    pack = zstandard.ZstdCompressor(level=3)
    for part in batches:
        texts = [pack.compress((t or "").encode("utf-8", "surrogatepass")) for t in part.column("text").to_pylist()]
        names = ["k1", "k2", "doc_id"]
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in names), pa.array(texts, pa.binary())], [*names, "packed"]
        )


def remove_repeats(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    spark = docs.sparkSession
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    t1, t2 = row_key(F.col("text"))
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    usable = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    if buckets is None:  # a bucket's index stays as large when the input grows
        buckets = max(512, 1 << (8 * docs.rdd.getNumPartitions() - 1).bit_length())
    wide = _PER_ROW * buckets > 1 << 16

    packed = usable.select("k1", "k2", "text").mapInArrow(_pack_probes(buckets), _PACKED)
    dealt = packed.repartition("bucket").sortWithinPartitions("bucket", "kind")
    hits = stored(spark, dealt.mapInArrow(_find_hits(wide), _HITS), "anchor-hits")
    marks = _hits_by_document(hits, wide)

    texts = docs.select(k1.alias("k1"), k2.alias("k2"), t1.alias("t1"), t2.alias("t2"), F.col("doc_id").cast("bigint").alias("doc_id"))
    texts = texts.where("doc_id IS NOT NULL")
    firsts = texts.groupBy("t1", "t2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = stored(spark, firsts.where("first < last").select("t1", "t2", "first"), "anchor-copies")
    copies = texts.join(firsts, ["t1", "t2"]).where("doc_id > first").select("k1", "k2")
    known = (
        marks.select("k1", "k2", F.lit(False).alias("c"), "marks")
        .unionByName(copies.select("k1", "k2", F.lit(True).alias("c"), F.lit(None).cast("binary").alias("marks")))
        .groupBy("k1", "k2")
        .agg(F.max("c").alias("is_copy"), F.collect_set("marks").alias("marks"))
    )
    known = stored(spark, known, "anchor-marks")

    squeezed = rows.mapInArrow(_compressed, "k1 bigint, k2 bigint, doc_id bigint, packed binary")
    opened = squeezed.join(known, ["k1", "k2"], "left").select("doc_id", "packed", "is_copy", "marks")
    opened = stored(spark, opened.mapInArrow(_open_windows, _RESULT), "anchor-windows")
    waiting = opened.where("waiting IS NOT NULL")
    windows = waiting.select("doc_id", F.explode(F.arrays_zip("h1", "h2")).alias("w")).select("doc_id", "w.h1", "w.h2")
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    least = stored(spark, least.where("first < last").select("h1", "h2", "first"), "anchor-repeats")
    repeats = (
        windows.join(least, ["h1", "h2"])
        .where("doc_id > first")
        .groupBy("doc_id")
        .agg(F.collect_set("h1").alias("repeats"))
    )
    closed = waiting.select("doc_id", "n_words", "waiting").join(repeats, "doc_id", "left")
    closed = closed.mapInArrow(_close, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    done = opened.where("waiting IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return done.unionByName(closed)
