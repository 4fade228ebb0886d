"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Tokens of either side that share a byte are linked;
the groups are the components of these links. Every token points to its farthest-right
overlapping token: one of the other side, which ends at the same byte or later. Where
both end together, the token of the first side is the end of the chain. Doubling
(each token takes its successor's successor, for all tokens of many documents in one
array operation) ends after a number of rounds that is the logarithm of the longest
chain; every token then holds the terminal token of its component, the group's label.

Each link is rated by its pair of ids: how many links of the corpus hold it.

Scale: texts are encoded once. A task gathers the links of some documents into a block
(``BLOCK`` of them, told apart by document), whose distinct pairs are numbered; a
document keeps these numbers. Pairs are counted over the blocks, and the counts go back
to the blocks, not to each document's links. Blocks and documents meet in a sorted
stream; a task holds the counts of one block. The highest count of each id of the second
side is one row per entry of its vocabulary, and only that is broadcast. A text takes
memory in proportion to its length.

Defined cases: texts that are NULL or empty, or that either side does not give back byte
by byte, have no tokens: zeros and no groups; repeated rows are rows of their own, whose
links all count; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import stored

MARK = "▁"
BLOCK = 1 << 20
SLICE = 1 << 18  # characters that are encoded and aligned at once, at least one text
#: Fixed value: how byte-level models split texts before merging.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones of
    Latin-1 stand for themselves, the others for the rest in order from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bytes:
    """A byte-level model; a text is encoded after a space.

    Where ids follow the order of merges, the vocabulary is also a table of ranks, which
    is searched several times as fast; both ways give the same ids. The split pattern of
    that way needs a stack for each blank of a run, so texts with long runs of blanks go
    the other way.
    """

    LONG_BLANK = re.compile(r"\s{2000}")

    def __init__(self, model: bytes):
        described = json.loads(model)
        alphabet = byte_alphabet()
        vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
        added = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        self.tokens = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
        for token, i in [*vocabulary.items(), *added.items()]:
            known = all(c in alphabet for c in token)
            self.tokens[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self._model, self._tokenizer, self._ranks = model, None, None
        joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        first = len(alphabet)
        by_rank = all(vocabulary.get(token) == first + i for i, token in enumerate(joined))
        split = described.get("pre_tokenizer") or {}
        if by_rank and not described.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex"):
            import tiktoken

            ranks = {self.tokens[i]: i for i in range(first + len(merges))}
            self._ranks = tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        spaced = [" " + t for t in texts]
        if self._ranks is None:
            return self._by_merges(spaced)
        slow = [i for i, t in enumerate(spaced) if len(t) >= 2000 and self.LONG_BLANK.search(t)]
        if not slow:
            return [self._ranks.encode_ordinary(t) for t in spaced]
        ids = dict(zip(slow, self._by_merges([spaced[i] for i in slow])))
        return [ids[i] if i in ids else self._ranks.encode_ordinary(t) for i, t in enumerate(spaced)]

    def _by_merges(self, texts: list[str]) -> list[list[int]]:
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_str(self._model.decode("utf-8"))
            self._tokenizer.encode_special_tokens = True
        done = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in done]


class Pieces:
    """A piece model, which adds the space itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = [
            bytes([int(p.id_to_piece(i)[3:5], 16)])
            if p.is_byte(i)
            else p.id_to_piece(i).replace(MARK, " ").encode("utf-8")
            for i in range(p.get_piece_size())
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For every token, first those of side a, then of b: the terminal token (a number
    of side a) of its component. Both sides end at the same byte."""
    n = len(a_end)
    over = np.searchsorted(b_end, a_end)  # the token of b with a's last byte
    jump = np.concatenate(
        [np.where(b_end[over] > a_end, n + over, np.arange(n)), np.searchsorted(a_end, b_end)]
    )
    while True:
        farther = jump[jump]
        if np.array_equal(farther, jump):
            return jump
        jump = farther


class Aligner:
    """Both models, and the alignment of many texts at once."""

    def __init__(self, byte_model: bytes, piece_model: bytes):
        self.a, self.b = Bytes(byte_model), Pieces(piece_model)
        self.a_size = np.array([len(t) for t in self.a.tokens], np.int64)
        self.b_size = np.array([len(t) for t in self.b.tokens], np.int64)
        # ids as text, with what follows them: the same side, the other side or group
        self.shown = np.array(
            [f"{i}{mark}" for n, marks in ((len(self.a_size), ",|"), (len(self.b_size), ",;")) for mark in marks for i in range(n)],
            object,
        )

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where either differs from the text."""
        a, b = self.a.encode(texts), self.b.encode(texts)
        for i, text in enumerate(texts):
            raw = (" " + text).encode("utf-8")
            if any(
                b"".join(map(side.tokens.__getitem__, ids)) != raw for side, ids in ((self.a, a[i]), (self.b, b[i]))
            ):
                a[i], b[i] = [], []
        return a, b

    def align(self, texts: list[str]):
        """Yields one ``Aligned`` for all texts given."""
        a, b = self.encode(texts)
        return Aligned(self, a, b)


class Aligned:
    """Groups and links of some texts, whose bytes are laid end to end."""

    def __init__(self, models: Aligner, a: list[list[int]], b: list[list[int]]):
        self.models = models
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (
            np.fromiter(chain.from_iterable(side), np.int64, int(n.sum()))
            for side, n in ((a, self.n_a), (b, self.n_b))
        )
        a_size, b_size = models.a_size[self.a], models.b_size[self.b]
        self.a_end, self.b_end = np.cumsum(a_size), np.cumsum(b_size)
        self.a_doc, self.b_doc = (np.repeat(np.arange(len(n)), n) for n in (self.n_a, self.n_b))
        label = terminals(self.a_end, self.b_end) if len(self.a) else np.zeros(0, np.int64)
        n = len(self.a)
        last = np.flatnonzero(label[:n] == np.arange(n))  # one terminal per group
        group = np.searchsorted(last, label)
        self.a_group, self.b_group = group[:n], group[n:]
        self.n_groups = np.bincount(self.a_doc[last], minlength=len(self.n_a))
        low = np.searchsorted(self.b_end, self.a_end - a_size, "right")
        high = np.searchsorted(self.b_end, self.a_end)
        self._low, self._many = low, high - low + 1
        self.n_links = np.bincount(self.a_doc, weights=self._many, minlength=len(self.n_a)).astype(np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers (a, b) of all pairs that share a byte."""
        one = np.repeat(np.arange(len(self.a)), self._many)
        ends = np.cumsum(self._many)
        other = np.arange(len(one)) - np.repeat(ends - self._many, self._many) + self._low[one]
        return one, other

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair of ids, links) for each distinct pair of a document, in order;
        a pair is a's id times the size of b's vocabulary, and b's id."""
        width = len(self.models.b_size)
        one, other = self.links()
        pair = self.a[one] * width + self.b[other]
        if len(self.n_a) == 1:
            pairs, n = np.unique(pair, return_counts=True)
            return np.zeros(len(pairs), np.int64), pairs, n
        span = width * len(self.models.a_size)
        both, n = np.unique(self.a_doc[one] * span + pair, return_counts=True)
        return both // span, both % span, n

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text: the ids of both sides by group."""
        m = self.models
        n_a, n_b = len(m.a_size), len(m.b_size)
        before = np.searchsorted(self.b_group, self.a_group)  # tokens of b in earlier groups
        after = np.searchsorted(self.a_group, self.b_group, "right")
        same_a = np.r_[self.a_group[1:] == self.a_group[:-1], False][: len(self.a)]
        same_b = np.r_[self.b_group[1:] == self.b_group[:-1], False][: len(self.b)]
        shown = np.empty(len(self.a) + len(self.b), np.int64)
        shown[np.arange(len(self.a)) + before] = self.a + np.where(same_a, 0, n_a)
        shown[np.arange(len(self.b)) + after] = self.b + 2 * n_a + np.where(same_b, 0, n_b)
        parts = m.shown[shown].tolist()
        ends = np.cumsum(self.n_a + self.n_b)
        begins = ends - self.n_a - self.n_b
        return ["".join(parts[i:j])[:-1] for i, j in zip(begins.tolist(), ends.tolist())]


def _slices(texts: list[str | None]) -> Iterator[list[int]]:
    """Numbers of texts that are not empty, about ``SLICE`` characters at a time."""
    held, size = [], 0
    for i, text in enumerate(texts):
        if text:
            held.append(i)
            size += len(text)
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def groups(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """(doc_id, groups) with the ids of both sides by group, as text; NULL without tokens."""
    models = _read(byte_file), _read(piece_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*models)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            shown: list[str | None] = [None] * len(texts)
            for chosen in _slices(texts):
                for i, text in zip(chosen, aligner.align([texts[i] for i in chosen]).groups()):
                    shown[i] = text or None
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shown, pa.string())], ["doc_id", "groups"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, groups string")


_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_DOC_TYPES = [pa.int64()] * 5 + [pa.string()]
_BLOCKS = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "numbers binary, times binary, block bigint, pair bigint, number int, n bigint"
)


def blocks(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Rows of two kinds. Of a document: its figures and the numbers of its pairs in the
    block, with how many links hold each. Of a block (``pair`` is set): its distinct
    pairs with their numbers."""
    models = _read(byte_file), _read(piece_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task, nth = Aligner(*models), TaskContext.get(), 0
        part = task.partitionId() if task else 0
        rows: list[tuple] = []
        pairs: list[np.ndarray] = []
        times: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = part << 32 | nth
            distinct, numbers = np.unique(np.concatenate(pairs), return_inverse=True)
            every = np.concatenate(times)
            ends = np.cumsum([len(x) for x in pairs])[:-1]
            totals = np.bincount(numbers, weights=every).astype(np.int64)
            yield _batch(
                [pa.array(c, t) for c, t in zip(zip(*rows), _DOC_TYPES)]
                + [
                    pa.array([x.tobytes() for x in np.split(numbers.astype("<u4"), ends)], pa.binary()),
                    pa.array([x.tobytes() for x in np.split(every.astype("<u4"), ends)], pa.binary()),
                    pa.array(np.full(len(rows), block)),
                ]
            )
            yield _batch([None] * 8 + [np.full(len(distinct), block), distinct, np.arange(len(distinct), dtype=np.int32), totals])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            unread = set(range(len(texts)))
            for chosen in _slices(texts):
                aligned = aligner.align([texts[i] for i in chosen])
                doc, pair, n = aligned.pairs()
                edges = np.searchsorted(doc, np.arange(len(chosen) + 1)).tolist()
                shown = aligned.groups()
                for k, i in enumerate(chosen):
                    if not shown[k]:
                        continue
                    unread.discard(i)
                    digest = hashlib.sha256(shown[k].encode()).hexdigest()
                    rows.append((ids[i], *(int(x[k]) for x in (aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links)), digest))
                    pairs.append(pair[edges[k] : edges[k + 1]])
                    times.append(n[edges[k] : edges[k + 1]])
                    size += edges[k + 1] - edges[k]
                if size >= BLOCK:
                    yield from flush()
                    nth, size = nth + 1, 0
                    rows, pairs, times = [], [], []
            none = sorted(unread)
            if none:
                zeros = np.zeros(len(none), np.int64)
                yield _batch([pa.array([ids[i] for i in none], pa.int64()), *[zeros] * 4, [""] * len(none)])
        if rows:
            yield from flush()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, _BLOCKS)


_NAMES = [*_DOC, "numbers", "times", "block", "pair", "number", "n"]
_TYPES = [*_DOC_TYPES, pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def _batch(columns: list) -> pa.RecordBatch:
    """A batch of all columns; those not given, or None, are NULL."""
    n = len(next(c for c in columns if c is not None))
    columns = [*columns, *[None] * (len(_NAMES) - len(columns))]
    arrays = [pa.nulls(n, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, _TYPES)]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def pair_counts(found: DataFrame, vocabulary: int) -> DataFrame:
    """(pair, a_id, b_id, links) over the corpus, from ``blocks``; ``vocabulary`` is the
    size of the second side's."""
    counted = found.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("links"))
    b_id = F.col("pair") % vocabulary
    return counted.select("pair", ((F.col("pair") - b_id) / vocabulary).cast("int").alias("a_id"), b_id.cast("int").alias("b_id"), "links")


def align(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    import sentencepiece

    spark = docs.sparkSession
    vocabulary = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    found = stored(spark, blocks(docs, byte_file, piece_file), "align-blocks")
    counts = stored(spark, pair_counts(found, vocabulary), "align-pairs")
    highest = counts.groupBy("b_id").agg(F.max("links").alias("highest"))  # one row per id of b
    rated = counts.join(F.broadcast(highest), "b_id").select(
        "pair", "links", (F.col("links") == F.col("highest")).alias("best")
    )
    of_blocks = found.where("pair IS NOT NULL").select("block", "pair", "number").join(rated, "pair").drop("pair")
    of_docs = found.where("pair IS NULL AND block IS NOT NULL").select("block", *_DOC, "numbers", "times")
    met = of_blocks.unionByName(of_docs, allowMissingColumns=True)
    met = met.repartition("block").sortWithinPartitions("block", F.col("number").asc_nulls_last())
    summed = met.mapInArrow(
        _sum_links,
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "n_best bigint, count_sum bigint",
    )
    none = found.where("block IS NULL").select(
        *_DOC, F.lit(0).cast("bigint").alias("n_best"), F.lit(0).cast("bigint").alias("count_sum")
    )
    return summed.unionByName(none).select(*_DOC[:-1], "n_best", "count_sum", "groups_sha256")


def _sum_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads, block by block, the rated pairs by number and then the documents."""
    current, links, best = None, [], []
    for batch in batches:
        block = batch.column("block").to_numpy(zero_copy_only=False)
        of_doc = batch.column("number").is_null().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (of_doc[1:] != of_doc[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
            if start == end:
                continue
            if block[start] != current:
                current, links, best = block[start], [], []
            part = batch.slice(start, end - start)
            if not of_doc[start]:
                links.append(part.column("links").to_numpy(zero_copy_only=False))
                best.append(part.column("best").to_numpy(zero_copy_only=False))
                continue
            links, best = [np.concatenate(links)], [np.concatenate(best)]
            numbers = [np.frombuffer(x, "<u4") for x in part.column("numbers").to_pylist()]
            times = np.frombuffer(b"".join(part.column("times").to_pylist()), "<u4").astype(np.int64)
            ends = np.cumsum([len(x) for x in numbers])
            every = np.concatenate(numbers)
            sums = [np.diff(np.r_[0, np.cumsum(x * times)[ends - 1]]) for x in (best[0][every], links[0][every])]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in _DOC], *[pa.array(x.astype(np.int64)) for x in sums]],
                [*_DOC, "n_best", "count_sum"],
            )
