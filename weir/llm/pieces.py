"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice has a node per character boundary; an edge is a piece of the vocabulary.
For a unigram model the best path has the largest sum of scores. For a BPE model the
path must be the one that merging makes: an edge may follow another only where
merging the two pieces' text gives back exactly these two, and then every prefix has
one path. Characters without a piece become their bytes.

An automaton over the pieces (Aho-Corasick) reads the text once: its state after a
character is the longest end of the text so far that begins a piece, and lists all pieces
that end there, so each boundary looks at these edges only, the longest first.

The search keeps a window: only paths that end in a boundary within the automaton's state
survive, as later pieces start there. Whenever the window has grown to four times
``longest``, the longest piece, the backpointers of all of them are followed back; the ids
before the boundary in which they meet are final and leave the window.

Some of these boundaries are known from the vocabulary alone, as no piece spans the two
characters there: before a run of space marks, and between a letter and a character
(most punctuation) that no piece has after one. No path depends on what lies beyond, so
the search may start anew there, and what it found for a part of a text is remembered
by each worker, within a number of bytes (``REMEMBERED``) that holds inside a text, too.
Parts of any length go through the window.

Defined cases: NULL text gives NULL ids; empty text no ids; repeated rows are encoded
alike; an empty table gives an empty result; other columns are not read. A literal
U+2581 in a text comes back as a space, as the format asks.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import kept

MARK = "▁"
#: Bytes of memory for the parts that a worker remembers, in each of two generations, a
#: part's place in the dictionary counted as ``ENTRY``; and the number of pairs of pieces.
REMEMBERED, ENTRY = 32_000_000, 64
PAIRS = 300_000
#: Characters that enter the window at once.
CHUNK = 4096
_NEVER = float("-inf")
SCHEMA = "doc_id bigint, ids array<int>, n_tokens bigint, round_trip boolean"


class Model:
    """Pieces of a model file, and whether it merges (BPE) or scores (unigram)."""

    def __init__(self, proto: bytes):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.normalize = p.normalize
        self.ids: dict[str, int] = {}
        self.pieces = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.scores = [p.get_score(i) for i in range(len(self.pieces))]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces)) if p.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.hidden = {i for i in range(len(self.pieces)) if p.is_control(i)}
        self.special = np.zeros(len(self.pieces), bool)
        self.special[[*self.byte_of, *self.hidden]] = True
        self.unknown = p.unk_id()
        for i, piece in enumerate(self.pieces):
            if i not in self.byte_of and i not in self.hidden and i != self.unknown and not p.is_unused(i):
                self.ids[piece] = i
        self.longest = max(map(len, self.ids), default=1)
        self.least = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10
        # a merging model scores by rank: whole numbers, none twice but for runs of spaces
        self.merges = all(float(self.scores[i]).is_integer() for i in self.ids.values())
        self.plain = p.normalize(" a  b ") == f"{MARK}{MARK}a{MARK}{MARK}b "
        crossing = any(MARK in x.lstrip(MARK) for x in self.ids)
        self.cuts = None if crossing else _cuts(self.ids)
        self._follow: dict[int, dict[int, bool]] = {}
        self._pairs = 0
        self._sides: dict[int, tuple] = {}
        self._parts = _Parts(self)

    @cached_property
    def root(self) -> tuple:
        """The automaton's first state. A state has the states by the next character, the
        state of its longest shorter end, (characters, id) of the pieces that end in it,
        the longest first, and its number of characters."""
        tree: dict = {}
        for piece, i in self.ids.items():
            node = tree
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = i
        root: tuple = ({}, None, (), 0)
        level = [(tree, root)]
        while level:  # shorter states first, as the others refer to them
            above, level = level, []
            for node, state in above:
                for char, below in node.items():
                    if char:
                        end, size = state[1], state[3] + 1
                        while end is not None and char not in end[0]:
                            end = end[1]
                        end = root if end is None else end[0][char]
                        ends = ((size, below[""]), *end[2]) if "" in below else end[2]
                        state[0][char] = ({}, end, ends, size)
                        level.append((below, state[0][char]))
        return root

    def follows(self, before: int, piece: int) -> bool:
        """Whether merging the text of both gives exactly these two pieces."""
        known = self._follow.setdefault(before, {})
        free = known.get(piece)
        if free is None:
            if self._pairs >= PAIRS:
                self._follow.clear()
                self._pairs, known = 0, self._follow.setdefault(before, {})
            free = known[piece] = self._apart(before, piece)
            self._pairs += 1
        return free

    def _apart(self, before: int, piece: int) -> bool:
        """Both merge on their own side by side, in order of score, the left one first of
        equals, unless the parts at their border have a better score before that."""
        left, right = self._edges(before)[1], self._edges(piece)[0]
        if left is None or right is None:
            pair = [self.pieces[before], self.pieces[piece]]
            *_, (_, parts) = merging("".join(pair), self.ids, self.scores)
            return parts == pair
        i = j = 0
        while True:
            both = self.ids.get(left[i][1] + right[j][1])
            a = left[i + 1][0] if i + 1 < len(left) else _NEVER
            b = right[j + 1][0] if j + 1 < len(right) else _NEVER
            if both is not None and (self.scores[both] > a if a >= b else self.scores[both] >= b):
                return False
            if a == b == _NEVER:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def _edges(self, piece: int) -> tuple[tuple | None, tuple | None]:
        """The first parts of a piece while it is merged, and the last ones, each with the
        score of its merge; None if the piece does not come back, or not by falling score."""
        found = self._sides.get(piece)
        if found is None:
            steps = [(s, p[0], p[-1], len(p)) for s, p in merging(self.pieces[piece], self.ids, self.scores)]
            if steps[-1][3] > 1 or any(a[0] < b[0] for a, b in zip(steps, steps[1:])):
                found = None, None
            else:
                found = tuple(
                    tuple((s[0], s[k]) for n, s in enumerate(steps) if not n or s[k] != steps[n - 1][k])
                    for k in (1, 2)
                )
            self._sides[piece] = found
        return found

    def fallback(self, char: str) -> list[int]:
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]

    def marked(self, text: str) -> str:
        if self.plain:
            return MARK + text.replace(" ", MARK) if text else ""
        return self.normalize(text)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as 32-bit integers."""
        marked = self.marked(text)
        parts = [marked] if self.cuts is None else self.cuts.findall(marked)
        return np.frombuffer(b"".join(map(self._parts.__getitem__, parts)), np.int32)

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        parts: list[str] = []
        if not self.special[ids].any():
            parts, ids = list(map(self.pieces.__getitem__, ids.tolist())), ids[:0]
        pending = bytearray()
        for i in ids.tolist():
            byte = self.byte_of.get(i)
            if byte is not None:
                pending.append(byte)
                continue
            if pending:
                parts.append(pending.decode("utf-8", "replace"))
                pending = bytearray()
            parts.append("" if i in self.hidden else self.pieces[i])
        parts.append(pending.decode("utf-8", "replace"))
        text = "".join(parts).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


class _Parts(dict):
    """Ids, as bytes, of parts of texts that have come up. At the limit the parts
    become the older generation; of those before it, only the ones met again stay."""

    def __init__(self, model: Model):
        self.model, self.held = model, 0
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            chunks = (part[i : i + CHUNK] for i in range(0, len(part), CHUNK))
            found = array("i", stream(self.model, chunks)).tobytes()
        size = getsizeof(part) + getsizeof(found) + ENTRY
        if size > REMEMBERED:
            return found
        if self.held + size > REMEMBERED:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self[part] = found
        self.held += size
        return found


def _cuts(ids) -> re.Pattern:
    """Pattern of the parts between certain boundaries: before space marks, and between
    a letter or digit and an ASCII character that no piece has right after one."""
    after = {b for x in ids for a, b in zip(x, x[1:]) if re.match(_ALNUM, a)}
    free = {c for x in ids for c in x if not re.match(_ALNUM, c)} | set("\t\n\r")
    tail = "".join(map(re.escape, sorted(c for c in free - after - {MARK} if c.isascii())))
    head = f"{MARK}*+{_ALNUM}++(?=[{tail}])|" if tail else ""
    return re.compile(f"{head}{MARK}*+[^{MARK}]++|{MARK}++")


_ALNUM = r"[^\W_]"


def merging(text: str, ids: dict[str, int], scores: list[float]) -> Iterator[tuple[float, list[str]]]:
    """The parts of a text while it is merged, neighbours with the best score first, the
    left ones of equals; with the score of the last merge. For a piece or two."""
    parts = list(text)

    def rank(i: int) -> float:
        both = ids.get(parts[i] + parts[i + 1])
        return _NEVER if both is None else scores[both]

    ranks = [rank(i) for i in range(len(parts) - 1)]
    yield float("inf"), parts
    while ranks and (best := max(ranks)) > _NEVER:
        i = ranks.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = rank(i)
        if i:
            ranks[i - 1] = rank(i - 1)
        yield best, parts


def stream(model: Model, chunks: Iterable[str]) -> Iterator[int]:
    """Ids of the text that the chunks make up, as soon as they are final."""
    return chain.from_iterable(_final(model, chunks))


def _final(model: Model, chunks: Iterable[str]) -> Iterator[list[int]]:
    longest, extend, state = model.longest, _merged if model.merges else _scored, model.root
    text = ""  # the window's, from the last final boundary on
    back: list[int] = [0]  # by boundary in the window: where its last piece starts
    last: list[int] = [-1]  # that piece; -1 for bytes
    score: list[float] = [0.0]
    for chunk in chunks:
        text += chunk
        base, end, final = len(back) - 1, len(text), 0
        while base < end:
            # up to where the window is full; then further if the paths have not met
            to = min(end, max(final + 4 * longest, base + longest))
            state = extend(model, text, base, to, state, back, last, score)
            base = to
            if base >= final + 4 * longest:
                meet = _meeting(back, base, state[3])
                if meet > final:
                    yield _path(model, text, back, last, final, meet)
                    final = meet
        if final:
            text = text[final:]
            back = [max(0, b - final) for b in back[final:]]
            last, score = last[final:], score[final:]
    if text:
        yield _path(model, text, back, last, 0, len(text))


def _merged(model: Model, text: str, at: int, end: int, state: tuple, back, last, score) -> tuple:
    """Find the last piece of the paths to the boundaries after ``at`` up to ``end``, for a
    merging model: the first, from the longest, that may follow. Returns the state there."""
    known, none = model._follow, {}
    for char in text[at:end]:
        at += 1
        after = state[0].get(char)
        while after is None and state[1] is not None:
            state = state[1]
            after = state[0].get(char)
        if after is not None:
            state = after
        for size, i in state[2]:
            previous = last[at - size]
            if previous >= 0:
                free = known.get(previous, none).get(i)
                if not (model.follows(previous, i) if free is None else free):
                    continue
            back.append(at - size)
            last.append(i)
            break
        else:  # no piece, or none that merging leaves: bytes
            back.append(at - 1)
            last.append(-1)
    return state


def _scored(model: Model, text: str, at: int, end: int, state: tuple, back, last, score) -> tuple:
    """The same for a unigram model: a boundary keeps the piece with the best sum."""
    scores = model.scores
    for char in text[at:end]:
        at += 1
        after = state[0].get(char)
        while after is None and state[1] is not None:
            state = state[1]
            after = state[0].get(char)
        if after is not None:
            state = after
        start, piece, best = at - 1, -1, _NEVER
        for size, i in state[2]:
            if score[at - size] + scores[i] > best:
                start, piece, best = at - size, i, score[at - size] + scores[i]
        if char not in model.ids and score[at - 1] + model.least > best:
            start, piece, best = at - 1, -1, score[at - 1] + model.least
        back.append(start)
        last.append(piece)
        score.append(best)
    return state


def _meeting(back: list[int], base: int, survive: int) -> int:
    """The boundary in which the paths of all surviving boundaries meet: ``base`` and as
    many before it."""
    alive = set(range(base - survive, base + 1))
    while len(alive) > 1:
        end = max(alive)
        alive.remove(end)
        alive.add(back[end])
    return alive.pop()


def _path(model: Model, text: str, back, last, start: int, end: int) -> list[int]:
    ids: list[int] = []
    while end > start:
        piece = last[end]
        if piece < 0:
            ids += reversed(model.fallback(text[end - 1]))
        else:
            ids.append(piece)
        end = back[end]
    ids.reverse()
    return ids


def _model(proto: bytes) -> Model:
    """The model of this worker process, which keeps what it has remembered from task to
    task, until tasks of another operator let it go; a worker holds one."""
    return kept(("pieces", hashlib.sha256(proto).digest()), lambda: Model(proto))


def _lists(ids: list) -> pa.Array:
    """Arrays of ids as one Arrow array; None stays NULL."""
    flat = np.concatenate([np.zeros(0, np.int32), *(i for i in ids if i is not None)])
    ends = np.cumsum([0, *(0 if i is None else len(i) for i in ids)]).astype(np.int32)
    offsets = pa.array(ends, mask=np.array([*(i is None for i in ids), False]))
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip) of every document. The model is read on the
    driver and travels with the tasks; its size is that of its file."""
    with open(model_file, "rb") as f:
        proto = f.read()

    def run(batches):
        model = _model(proto)
        for part in batches:
            texts = part.column("text").to_pylist()
            ids = [None if t is None else model.encode(t) for t in texts]
            same = [None if t is None else model.decode(i) == t for t, i in zip(texts, ids)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    _lists(ids),
                    pa.array([0 if i is None else len(i) for i in ids], pa.int64()),
                    pa.array(same, pa.bool_()),
                ],
                ["doc_id", "ids", "n_tokens", "round_trip"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, SCHEMA)


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) back from ids."""
    with open(model_file, "rb") as f:
        proto = f.read()

    def run(batches):
        model = _model(proto)
        for part in batches:
            texts = [None if i is None else model.decode(i) for i in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
