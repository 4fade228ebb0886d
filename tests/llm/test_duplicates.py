"""Near duplicates, exact repeats and pieces, by brute force and on edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter, defaultdict
from sys import getsizeof

import numpy as np
import pytest
from conftest import SMALL_DIR
from pyspark.sql import functions as F

from weir.llm import block_anchors, components, dart_minhash, pieces
from weir.llm.common import read
from weir.llm.queries import PIECES, QUERIES


def words_of(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def shingle_set(text):
    w = (text or "").encode().split()
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:]))


def brute_classes(docs, threshold=0.8):
    """{doc_id: class} by all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    shared = Counter()
    for ids in held.values():
        shared.update(itertools.combinations(sorted(ids), 2))
    for (a, b), n in shared.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in sets}


def test_classes_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SMALL_DIR, "documents").collect()]
    got = dict(map(tuple, QUERIES["op3_dart_minhash"](spark, SMALL_DIR).collect()))
    assert got == brute_classes(docs)


@pytest.mark.parametrize("partners", [dart_minhash.PARTNERS, 4])
def test_classes_chain_and_hot_group(spark, monkeypatch, partners):
    monkeypatch.setattr(dart_minhash, "PARTNERS", partners)
    base = words_of(400, 1)
    docs, current = [], list(base)
    for i in range(40):  # a chain: each close to the one before only
        docs.append((1000 + i, " ".join(current)))
        for k in range(5):
            current[(i * 5 + k) * 2 % 400] = f"n{i}x{k}"
    for i in range(150):  # variants of one text
        near = list(words_of(300, 2))
        near[i] = f"v{i}"
        docs.append((5000 + i, " ".join(near)))
    docs += [(6000 + i, " ".join(words_of(60, 3) + words_of(200, 100 + i))) for i in range(60)]  # one passage
    rows = [(i, t, "x", i) for i, t in docs] + [(9000, docs[0][1], "x", 1), (9000, docs[0][1], "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, node string, first bigint")
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicate_classes(frame).collect()}
    assert got == brute_classes(docs + [(9000, docs[0][1])])
    kept = dart_minhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


@pytest.mark.parametrize("slots", [dart_minhash.SLOTS, 3])
def test_only_checked_texts_move(spark, monkeypatch, slots):
    """Ids outside the bitmap are never wanted; few slots let others pass and change no result."""
    monkeypatch.setattr(dart_minhash, "SLOTS", slots)
    ids = [*range(-300, 300), None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select(*dart_minhash._id_keys(F.col("doc_id")))
    some = rows.where("__dart_id % 50 = 7 OR __dart_null")
    marks = {(r["__dart_id"], r["__dart_null"]): r["__dart_maybe"] for r in dart_minhash._marked(rows, some).collect()}
    assert len(marks) == len(ids) and marks[0, True]
    wanted = {(i, False) for i in range(7, 300, 50)} | {(0, True)}
    assert all(marks[k] for k in wanted)
    assert {k for k, v in marks.items() if v} == wanted or slots == 3
    assert not any(r["__dart_maybe"] for r in dart_minhash._marked(rows, some.limit(0)).collect())
    near = words_of(200, 5)
    docs = [(i, " ".join(words_of(40, 900 + i))) for i in range(60)]
    docs += [(100 + i, " ".join([*near[:i], f"v{i}", *near[i + 1 :]])) for i in range(20)] + [(200, docs[3][1])]
    frame = spark.createDataFrame([*docs, docs[5], (None, docs[7][1]), (None, ""), (1, " ")], "doc_id bigint, text string")
    kept = Counter(tuple(r) for r in dart_minhash.keep_one(frame).collect())
    classes = brute_classes(docs)
    assert kept == Counter([d for d in docs if classes[d[0]] == d[0]] + [(None, ""), (1, " ")])


def test_signatures_of_texts_in_portions(monkeypatch):
    texts = [" ".join(words_of(n, n)) for n in (1, 90, 400, 30)] + [None, ""]
    whole = dart_minhash._sign(texts, True)
    monkeypatch.setattr(dart_minhash, "_SHINGLES_AT_ONCE", 100)
    assert [[m[0] for m in p] for p in dart_minhash._portions(texts)] == [[0, 1], [2], [3]]
    parts = dart_minhash._sign(texts, True)
    assert whole[1] == parts[1] and whole[0][4:] == parts[0][4:] == [None, None]
    assert all((a == b).all() for a, b in zip(whole[0][:4], parts[0][:4]))


def test_classes_on_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "a b c"), (None, "q r s t u v"), (7, "q r s t u v"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r.doc_id, r.class_id) for r in dart_minhash.near_duplicate_classes(frame).collect())
    assert got == Counter([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (None, 7), (7, 7), (None, None)])
    assert dart_minhash.near_duplicate_classes(frame.limit(0)).count() == 0
    assert dart_minhash.keep_one(frame).count() == 7


@pytest.mark.parametrize("weights", ["ones", "counts", "fractions"])
def test_signatures_estimate_weighted_similarity(weights):
    draw = np.random.default_rng(7)
    names = draw.integers(0, 2**63, 300).astype(np.uint64)
    a, b = {}, {}
    for i, n in enumerate(names):
        w = {"ones": 1.0, "counts": float(draw.integers(1, 5)), "fractions": float(draw.random() * 3 + 0.01)}[weights]
        if i < 250:
            a[n] = w
        if i > 40:
            b[n] = w if weights == "ones" else w * 0.5 + (0.5 if weights == "counts" else 0)
    exact = sum(min(a.get(n, 0), b.get(n, 0)) for n in names) / sum(max(a.get(n, 0), b.get(n, 0)) for n in names)
    triples = [(d, n, w) for d, x in enumerate((a, b)) for n, w in x.items()]
    docs, elements, w = (np.array([t[i] for t in triples], dt) for i, dt in enumerate((np.int64, np.uint64, float)))
    signed = dart_minhash.dart_signatures(docs, elements, w, 2, k=2000)
    assert abs((signed[0] == signed[1]).mean() - exact) < 0.05


def test_counted_elements_have_weighted_similarity():
    texts = ["a b c d e " * 4 + "f", "a b c d e " * 3 + "f g", "a b c d e f", "", None]
    for x in texts:
        for y in texts:
            one, two = (Counter(dart_minhash.shingles(t).tolist()) for t in (x, y))
            top = sum((one | two).values())
            expected = sum((one & two).values()) / top if top else 0.0
            got = dart_minhash.similarity(*(dart_minhash.elements(t, True) for t in (x, y)))
            assert got == pytest.approx(expected)
    assert dart_minhash.elements("a b c d e a b c d e a").tolist() == sorted(set(dart_minhash.shingles("a b c d e a b c d e a").tolist()))


def test_components_of_paths_and_stars(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)]
    edges += [(1000 + draw.randrange(60), 1000 + draw.randrange(60)) for _ in range(50)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(map(tuple, components.components(frame).collect()))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert components.components(frame.limit(0)).count() == 0


def brute_repeats(docs):
    """{doc_id: (n_words, n_removed, sha)} with one row per id."""
    first = {}
    split = {i: (t or "").encode().split() for i, t in docs}
    for i, w in split.items():
        for p in range(len(w) - 49):
            k = tuple(w[p : p + 50])
            first[k] = min(i, first.get(k, i))
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            if first[tuple(w[p : p + 50])] < i:
                gone[p : p + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("at_once", [1_000_000, 700])
def test_repeats_of_made_documents(spark, monkeypatch, at_once):
    monkeypatch.setattr(block_anchors, "_AT_ONCE", at_once)
    draw = random.Random(11)
    shared = [words_of(n, 50 + n) for n in (49, 50, 51, 60, 74, 75, 130, 400)]
    docs = []
    for i in range(120):
        parts = [words_of(draw.randrange(0, 90), 1000 + i)]
        for _ in range(draw.randrange(0, 3)):
            s = draw.choice(shared)
            a = draw.randrange(0, max(1, len(s) - 40))
            parts += [s[a : a + draw.randrange(40, len(s) + 1)], words_of(draw.randrange(0, 40), draw.random())]
        docs.append((i * 3, " ".join(w for p in parts for w in p)))
    docs += [(1001, docs[7][1]), (1002, docs[7][1]), (1003, "z " * 3000), (1004, "z " * 90), (1005, None), (1006, "")]
    docs.append((1007, docs[20][1] + "\n" + docs[30][1]))
    frame = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id bigint, text string, k1 int")
    got = {r.doc_id: tuple(r)[1:] for r in block_anchors.remove_repeats(frame).collect()}
    assert got == brute_repeats(docs)


def test_repeats_on_edges(spark):
    text = " ".join(words_of(80, 1))
    rows = [(1, text), (1, text), (None, text), (2, text), (2, text + " x"), (3, text.replace(" ", " "))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in block_anchors.remove_repeats(frame).collect())
    assert got == Counter([(1, 80, 0), (1, 80, 0), (None, 80, 0), (2, 80, 80), (2, 81, 80), (3, 1, 0)])
    assert block_anchors.remove_repeats(frame.limit(0)).count() == 0


def test_repeats_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SMALL_DIR, "documents").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op9_block_anchors"](spark, SMALL_DIR).collect()}
    assert got == brute_repeats(docs)


@pytest.fixture(scope="module")
def model():
    with open(PIECES, "rb") as f:
        return pieces.Model(f.read())


def test_pieces_equal_the_library(spark, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    draw = random.Random(3)
    some = ["a", "b", "e", "t", "ing", " ", "  ", "é", "ß", "\n", "\t", "𝒳", "\0", "==", "-", "1", "日", " the", "tion", "."]
    texts = ["".join(draw.choice(some) for _ in range(draw.randrange(40))) for _ in range(3000)]
    texts += ["", " " * 1000, "-" * 777, "a" * 5000, "the" * 3000, "=" * 501 + " x", "é" * 300]
    for text in texts:
        ids = model.encode(text).tolist()
        assert ids == library.encode(text)
        assert list(pieces.stream(model, [model.marked(text)])) == ids
        assert model.decode(ids) == text
    for r in QUERIES["op10_pieces"](spark, SMALL_DIR).join(read(spark, SMALL_DIR, "documents"), "doc_id").collect():
        assert r.ids == library.encode(r.text) and r.n_tokens == len(r.ids) and r.round_trip


def test_stream_holds_a_bounded_window(model):
    """Ids come out while the text still goes in, whatever the chunks."""
    text = "internationalization" * 400
    taken = [0]

    def chunks():
        for at in range(0, len(text), 7):
            taken[0] += 1
            yield text[at : at + 7]

    out, lags = [], []
    for i in pieces.stream(model, chunks()):
        out.append(i)
        lags.append(taken[0] * 7 - sum(len(model.pieces[x]) for x in out))
    assert out == list(pieces.stream(model, [text]))
    assert max(lags) <= 12 * model.longest


def test_viterbi_for_a_unigram_model():
    """Best sum of scores, against all segmentations."""
    draw = random.Random(6)
    vocab = {p: -draw.random() * 5 for p in ["a", "b", "c", "ab", "bc", "abc", "ca", "cab", "bb"]}
    m = object.__new__(pieces.Model)
    m.ids = {p: i for i, p in enumerate(vocab)}
    m.pieces, m.scores = list(vocab), list(vocab.values())
    m.merges, m.longest, m.least, m.bytes, m.unknown = False, 3, -20.0, {}, 99
    m.tree = {}
    for p, i in m.ids.items():
        tree = m.tree
        for c in p:
            node = tree.setdefault(c, [-1, {}])
            tree = node[1]
        node[0] = i

    def best(text):
        scores = [0.0]
        for end in range(1, len(text) + 1):
            scores.append(max(scores[s] + vocab[text[s:end]] for s in range(end) if text[s:end] in vocab))
        return scores[-1]

    for n in range(1, 120):
        text = "".join(draw.choice("abc") for _ in range(n))
        ids = list(pieces.stream(m, [text]))
        assert "".join(m.pieces[i] for i in ids) == text
        assert abs(sum(m.scores[i] for i in ids) - best(text)) < 1e-9
    assert list(pieces.stream(m, ["xa"])) == [99, m.ids["a"]]


def test_pieces_remember_within_their_bytes(model, monkeypatch):
    """Also inside one text; what has been forgotten is found again."""
    limit = 200_000
    monkeypatch.setattr(pieces, "REMEMBERED", limit)
    monkeypatch.setattr(pieces, "PAIRS", 50)
    monkeypatch.setattr(model, "_parts", pieces._Parts(model))
    text = " ".join(f"w{i * i}q" for i in range(5000)) + " " + "x" * limit
    expected = list(pieces.stream(model, [model.marked(text)]))
    for _ in range(2):
        assert model.encode(text).tolist() == expected
        kept = [model._parts, model._parts.older]
        held = sum(getsizeof(x) for d in kept for x in [d, *d, *d.values()])
        assert limit / 2 < held < 2.5 * limit
        assert sum(map(len, model._follow.values())) <= 50


def merged(m, *some):
    *_, (_, parts) = pieces.merging("".join(some), m.ids, m.scores)
    return parts


def test_pairs_by_their_borders_equal_merging(model):
    """Also with runs of spaces, whose scores are equal, and with scores that do not fall."""
    draw = random.Random(8)
    spaces = [i for i in model.ids.values() if not model.pieces[i].strip(pieces.MARK)]
    short = [i for i in model.ids.values() if len(model.pieces[i]) < 4 and model.pieces[i].isascii()]
    pairs = [(a, b) for a in spaces for b in spaces] + [(draw.choice(short), draw.choice(short)) for _ in range(5000)]
    for _ in range(40):
        m = object.__new__(pieces.Model)
        m.pieces = [*"abc", *{"".join(draw.choices("abc", k=draw.randrange(2, 5))) for _ in range(25)}]
        m.ids = {p: i for i, p in enumerate(m.pieces)}
        m.scores = [float(-draw.randrange(20)) for _ in m.pieces]
        m._sides = {}
        for a in m.ids.values():
            for b in m.ids.values():
                assert m._apart(a, b) == (merged(m, m.pieces[a], m.pieces[b]) == [m.pieces[a], m.pieces[b]])
    for a, b in pairs:
        assert model._apart(a, b) == (merged(model, model.pieces[a], model.pieces[b]) == [model.pieces[a], model.pieces[b]])


def test_pieces_are_merged_once_not_once_a_pair(monkeypatch):
    with open(PIECES, "rb") as f:
        fresh = pieces.Model(f.read())
    calls, merging = [], pieces.merging
    monkeypatch.setattr(pieces, "merging", lambda *a: calls.append(a[0]) or merging(*a))
    draw = random.Random(9)
    text = " ".join("".join(draw.choices(["con", "ter", "ing", "sta", "pre", "le", "o"], k=4)) for _ in range(3000))
    assert fresh.decode(fresh.encode(text)) == text
    assert len(calls) == len(set(calls)) < fresh._pairs / 3


def test_pieces_on_edges(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "a  b", 5), (3, "x " * 20_000, 5), (3, "x " * 20_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = pieces.encode_documents(docs, PIECES)
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1].ids, got[1].n_tokens, got[2].ids, got[2].round_trip) == (None, 0, [], True)
    assert out.count() == 5 and got[None].round_trip and got[3].round_trip
    texts = {r.doc_id: r.text for r in pieces.decode_documents(out, PIECES).collect()}
    assert texts == {i: t for i, t, _ in rows}
    assert pieces.encode_documents(docs.limit(0), PIECES).count() == 0
