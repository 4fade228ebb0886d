"""The Markov models and the verdicts of the URL filter against plain Python."""

from __future__ import annotations

import math
from collections import Counter

from conftest import SMALL_DIR
from pyspark.sql import functions as F

from weir.llm import markov, url_filter
from weir.llm.common import read
from weir.llm.queries import QUERIES, URL_RULES

A = len(url_filter.ALPHABET) + 2
START = A - 1


def codes_of(text):
    return [url_filter.ALPHABET.find(c) + 1 for c in text.lower()]


def trigrams(text):
    codes = [START, START, *codes_of(text)]
    return list(zip(codes, codes[1:], codes[2:]))


class Model:
    """Witten-Bell over contexts of two symbols, of one, and of none."""

    def __init__(self, texts):
        self.tri = Counter(t for x in texts for t in trigrams(x))
        self.bi, self.uni = Counter(), Counter()
        self.after2, self.after1 = {}, {}
        for (a, b, c), n in self.tri.items():
            self.bi[b, c] += n
            self.uni[c] += n
            self.after2.setdefault((a, b), Counter())[c] += n
        for (b, c), n in self.bi.items():
            self.after1.setdefault(b, Counter())[c] += n

    def p(self, a, b, c):
        p = (self.uni[c] + 1) / (sum(self.uni.values()) + A)
        for seen in (self.after1.get(b), self.after2.get((a, b))):
            if seen:
                p = (seen[c] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p


def cut_of(scored, bins=200):
    """The smallest of the best bins; the cut is half way to the bin before it."""
    hist = {}
    for score, positive in scored:
        at = math.floor(max(-10.0, min(10.0, score)) * bins)
        hist.setdefault(at, [0, 0])[0 if positive else 1] += 1
    pos, neg = (sum(h[i] for h in hist.values()) for i in (0, 1))
    best, below, last = None, [0, 0], None
    for at in sorted(hist):
        merit = below[1] / neg - below[0] / pos
        if best is None or merit > best[0] + 1e-12:
            best = (merit, (at + (at if last is None else last)) / 2)
        below = [below[0] + hist[at][0], below[1] + hist[at][1]]
        last = at
    return best[1] / bins


def test_url_verdicts_by_brute_force(spark):
    pages = read(spark, SMALL_DIR, "pages")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    host, path = url_filter.host_and_path(F.col("url"))
    # which half of the samples a text belongs to is a hash that only Spark computes
    cells = markov.cells(F.lower(F.concat(host, path)), url_filter.ALPHABET)
    halves = {r.page_id: r.half for r in pages.select("page_id", markov._half(cells).alias("half")).collect()}
    texts = {i: r.host + r.path for i, r in got.items()}
    ruled = {i: r.verdict == "allow" for i, r in got.items() if r.rule is not None}
    models = {
        (half, positive): Model([texts[i] for i in ruled if halves[i] == half and ruled[i] == positive])
        for half in (0, 1)
        for positive in (True, False)
    }
    ratio = {}

    def score(i):
        total, other = 0.0, 1 - halves[i]
        for t in trigrams(texts[i]):
            if (other, t) not in ratio:
                ratio[other, t] = math.log(models[other, True].p(*t)) - math.log(models[other, False].p(*t))
            total += ratio[other, t]
        return total / len(texts[i]) if texts[i] else 0.0

    scores = {i: score(i) for i in texts}
    cut = cut_of([(scores[i], ruled[i]) for i in ruled])
    assert len(got) == pages.count() and 0 < len(ruled) < len(got)
    for i, r in got.items():
        assert abs(r.score - scores[i]) < 1e-9
        if r.rule is None:
            assert r.verdict == ("allow" if scores[i] >= cut else "block")
    whole = {r.page_id: r.verdict for r in QUERIES["op4_url_filter"](spark, SMALL_DIR).collect()}
    assert whole == {i: r.verdict for i, r in got.items()}
