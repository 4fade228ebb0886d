"""Personal data against the patterns as they are written, on fixtures and by brute force."""

from __future__ import annotations

import hashlib
import re

import pytest
from conftest import SMALL_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from weir.llm import pii
from weir.llm.common import read
from weir.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def naive(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def base(text):
    return [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS]


def test_query_by_brute_force(spark):
    texts = {r.doc_id: r.text for r in read(spark, SMALL_DIR, "documents").collect()}
    rows = QUERIES["op12_pii"](spark, SMALL_DIR).collect()
    assert len(rows) == len(texts)
    total = 0
    for r in rows:
        expected = naive(texts[r.doc_id] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in expected)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        for kind in PATTERNS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in expected)
        assert r.spans.startswith(joined)
        total += len(expected)
    assert total > 20


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(
    ["@", ".", "-", "+", " ", "(", ")", "1", "255", "256", "0", "4111111111111111", "12", "a", "b.c", "é", "x@y.z", "\n", "_", "%"]
), max_size=30))
def test_base_patterns_on_any_text(parts):
    text = "".join(parts)
    assert base(text) == naive(text)


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("pay to GB82 WEST 1234 5698 7654 32 AND more", "iban", "GB82 WEST 1234 5698 7654 32"),
        ("IBAN DE89370400440532013000.", "iban", "DE89370400440532013000"),
        ("her social security number is 219-09-9999", "ssn", "219-09-9999"),
        ("call me on 555 123 4567", "local_phone", "555 123 4567"),
        ("Passeport: 12AB, passport AB1234567", "passport", "AB1234567"),
        ("born 1984-02-29 in", "birth_date", "1984-02-29"),
        ("geboren am 29.02.1984", "birth_date", "29.02.1984"),
    ],
)
def test_further_kinds(text, kind, value):
    found = [(s[0], text[s[1] : s[2]]) for s in pii.spans_of(text)]
    assert (kind, value) in found


@pytest.mark.parametrize(
    "text",
    [
        "GB83 WEST 1234 5698 7654 32",  # fails the remainder
        "219-09-9999 pieces",  # no context
        "order 555 123 4567 phone",  # another number's name lowers the score
        "born 1983-02-29",  # no such day
        "version 1984-02-28",
        "AB1234567",
        "4111111111111112",
        "1.2.3.256 and 300.1.1.1",
    ],
)
def test_what_is_left_alone(text):
    assert pii.spans_of(text) == []


def test_context_moves_the_score():
    plain, near, other = (
        pii.score(t, "ssn", t.index("219"), t.index("219") + 11) for t in ("x 219-09-9999", "SSN 219-09-9999", "order 219-09-9999")
    )
    assert other < plain < near and plain < pii.THRESHOLD <= near


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod_97("GB82WEST12345698765432") and not pii.mod_97("GB82WEST12345698765433")


def test_added_spans_touch_no_other():
    text = "tel +1 (988) 555-2485, bank account GB82 WEST 1234 5698 7654 32"
    spans = sorted(s[1:3] for s in pii.spans_of(text))
    assert len(spans) == 2 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_long_runs_take_one_pass():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "a@b" * 130_000, "1 " * 200_000):
        assert isinstance(pii.spans_of(text), list)
    assert pii.spans_of("0" * 5000 + ".0.0.0")[0][:2] == ("ip", 0)


def test_edges(spark):
    long = "é " * 300_000 + "x@y.zz"
    rows = [(1, None, "a", 7), (2, "", "b", 7), (3, long, None, 7), (None, "x@y.z", "d", 7), (4, "no", "e", None), (3, long, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, n_email int")
    got = pii.summary(pii.find(docs)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_email, r.spans) for r in got) == [
        (False, 1, 0, ""), (False, 2, 0, ""), (False, 3, 1, "email:600000:600006"), (False, 3, 1, "email:600000:600006"),
        (False, 4, 0, ""), (True, 0, 1, "email:0:5"),
    ]
    assert pii.summary(pii.find(docs.limit(0))).count() == 0
