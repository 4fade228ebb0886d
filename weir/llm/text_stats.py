"""Statistics of one text that the quality operators share.

Words are runs of characters other than space and U+0009 to U+000D; ``bytes.split``
without an argument cuts at exactly these.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Inputs of the quality models, in this order.
FEATURES = (
    "log_words",
    "mean_word_chars",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "upper_share",
    "digit_share",
    "upper_word_share",
    "bar_word_share",
    "bang_share",
    "end_mark_share",
    "line_words",
    "top_word_share",
    "other_share",
)

_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_PLAIN = bytes(range(97, 123)) + _UPPER + _DIGITS + _BLANKS + b".,"


def _count(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= again
    return int(covered.sum())


def describe(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """The base counts and the model's features; NULL is as empty."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return (0, 0, _count(data, _SYMBOLS), 0, 0), [0.0] * len(FEATURES)
    word_chars = len(text) - _count(data, _BLANKS)
    symbols = _count(data, _SYMBOLS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    distinct = Counter(words)
    letters = max(1, word_chars)
    features = [
        float(np.log1p(n)),
        word_chars / n,
        symbols / n,
        dup_lines / len(lines),
        repeats / n,
        len(distinct) / n,
        _count(data, _UPPER) / letters,
        _count(data, _DIGITS) / letters,
        sum(w.isupper() and len(w) > 1 for w in words) / n,
        distinct[b"|"] / n,
        data.count(b"!") / n,
        (data.count(b".") + data.count(b",")) / n,
        n / len(lines),
        max(distinct.values()) / n,
        len(data.translate(None, _PLAIN)) / letters,
    ]
    return (n, word_chars, symbols, dup_lines, repeats), features


def describe_all(texts) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (int64) and features (float64), a row per text."""
    pairs = [describe(t) for t in texts]
    base = np.array([p[0] for p in pairs], np.int64).reshape(-1, len(BASE))
    features = np.array([p[1] for p in pairs], np.float64).reshape(-1, len(FEATURES))
    return base, features
