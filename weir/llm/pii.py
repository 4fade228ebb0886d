"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Every kind has a pattern and a score to start from. A validator (Luhn for cards,
remainder 97 for bank accounts, value ranges and calendar dates for others) confirms a
candidate and raises its score, or drops it. Words near the span then move the score:
words that name the kind raise it, words that name other numbers (orders, versions)
lower it. A span of a further kind stays at ``THRESHOLD`` or more, and where it touches
no other span with a better score.

The base kinds (email, ip, card, phone) are decided by pattern and validator alone and
always stay; they carry a score, too. Base patterns are read leftmost, without overlap
within a kind. Each is matched in one pass over a text: a run of characters that cannot
begin a match is passed over as a whole, so a text of one long run costs no more than
any other.

Scale: one pass over the texts, no shuffle. Texts without digit and ``@`` are told by
Arrow and cost no Python.

Defined cases: NULL text is as empty: no spans; positions count code points, ends are
exclusive; repeated rows are scanned alike; spans of different base kinds may overlap;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone", "birth_date", "passport")
THRESHOLD = 0.6
NEAR = 48  # characters before a span that count as its context; a third of it after
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"

# A match without its group is a run that begins no match of the kind.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
IP = re.compile(r"[0-9]+(\.[0-9]+\.[0-9]+\.[0-9]+)?")
CARD = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

IBAN = re.compile(
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
)
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])")
DATE = re.compile(r"(?<![0-9./-])(?:([0-9]{4})-([0-9]{2})-([0-9]{2})|([0-9]{1,2})[./]([0-9]{1,2})[./]([0-9]{4}))(?![0-9/-])")
PASSPORT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])")

#: Score of a candidate that its validator has confirmed, before its context counts.
START = {
    "email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7,
    "iban": 0.8, "ssn": 0.4, "local_phone": 0.4, "birth_date": 0.2, "passport": 0.2,
}
RAISE, LOWER = 0.4, 0.3

WORDS = {
    "email": "e-?mail|mail|courriel|correo|kontakt|contact",
    "ip": "ip|address|adresse|host|server|login",
    "card": "card|visa|credit|carte|karte|tarjeta|payment",
    "phone": "phone|tel|mobile|call|fax|téléphone|telefon|handy|teléfono|móvil",
    "iban": "iban|account|bank|konto|compte|cuenta|bic|swift",
    "ssn": "ssn|social security|sécurité sociale|seguridad social|sozialversicherung",
    "local_phone": "phone|tel|mobile|call|fax|téléphone|telefon|handy|teléfono|móvil",
    "birth_date": "born|birth|birthday|dob|né|née|naissance|geboren|geburtstag|nacido|nacida|nacimiento",
    "passport": "passport|passeport|reisepass|pasaporte",
}
CONTEXT = {kind: re.compile(rf"(?<!\w)(?:{words})(?!\w)", re.IGNORECASE) for kind, words in WORDS.items()}
OTHER_NUMBERS = re.compile(
    r"(?<!\w)(?:order|invoice|version|isbn|issn|doi|serial|part|model|tracking|commande|facture|bestellung|rechnung|pedido|factura)(?!\w)",
    re.IGNORECASE,
)

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    """Every second digit from the right counts double, its digits summed."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """The account number with its head moved to the end, letters as 10 to 35, leaves 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _small(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    if "@" in text:
        yield from (m.span() for m in EMAIL.finditer(text) if m.group(1))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    yield from (m.span() for m in IP.finditer(text) if m.group(1) and all(map(_small, m.group().split("."))))


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        yield from (m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15)


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """A spaced number may be followed by a word in capitals: the longest valid run of
    its groups counts."""
    for m in IBAN.finditer(text):
        groups, end = m.group().split(" "), m.end()
        while groups:
            account = "".join(groups)
            if len(account) < 15:
                break
            if len(account) <= 34 and mod_97(account):
                yield m.start(), end
                break
            end -= len(groups.pop()) + 1


def _dates(text: str) -> Iterator[tuple[int, int]]:
    for m in DATE.finditer(text):
        year, month, day = m.group(1, 2, 3) if m.group(1) else m.group(6, 5, 4)
        try:
            datetime.date(int(year), int(month), int(day))
        except ValueError:
            continue
        if int(year) >= 1900:
            yield m.span()


PROPOSALS = {
    "email": _emails,
    "ip": _addresses,
    "card": _cards,
    "phone": _phones,
    "iban": _accounts,
    "ssn": lambda text: (m.span() for m in SSN.finditer(text)),
    "local_phone": lambda text: (m.span() for m in LOCAL_PHONE.finditer(text)),
    "birth_date": _dates,
    "passport": lambda text: (m.span() for m in PASSPORT.finditer(text)),
}


def score(text: str, kind: str, start: int, end: int) -> float:
    around = text[max(0, start - NEAR) : start] + "\0" + text[end : end + NEAR // 3]
    value = START[kind]
    if CONTEXT[kind].search(around):
        value += RAISE
    if OTHER_NUMBERS.search(around):
        value -= LOWER
    return round(min(1.0, max(0.0, value)), 3)


def spans_of(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans, by kind as listed, then by start."""
    found = [
        (kind, start, end, score(text, kind, start, end))
        for kind, propose in PROPOSALS.items()
        for start, end in propose(text)
    ]
    kept = [s for s in found if s[0] in BASE_KINDS]
    if len(kept) < len(found):
        more = [s for s in found if s[0] not in BASE_KINDS and s[3] >= threshold]
        kept += _apart(more, kept)
    return kept


def _apart(spans: list[Span], taken: list[Span]) -> list[Span]:
    """Spans that touch nothing taken, better scores first, in their order."""
    import bisect

    # stretches of text that are taken, apart and in order
    cover: list[list[int]] = []
    for start, end in sorted((s[1], s[2]) for s in taken):
        if cover and start < cover[-1][1]:
            cover[-1][1] = max(end, cover[-1][1])
        else:
            cover.append([start, end])
    kept = []
    for span in sorted(spans, key=lambda s: (-s[3], s[1], KINDS.index(s[0]))):
        _, start, end, _ = span
        at = bisect.bisect_left(cover, [end, -1])  # the first stretch that begins at the end or later
        if at == 0 or cover[at - 1][1] <= start:
            cover.insert(at, [start, end])
            kept.append(span)
    return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1]))


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans) of every document: kind, start, end and score of each span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        )
        names = ("kind", "start", "end", "score")
        for batch in batches:
            texts = batch.column("text")
            spans: list[list[dict]] = [[]] * len(texts)
            for i in pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False)).to_pylist():
                spans[i] = [dict(zip(names, s)) for s in spans_of(texts[i].as_py(), threshold)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, types)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans {SPANS}")


def _joined(spans: Column) -> Column:
    """``kind:start:end`` of spans that are in order already."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def summary(found: DataFrame) -> DataFrame:
    """(doc_id, n_<base kind>, base_sha256, spans as text) of what ``find`` returns."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
