"""Personal data: patterns propose spans, checksums confirm, context words score.

Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velometry.llm.common import slices, texts

#: Kinds in the order of a result; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE = KINDS[:4]

# Possessive repeats match what greedy ones would, without trying shorter runs again.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
)
#: The length of an IBAN by its country, as the registry fixes it.
_IBAN_SIZES = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_ASSIGNED = re.compile(
    r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|token|secret|api[_-]?key)\x20?[:=]\x20?[\"']?"
    r"([A-Za-z0-9/+_.=-]{8,})"
)
_KEY_ID = re.compile(r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")

#: Score of a proposal, before its surroundings count.
SCORES = {
    "email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "secret": 0.7,
}
#: Score of a card number that is only a part of a longer run of digits.
PART_SCORE = 0.3
CONTEXT = {
    "email": {"email", "mail", "contact", "courriel", "correo"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "credit", "visa", "mastercard", "amex", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "secret": {"password", "token", "secret", "key", "credential"},
}
AGAINST = {"isbn", "version", "order", "invoice", "part", "serial", "example"}
CONTEXT_CHARS = 40
GAIN, LOSS = 0.3, 0.2
#: A span of the method needs this score; base spans stay whatever theirs is.
LEAST_SCORE = 0.5


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _iban_end(proposal: str) -> int | None:
    """Where the IBAN that begins a proposal ends: its end, or that of a group before a space.

    The pattern may take a word behind the number for more groups.  The length of the country
    decides; the whole proposal, or any group where the country is unknown, is tried next.
    """
    size = _IBAN_SIZES.get(proposal[:2])
    ends = [len(proposal), *(i for i in range(len(proposal) - 1, 0, -1) if proposal[i] == " ")]
    number = {end: proposal[:end].replace(" ", "") for end in ends}
    fixed = [end for end in ends if len(number[end]) == size]
    for end in fixed + (ends if size is None else ends[:1]):
        if 15 <= len(number[end]) <= 34 and mod97(number[end]):
            return end
    return None


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    m = _IBAN.search(text)
    while m:
        end = _iban_end(m[0])
        if end is not None:
            yield m.start(), m.start() + end
        # What a proposal took beyond its number, or all of a failed one, may hold another.
        m = _IBAN.search(text, m.start() + (end or 1))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _inside_cards(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Card numbers among the whole groups of a longer run of digits, leftmost longest."""
    groups = [(m.start(), m.end()) for m in re.finditer("[0-9]+", text[start:end])]
    first = 0
    while first < len(groups):
        found = None
        n = 0
        for last in range(first, len(groups)):
            n += groups[last][1] - groups[last][0]
            if n > 19:
                break
            a, b = start + groups[first][0], start + groups[last][1]
            if n >= 13 and luhn(_digits(text[a:b])):
                found = last
        if found is None:
            first += 1
        else:
            yield start + groups[first][0], start + groups[found][1]
            first = found + 1


def _score(text: str, kind: str, start: int, end: int, score: float) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = set(re.findall(r"[^\W\d_]+", near.lower()))
    if words & CONTEXT[kind]:
        score += GAIN
    if words & AGAINST:
        score -= LOSS
    return round(min(1.0, max(0.0, score)), 2)


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by kind and start."""
    found: list[Span] = []

    def keep(kind: str, start: int, end: int, score: float | None = None) -> None:
        base = score is None and kind in BASE
        score = _score(text, kind, start, end, SCORES[kind] if score is None else score)
        if base or score >= LEAST_SCORE:
            found.append(Span(kind, start, end, score, base))

    for start, end in _emails(text):
        keep("email", start, end)
    for m in _IP.finditer(text):
        if all(map(_octet, m[0].split("."))):
            keep("ip", m.start(), m.end())
    longer = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            keep("card", m.start(), m.end())
        elif len(digits) > 13:
            longer.append((m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            keep("phone", m.start(), m.end())

    # What the method adds lies outside the base spans.
    starts, reach = [], [0]
    for span in sorted(found, key=lambda s: s.start):
        starts.append(span.start)
        reach.append(max(reach[-1], span.end))

    def add(kind: str, start: int, end: int, score: float | None = None) -> None:
        # How far the base spans reach that begin before the end.
        if reach[bisect_left(starts, end)] <= start:
            keep(kind, start, end, score)

    for run in longer:
        for start, end in _inside_cards(text, *run):
            add("card", start, end, PART_SCORE)
    for start, end in _ibans(text):
        add("iban", start, end)
    if "-" in text:
        for m in _SSN.finditer(text):
            add("ssn", m.start(), m.end())
    if "=" in text or ":" in text:
        for m in _ASSIGNED.finditer(text):
            if any(c.isdigit() for c in m[1]):
                add("secret", m.start(1), m.end(1))
    if "AKIA" in text:
        for m in _KEY_ID.finditer(text):
            add("secret", m.start(), m.end())
    return sorted(found, key=lambda s: (KINDS.index(s.kind), s.start))


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind; of overlapping ones the first stays."""
    parts, at = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.end <= at:
            continue
        parts += [text[at : max(at, span.start)], f"<{span.kind.upper()}>"]
        at = span.end
    return "".join(parts) + text[at:]


_SPAN = pa.struct(
    [
        ("kind", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("score", pa.float64()),
        ("base", pa.bool_()),
    ]
)


def find_pii(documents: DataFrame) -> DataFrame:
    """``doc_id, spans`` for each row: (kind, start, end, score, base) by kind and start.

    Base spans are always listed, others from ``LEAST_SCORE`` on.  A null text has
    none.  A null doc_id stays null, repeated rows give repeated results, other
    columns are not read, an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                spans = [[s._asdict() for s in find_spans(t)] for t in texts(part, "text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "spans"]
                )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(
        scan,
        "doc_id bigint, spans "
        "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>",
    )


def redact_documents(documents: DataFrame) -> DataFrame:
    """``documents`` with every span in ``text`` replaced by ``<KIND>``.

    All rows and columns stay; ``n_chars``, where there is one, is counted anew.
    A null text stays null.
    """
    names = documents.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                new = [
                    t if not t else redact(t, find_spans(t))
                    for t in part.column("text").to_pylist()
                ]
                at = names.index("text")
                part = part.set_column(at, part.schema.field(at), pa.array(new, pa.string()))
                if "n_chars" in names:
                    at = names.index("n_chars")
                    sizes = pa.array([None if t is None else len(t) for t in new])
                    field = part.schema.field(at)
                    part = part.set_column(at, field, sizes.cast(field.type))
                yield part

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in documents.schema.fields])
    return documents.mapInArrow(clean, schema)
