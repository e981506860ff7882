"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

Four kinds are found by fixed rules (email, ip, card, phone) and always reported.
Further kinds are reported if their score reaches ``REPORTED``: account numbers
need a right remainder modulo 97, short card numbers a right Luhn sum and, like
national identifiers and local phone numbers, words near them that name such data.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import add_columns, fresh, quoted

# The patterns, limits and order of the four kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ADDED_KINDS = ("iban", "short_card", "national_id", "local_phone")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SHORT_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,14}(?![0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?0?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])")

REPORTED = 0.5
NEAR = 40  # characters on each side of a span in which context words count
_PRIOR = {
    "email": 0.8,
    "ip": 0.6,
    "card": 0.7,
    "phone": 0.6,
    "iban": 0.8,
    "short_card": 0.3,
    "national_id": 0.3,
    "local_phone": 0.2,
}
_WORDS_FOR = {
    "email": r"(?:e-?)?mails?|contact|write to",
    "ip": r"ip|(?:ip-?)?address(?:es)?|hosts?|hostname|servers?",
    "card": r"(?:credit|debit|bank)?cards?|visa|master(?:card)?|credit|payments?",
    "phone": r"(?:tele)?phones?|phoned|tel|telefon|call|calls|mobile|fax",
    "iban": r"iban|accounts?|bank|bankkonto|konto(?:nummer)?|compte|cuenta",
    "short_card": r"(?:credit|debit|bank)?cards?|visa|master(?:card)?|amex|credit|payments?",
    "national_id": r"ssn|social security|national id|identity",
    "local_phone": r"(?:tele)?phones?|tel|telefon|call me|mobile|fax",
}
_FOR = {kind: re.compile(rf"\b(?:{words})\b", re.I) for kind, words in _WORDS_FOR.items()}
_AGAINST = re.compile(r"\b(?:isbn|orders?|invoices?|version|part no|serial)\b", re.I)
_STOP = re.compile(r"[0-9@\n]|[.;!?](?:\s|$)")  # what follows belongs to something else
_DIGIT = re.compile(r"[0-9]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for digit in digits[-2::-2]:
        double = 2 * int(digit)
        total += double - 9 if double > 9 else double
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, its first four characters moved to the end, leaves 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str):
    """Start and end of each address, found from its @ so that long runs cost linear time."""
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (exclusive) in code points, by kind and start."""
    found = [("email", start, end) for start, end in emails(text)]
    if not _DIGIT.search(text):
        return found
    for match in IP.finditer(text):
        if all(map(_small, match.group().split("."))):
            found.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        digits = _digits(match.group()) if match.end() - match.start() <= 37 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    for match in PHONE.finditer(text):
        if 8 <= len(_digits(match.group())) <= 15:
            found.append(("phone", *match.span()))
    return found


def accounts(text: str):
    """Start and end of each account number.

    A match may have taken in words that follow the number, or begin before it: its
    earlier group bounds are tried too, the longest number first, then later starts.
    """
    match = IBAN.search(text)
    while match:
        start, end = match.span()
        while end > start:
            account = text[start:end].replace(" ", "")
            if 15 <= len(account) <= 34 and mod97(account):
                break
            end = max(start, text.rfind(" ", start, end))
        if end > start:
            yield start, end
        match = IBAN.search(text, max(end, start + 1))


def _proposals(text: str):
    for start, end in accounts(text):
        yield "iban", start, end
    if not _DIGIT.search(text):
        return
    for match in SHORT_CARD.finditer(text):
        if luhn(_digits(match.group())):
            yield "short_card", *match.span()
    for match in NATIONAL_ID.finditer(text):
        area, group, serial = match.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "national_id", *match.span()
    for match in LOCAL_PHONE.finditer(text):
        yield "local_phone", *match.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Prior of the kind, more if whole words near it name such data, less for other numbers.

    Words count before the span, and after it as far as its sentence, up to the next
    number or address.
    """
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    if stop := _STOP.search(after):
        after = after[: stop.start()]
    value = _PRIOR[kind]
    if _FOR[kind].search(before) or _FOR[kind].search(after):
        value += 0.35
    if _AGAINST.search(before) or _AGAINST.search(after):
        value -= 0.25
    return min(1.0, max(0.0, value))


def apart(proposed: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[bool]:
    """Whether each proposal overlaps none of the taken spans; both sorted by start, and
    proposals apart from each other. One pass over both: a span that starts before the
    proposal's end overlaps if the farthest end so far is beyond its start."""
    found, farthest, at = [], 0, 0
    for start, end in proposed:
        while at < len(taken) and taken[at][0] < end:
            farthest = max(farthest, taken[at][1])
            at += 1
        found.append(farthest <= start)
    return found


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """The spans of the fixed rules, and the added ones that overlap none before them."""
    text = text or ""
    base = [Span(*s, score(text, *s)) for s in base_spans(text)]
    added: list[Span] = []
    taken = sorted((s.start, s.end) for s in base)
    for _, proposals in groupby(_proposals(text), key=lambda p: p[0]):
        scored = (Span(*p, score(text, *p)) for p in proposals)
        likely = [s for s in scored if s.score >= REPORTED]
        free = apart([(s.start, s.end) for s in likely], taken)
        new = [s for s, is_free in zip(likely, free, strict=True) if is_free]
        added += new
        taken = sorted(taken + [(s.start, s.end) for s in new])
    return base, added


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind; of overlapping ones by that of the first."""
    if text is None:
        return None
    base, added = find_spans(text)
    pieces, done = [], 0
    for span in sorted(base + added, key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            pieces += [text[done : span.start], f"<{span.kind.upper()}>"]
        done = max(done, span.end)
    return "".join([*pieces, text[done:]])


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of each row of ``docs``.

    Columns: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores
    (one per span). A NULL text is an empty one. Rows without doc_id are kept;
    repeated rows come back repeated; an empty table gives no rows; other columns
    are ignored.
    """

    def start():
        def one(text):
            base, added = find_spans(text)
            counts = [sum(s.kind == kind for s in base) for kind in BASE_KINDS]
            digest = hashlib.sha256(_listed(base).encode()).hexdigest()
            return *counts, digest, _listed(base + added), [s.score for s in base + added]

        def work(part):
            rows = [one(text) for text in part.column("text").to_pylist()]
            return [[row[i] for row in rows] for i in range(7)]

        return work

    counts = ", ".join(f"n_{kind} bigint" for kind in BASE_KINDS)
    fields = f"{counts}, base_sha256 string, spans string, scores array<double>"
    return add_columns(docs.select("doc_id", "text"), fields, start).drop("text")


def without_personal_data(docs: DataFrame) -> DataFrame:
    """All rows and columns, with masked texts; ``n_chars``, where present, follows the text."""
    new = fresh(docs, "_masked")

    def start():
        return lambda part: [[masked(text) for text in part.column("text").to_pylist()]]

    done = add_columns(docs, f"`{new}` string", start)
    values = {"text": F.col(new), "n_chars": F.length(new).cast("bigint")}
    kept = [values.get(c.lower(), quoted(c)).alias(c) for c in docs.columns]
    return done.select(*kept)
