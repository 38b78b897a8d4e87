"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust a score.

Base kinds (email, ip, card, phone) are defined by their pattern and check alone and always stay, and so does an iban
that passes its check. Further kinds (national id, birth date) and card numbers that stand inside a longer run of digits
(whole groups of it that pass the checksum) need a score of at least ``THRESHOLD`` that context words before or after them
can raise or lower; a birth date also has to be in the calendar.

Every pattern is written, or guarded, so that a search takes time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import re
from calendar import monthrange
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerline.llm.common import inner_name

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_id", "birth_date")
THRESHOLD = 0.5
CONTEXT = 40  # characters before and after a span in which context words count

# The patterns of the base kinds. Digit runs are entered at their first digit only and addresses are
# found from their @ sign, which gives the same leftmost matches in linear time.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
GROUP = re.compile(r"[0-9]+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The method's own kinds.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ ]?[A-Z0-9]{4})")  # where one can begin
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
BIRTH_DATE = re.compile(r"(?<![0-9./-])(?:[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9])")

# How card numbers are grouped and begin.
CARD_GROUPS = frozenset({*((n,) for n in range(13, 20)), *((4, 4, 4, n) for n in range(1, 5)), *((4, 4, 4, 4, n) for n in range(1, 4)), (4, 6, 4), (4, 6, 5)})
ISSUER = re.compile(
    r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]\d\d|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)\d{12}|3[47]\d{13}"
    r"|(?:6011|64[4-9]\d|65\d\d)\d{12,15}|(?:62\d\d|35(?:2[89]|[3-8]\d))\d{12,15}|3(?:0[0-5]|[689]\d)\d{11}"
)
# Characters of an account number by its country.
IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
# By length: groups of four, then what is left, up to the end of a word.
IBAN_OF = {
    n: re.compile(rf"[A-Z]{{2}}[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"[ ]?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + r"(?![A-Za-z0-9])")
    for n in range(34, 14, -1)
}

# Score of a span that is proposed, what its checksum adds, and what context words add or take.
PROPOSED = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.1, "national_id": 0.3, "birth_date": 0.1}
CONFIRMED = {"iban": 0.8}
RAISE, LOWER = 0.3, 0.3
# Card numbers inside a longer run: score of the checksum, what the grouping and the issuer add.
INSIDE, GROUPED, ISSUED = 0.1, 0.4, 0.3
NEARBY = {
    "email": (("mail", "email", "contact", "write"), ("example", "version")),
    "ip": (("ip", "address", "host", "server"), ("version", "section", "release")),
    "card": (("card", "visa", "credit", "payment"), ("isbn", "order", "item")),
    "phone": (("phone", "telephone", "call", "tel", "mobile"), ("isbn", "version")),
    "iban": (("iban", "account", "bank", "konto", "compte", "cuenta"), ("isbn", "order")),
    "national_id": (("ssn", "social security", "national id"), ("isbn", "order", "part")),
    "birth_date": (
        ("born", "birth", "birthday", "dob", "geboren", "geburtsdatum", "nacido", "nacida", "né le", "née le"),
        ("version", "release", "released", "published"),
    ),
}
# Whole words, or their plural: no "tel" in "hotel" and no "born" in "airborne".
WORDS = {
    kind: [re.compile(r"(?<!\w)(?:%s)s?(?!\w)" % "|".join(map(re.escape, some)), re.IGNORECASE) for some in words]
    for kind, words in NEARBY.items()
}
YEARS = range(1880, 2101)  # of birth dates


class Span(NamedTuple):
    kind: str
    start: int  # code points
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The check of card numbers."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of international account numbers: letters count from 10, the first four characters go last."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the base kinds, by kind and start."""
    found = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _only_digits(m.group())) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_only_digits(m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers that pass their check: of their country's length, or else of the greatest that passes."""
    free = 0
    for start in IBAN.finditer(text):
        if start.start() < free:
            continue
        for n in dict.fromkeys([IBAN_LENGTH.get(start.group()[:2], 34), *IBAN_OF]):
            m = IBAN_OF[n].match(text, start.start())
            if m and mod97(m.group().replace(" ", "")):
                free = m.end()
                yield m.start(), free
                break


def inner_cards(text: str) -> Iterator[tuple[int, int, float]]:
    """Card numbers inside runs of digits that are none as a whole: whole groups of a run, 13 to 19 digits together,
    that pass the checksum, and their score. They may overlap."""
    for run in CARD.finditer(text):
        if run.end() - run.start() < 14:
            continue
        groups = [m.span() for m in GROUP.finditer(text, run.start(), run.end())]
        digits = "".join(text[a:b] for a, b in groups)
        if len(groups) < 2 or len(digits) < 14 or len(digits) <= 19 and luhn(digits):
            continue
        ends = list(accumulate(b - a for a, b in groups))
        # Checksums of all beginnings of the run, with every other digit doubled: a difference checks any part.
        sums = [[0], [0]]
        for odd, total in enumerate(sums):
            for i, c in enumerate(digits):
                value = ord(c) - 48
                total.append(total[-1] + (value * 2 - 9 * (value > 4) if i % 2 == odd else value))
        for first, (start, _) in enumerate(groups):
            low = ends[first - 1] if first else 0
            for last in range(first, len(groups)):
                high = ends[last]
                if high - low > 19:
                    break
                total = sums[high % 2]
                if high - low < 13 or high - low == len(digits) or (total[high] - total[low]) % 10:
                    continue
                score = INSIDE + ISSUED * bool(ISSUER.fullmatch(digits, low, high))
                score += GROUPED * (tuple(b - a for a, b in groups[first : last + 1]) in CARD_GROUPS)
                near = _context(text, "card", start, groups[last][1])
                yield start, groups[last][1], score + (2 * near if near > 0 else near)


def _context(text: str, kind: str, start: int, end: int) -> float:
    """What the words around a span add to its score. Those after it, which may belong to what follows, count where none
    before it says anything."""
    last = min(end + CONTEXT, len(text))
    for _ in range(CONTEXT):  # a word is not cut where the window ends
        if last == len(text) or not text[last].isalnum():
            break
        last += 1
    for a, b in ((max(0, start - CONTEXT), start), (end, last)):
        good, bad = (bool(words.search(text, a, b)) for words in WORDS[kind])
        if good or bad:
            return RAISE * good - LOWER * bad
    return 0.0


def in_calendar(text: str) -> bool:
    """Whether a date exists, with the day or the month first where the year is last."""
    first, second, third = map(int, re.split(r"[./-]", text))
    ways = [(first, second, third)] if first > 31 else [(third, second, first), (third, first, second)]
    return any(y in YEARS and 1 <= m <= 12 and 1 <= d <= monthrange(y, m)[1] for y, m, d in ways)


def spans(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text, by kind and start; null and empty texts have none. Base spans and account numbers, which
    their checks confirm, stay whatever their score."""
    base, more = _spans(text, threshold) if text else ([], [])
    return sorted(base + more, key=lambda s: (KINDS.index(s.kind), s.start))


def _spans(text: str, threshold: float) -> tuple[list[Span], list[Span]]:
    """The base spans and the method's own."""
    base = [
        Span(kind, a, b, round(min(1.0, max(0.0, PROPOSED[kind] + _context(text, kind, a, b))), 3))
        for kind, a, b in base_spans(text)
    ]
    own = [("iban", a, b) for a, b in ibans(text)]
    taken = [(a, b) for _, a, b in own] + [(s.start, s.end) for s in base]
    if "-" in text:
        own += [("national_id", *m.span()) for m in NATIONAL_ID.finditer(text)]
    own += [("birth_date", *m.span()) for m in BIRTH_DATE.finditer(text) if in_calendar(m.group())]
    found = []
    for kind, a, b in own:
        score = PROPOSED[kind] + CONFIRMED.get(kind, 0.0) + 2 * _context(text, kind, a, b)
        if score >= threshold or kind in CONFIRMED:
            found.append(Span(kind, a, b, round(min(1.0, score), 3)))
    # Of card numbers that overlap, the best stays, and none that another checksum or a base kind has already.
    if cards := [c for c in inner_cards(text) if c[2] >= threshold]:
        covered = bytearray(len(text))
        for a, b in taken:
            covered[a:b] = b"\1" * (b - a)
        for a, b, score in sorted(cards, key=lambda c: (-c[2], c[0] - c[1], c[0])):
            if not any(covered[a:b]):
                covered[a:b] = b"\1" * (b - a)
                found.append(Span("card", a, b, round(min(1.0, score), 3)))
    return base, found


def redact(text: str | None, found: list[Span]) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first stands for all."""
    if not found:
        return text
    parts, at = [], 0
    for span in sorted(found, key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            parts += [text[at : span.start], f"[{span.kind.upper()}]"]
        at = max(at, span.end)
    return "".join([*parts, text[at:]])


SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"


def find(text: Column, threshold: float = THRESHOLD) -> Column:
    """The spans of each text as an array of structs; an empty one for null."""

    @pandas_udf(SPANS)
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([[s._asdict() for s in spans(t, threshold)] for t in texts], dtype=object)

    return compute(text)


def redacted(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with their personal data replaced in ``text``, and ``n_chars``, if there, counted anew.
    Null texts stay null; an empty table stays empty."""

    @pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, spans(t, threshold)) for t in texts], dtype=object)

    text = inner_name(docs.columns, "text_")
    done = docs.withColumn(text, clean("text"))
    columns = [F.col(text).alias(c) if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else c for c in docs.columns]
    return done.select(*columns)


def digest(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the number of spans of each base kind, the SHA-256 of the base spans and all spans as text. Card numbers
    inside a longer run of digits are no base spans: they are only among all spans. Null and empty texts have none;
    repeated rows are searched each, other columns left behind, and an empty table gives no rows."""

    @pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def compute(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, more = _spans(text, threshold) if text else ([], [])
            said = [
                ",".join(f"{s.kind}:{s.start}:{s.end}" for s in sorted(some, key=lambda s: (KINDS.index(s.kind), s.start)))
                for some in (base, base + more)
            ]
            counts = [sum(s.kind == k for s in base) for k in BASE]
            rows.append((*counts, hashlib.sha256(said[0].encode()).hexdigest(), said[1]))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", compute("text").alias("found")).select("doc_id", "found.*")
