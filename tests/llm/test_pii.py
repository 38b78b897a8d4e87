from __future__ import annotations

import hashlib
import random
import re

import pytest

from ledgerline.llm import pii

# The base kinds as they are defined, taken literally.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind: str, text: str) -> bool:
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        odd, even = digits[-1::-2], digits[-2::-2]
        return 13 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain_spans(text: str) -> list[tuple]:
    return [
        (kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in re.finditer(p, text) if passes(kind, m.group())
    ]


def test_against_the_definition():
    pick = random.Random(2)
    parts = ["a@b.co", "x.y+z@d-e.f.g", "@", ".", "a", "é", "😀", " ", "-", "+", "1.2.3.4", "256.1.1.1", "001.02.3.255", "4111111111111111",
             "4111 1111 1111 1111", "+1 (555) 123-4567", "+", "0", "12", "9807915762804490", "(", ")", "_", "@c.d", ".5", "\n", "1-2"]
    for _ in range(4000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 200_000, "a@" * 150_000, "1 " * 200_000, "a." * 150_000 + "@"])
def test_long_texts_take_linear_time(text):
    pii.spans(text)


def test_checks_of_the_method():
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")
    said = "Account GB82 WEST 1234 5698 7654 32 and ssn 078-05-1120, order 078-05-1120, born 12.05.1980, version 12.05.1980"
    assert [(s.kind, said[s.start : s.end]) for s in pii.spans(said)] == [
        ("iban", "GB82 WEST 1234 5698 7654 32"),
        ("national_id", "078-05-1120"),
        ("birth_date", "12.05.1980"),
    ]
    assert not [s for s in pii.spans("GB82 WEST 1234 5698 7654 33") if s.kind == "iban"]
    assert pii.spans(None) == pii.spans("") == []


@pytest.mark.parametrize(
    ("said", "want"),
    [
        ("ES91 2100 0418 4502 0005 1332 BIC ABC", ["ES91 2100 0418 4502 0005 1332"]),
        ("ES9121000418450200051332 BIC", ["ES9121000418450200051332"]),
        ("AT61 1904 3002 3457 3201 2024", ["AT61 1904 3002 3457 3201"]),
        ("AT61 1904 3002 3457 3201 ES91 2100 0418 4502 0005 1332", ["AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332"]),
        ("REF AB12 3456 7890 AT61 1904 3002 3457 3201 X", ["AT61 1904 3002 3457 3201"]),
        ("order AT611904300234573201, isbn", ["AT611904300234573201"]),
        ("AT61 1904 3002 3457 3202 2024 and AT6119043002345732012024", []),
    ],
)
def test_account_numbers_end_where_their_check_does(said, want):
    assert [said[s.start : s.end] for s in pii.spans(said) if s.kind == "iban"] == want


@pytest.mark.parametrize(
    ("said", "want"),
    [
        ("card 4111 1111 1111 1111 12/27", ["4111 1111 1111 1111"]),
        ("4111 1111 1111 1111 123", ["4111 1111 1111 1111"]),
        ("id 7 4111111111111111", ["4111111111111111"]),
        ("4111 1111 1111 1111 5500 0000 0000 0004", ["4111 1111 1111 1111", "5500 0000 0000 0004"]),
        ("order 3 4111-1111-1111-1111", ["4111-1111-1111-1111"]),
        ("order 3 1234567890128", []),  # no issuer's, and not in the context of a card
        ("41 11 11 11 11 11 11 11 5", []),  # a table of numbers
        ("4111 1111 1111 1112 123", []),
        ("ES91 2100 0418 4502 0005 1332 7", []),
    ],
)
def test_card_numbers_inside_longer_runs(said, want):
    assert not pii.base_spans(said)
    assert [said[s.start : s.end] for s in pii.spans(said) if s.kind == "card"] == want


def test_inner_cards_leave_the_base_figures(spark):
    text = "card 4111 1111 1111 1111 12/27 a@b.co"
    docs = spark.createDataFrame([(1, text, None)], "doc_id long, text string, n_chars long")
    (row,) = pii.digest(docs).collect()
    assert (row["n_card"], row["spans"]) == (0, "email:31:37,card:5:24")
    assert row["base_sha256"] == hashlib.sha256(b"email:31:37").hexdigest()
    assert pii.redacted(docs).first()["text"] == "card [CARD] 12/27 [EMAIL]"


def test_redaction():
    text = "Mail a@b.co or 1.2.3.4, card 4111 1111 1111 1111."
    assert pii.redact(text, pii.spans(text)) == "Mail [EMAIL] or [IP], card [CARD]."
    assert pii.redact(None, []) is None


def test_digest_and_redacted_rows(spark):
    rows = [(1, "é a@b.co", None, None, 8, "t"), (1, "é a@b.co", None, None, 8, "t"), (None, None, "en", "s", None, "t"), (3, "", None, None, 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, text_ string")
    found = pii.digest(docs).collect()
    assert [r["spans"] for r in found] == ["email:2:8", "email:2:8", "", ""]
    assert found[0]["base_sha256"] == hashlib.sha256(b"email:2:8").hexdigest() and found[0]["n_email"] == 1
    assert found[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    assert [(r["text"], r["n_chars"], r["text_"]) for r in out.collect()] == [("é [EMAIL]", 9, "t")] * 2 + [(None, None, "t"), ("", 0, None)]
    assert pii.redacted(docs.limit(0)).count() == pii.digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text, found",
    [
        ("dob: 31/02/1990", False), ("dob: 28/02/1990", True), ("born 02/28/1990", True), ("born 1990-02-30", False),
        ("born 29.02.2000", True), ("born 29.02.1900", False), ("born 13/13/1990", False), ("born 01.01.0001", False),
        ("airborne since 12.05.1998", False), ("12.05.1998, the day she was born", True), ("12.05.1998 stubborn", False),
        ("Née le 12.05.1998", True), ("born 12.05.1998, version of it", True), ("version 12.05.1998, born", False),
        ("12.05.1998" + " x" * 19 + " born", True), ("12.05.1998" + " x" * 18 + " bornholm", False),
        ("12.05.1998" + "x" * 60 + " born", False),
    ],
)
def test_birth_dates_need_a_day_and_a_word(text, found):
    assert [s.kind for s in pii.spans(text)] == ["birth_date"] * found


@pytest.mark.parametrize("text, more", [("hotel +49 30 1234567", 0), ("Tel. +49 30 1234567", 0.3), ("+49 30 1234567 (phones)", 0.3),
                                        ("ship 10.0.0.1", 0), ("IP: 10.0.0.1", 0.3), ("10.0.0.1 is the version", -0.3)])
def test_context_is_whole_words_on_both_sides(text, more):
    (span,) = pii.spans(text)
    assert span.score == pytest.approx(min(1.0, pii.PROPOSED[span.kind] + more))
