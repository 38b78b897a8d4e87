from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import counting

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = [
    "",
    " ",
    "  a  b ",
    "a\n b\n\n  c\t d \n",
    "don't 'st x's 'll 've'd I'm they'RE",
    "<|endoftext|>",
    " x<|endoftext|> y <|endoftext|><|endo ftext|>",
    "naïve Straße 東京。大阪、x １２ ½ 𝟘",
    "zero​width ᠎ mongolian nbsp \x1c\x1d  sep",
    "é combining ퟿ 👩‍👩‍👧 flags🇩🇪",
    "\x00\x01 control \x85 nel",
    "a" * 5000,
    "....,,,;; !!! ???--==",
    "1234567890 12,345.67 3rd x86 abc123def",
]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture
def counter():
    return counting.Counter(PATH)


def test_awkward_texts(counter, whole):
    assert counter.counts(AWKWARD) == [whole(t) for t in AWKWARD]
    assert counter.counts(AWKWARD) == [whole(t) for t in AWKWARD]  # now from what is kept


def test_random_texts(counter, whole):
    pick = random.Random(3)
    signs = list("aAbzZ019'' \n\t.,-<|>é東。   　") + ["'s", "'re", "<|endoftext|>", "  ", "\r\n"]
    texts = ["".join(pick.choices(signs, k=pick.randint(1, 60))) for _ in range(4000)]
    assert counter.counts(texts) == [whole(t) for t in texts]


@pytest.mark.parametrize("long", [1, 7, 50])
def test_long_parts_are_cut_where_it_is_safe(monkeypatch, counter, whole, long):
    """Cuts at every few characters: lines, marks, digits, letters that no token joins, special tokens left alone."""
    monkeypatch.setattr(counting, "LONG", long)
    pick = random.Random(long)
    signs = list("abeghjqstvxzQXZ0123\n.,!。東京か한") + ["'s", "'ve", "<|endoftext|>", "the"]
    texts = ["".join(pick.choices(signs, k=300)) for _ in range(300)]
    parts = [counter.parts(t) for t in texts]
    assert ["".join(p) for p in parts] == texts
    assert sum(map(len, parts)) > 300 * 5
    assert counter.counts(texts) == [whole(t) for t in texts]


def test_a_long_text_is_not_one_call(monkeypatch, counter, whole):
    calls = []
    call = counter.call
    monkeypatch.setattr(counter, "call", lambda batch, into: (calls.append(sum(map(len, batch))), call(batch, into)))
    pick = random.Random(1)
    text = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz\n.0", k=1_500_000))
    assert counter.counts([text]) == [whole(text)]
    assert max(calls) <= counting.CALL_BYTES + counting.LONG + counting.REACH


def test_what_is_kept_is_bounded(monkeypatch, counter, whole):
    monkeypatch.setattr(counting, "KEPT", 5)
    texts = [f"word{i} " * 3 + "x" * 40 for i in range(50)]
    assert counter.counts(texts) == [whole(t) for t in texts]
    assert len(counter.kept) <= 5 and max(map(len, counter.kept)) <= counting.LONGEST_KEPT


def test_in_spark(spark, whole):
    """Nulls, repeated rows, long texts, other columns with the names of ours, an empty table."""
    texts = [*AWKWARD, None, "twice", "twice", "long line \n" * 20_000]
    rows = [(i if i % 5 else None, t, "x", "y") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, over_limit string")
    found = counting.counted(frame.repartition(2), PATH, 1000)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(((k or -1), len((t or "").encode()), whole(t or ""), whole(t or "") > 1000) for k, t, *_ in rows)
    assert sorted(((r[0] or -1), *r[1:]) for r in found.collect()) == want
    assert counting.counted(frame.limit(0), PATH, 1000).count() == 0
