from __future__ import annotations

import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abzAZ019 '\n\t\r.,!?#<|>-_éÉßüñÑİıſΣςσاчЖ中́̀  \x1c\x85½²Ⅷǅ😀ﬁ"


def plain_ids(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_words_give_the_ids_of_whole_texts():
    tokenizer, encoder, pick = Tokenizer.from_file(PATH), packing.WordEncoder(PATH), random.Random(6)
    for _ in range(5000):
        text = "".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, 16)))
        if pick.random() < 0.3:
            text += pick.choice(["it's", "DON'T", "we'll'd", "'re'", "<|endoftext|>", "a<|startoftext|>b", "rock'n'roll"])
        assert encoder.encode(text) == plain_ids(tokenizer, text), repr(text)


def test_memory_is_bounded():
    each = packing.ENTRY_BYTES + sys.getsizeof("a") + sys.getsizeof(b"a")
    kept = packing.Kept(lambda k: k.encode(), 3 * each - 1)
    assert [kept[k] for k in "abcdea"] == [b"a", b"b", b"c", b"d", b"e", b"a"] and list(kept) == ["a", "b", "c"]
    long = "x" * (packing.LONGEST_KEPT + 1)
    assert packing.Kept(lambda k: k.encode(), 10**6)[long] == long.encode()


def test_a_worker_stays_within_its_bytes():
    """Half a million different words and some very long ones: the process grows by the bytes allowed and little more."""
    code = f"""
import resource, sys
sys.path[:0] = {sys.path!r}
from ledgerline.llm import packing
encoder = packing.WordEncoder({PATH!r})
encoder.encode("one")
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for i in range(500):
    encoder.encode(" ".join(f"w{{i}}q{{j}}ab{{j * 7}}" for j in range(1000)))
assert encoder.words.left <= 0
for i in range(3):
    encoder.encode("ab" * 50_000 + str(i))
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    grown = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert grown < (packing.WORD_BYTES + packing.PART_BYTES >> 20) + 40


def lengths(seed: int, number: int, capacity: int) -> dict[int, int]:
    pick = random.Random(seed)
    return dict(Counter(min(capacity, 1 + int(pick.expovariate(3 / capacity))) for _ in range(number)))


@pytest.mark.parametrize("capacity, number", [(64, 0), (64, 1), (64, 500), (64, 100_000), (2048, 3000)])
def test_patterns_hold_exactly_the_pieces(capacity, number):
    counts = lengths(capacity + number, number, capacity)
    patterns = packing.solve(counts, capacity)
    held: Counter = Counter()
    for pattern, many in patterns:
        assert many > 0 and sum(length * n for length, n in pattern) <= capacity
        for length, n in pattern:
            held[length] += n * many
    assert held == Counter(counts)
    least = -(-sum(k * v for k, v in counts.items()) // capacity)
    assert sum(m for _, m in patterns) <= least * 1.01 + 1


def test_never_more_bins_than_best_fit():
    total = lambda patterns: sum(many for _, many in patterns)
    for counts in ({n: 1000 for n in range(1, 257)}, {85: 700, 86: 700, 87: 700}, lengths(1, 5000, 256), {256: 3}, {}):
        plain, program = packing.best_fit(counts, 256), packing.rounded(counts, 256)
        assert total(packing.solve(counts, 256)) == min(total(plain), total(program))


def test_linear_program_takes_part():
    used = packing.fractional(lengths(9, 200_000, 256), 256)
    assert used and sum(used.values()) > 10_000
    assert all(sum(length * n for length, n in p) == 256 for p in used)


def test_best_fit_on_a_histogram():
    # 6 with 4, 5 with 5, 3 alone
    assert sum(m for _, m in packing.best_fit({6: 10, 4: 10, 5: 4, 3: 1}, 10)) == 13


def packed(spark, rows, capacity=2048):
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, sequence_id string")
    return packing.packed(docs, PATH, capacity, with_ids=True).collect()


def check(found, rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    want: Counter = Counter()
    for doc, text, *_ in rows:
        data = (plain_ids(tokenizer, text) if text else b"") + bytes(4)
        for n, at in enumerate(range(0, len(data), 4 * capacity)):
            part = data[at : at + 4 * capacity]
            want[doc, n, n * capacity, len(part) // 4, zlib.crc32(part), part] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in found) == want
    bins: dict = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_packed_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r[0], r[1], "x", "y") for r in table] + [(None, None, None, None), (5, "", "", ""), (5, "", "", ""), (None, "word " * 5000, None, None)]
    bins = check(packed(spark, rows), rows, 2048)
    total = sum(r["length"] for r in packed(spark, rows))
    assert bins <= -(-total // 2048) + 1


@pytest.mark.parametrize("partitions", [1, 5])
def test_one_id_and_length_many_times(spark, monkeypatch, partitions):
    """Pieces that share id, number and length are told apart by the block and rank they were given."""
    monkeypatch.setattr(packing, "BLOCK_PIECES", 10)
    rows = [(None, "the cat", None, None)] * 300 + [(1, "a dog ran", None, None)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, sequence_id string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = packing.packed(docs.repartition(partitions), PATH, 16, with_ids=True).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    assert check(found, rows, 16) <= -(-(300 * 3 + 200 * 4) // 16) + 5
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == 500


def test_small_sequences_and_empty_table(spark):
    rows = [(i, "the cat " * (i % 9), None, None) for i in range(60)]
    check(packed(spark, rows, 8), rows, 8)
    assert packed(spark, []) == []
