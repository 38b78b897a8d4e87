from __future__ import annotations

import random
from itertools import product

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash


def plain_print(text: str | None) -> int:
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], distance: int) -> list[int]:
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One two", "a b c", "é È a  b\x0bc\x1cd", "A b C " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


def test_long_text():
    pick = random.Random(1)
    text = " ".join(str(pick.randint(0, 5000)) for _ in range(150_000))
    assert simhash.fingerprint(text) == plain_print(text)


def crowds(seed: int, number: int) -> list[int]:
    """Fingerprints around a few centres, some many at one place."""
    pick = random.Random(seed)
    found = []
    for _ in range(number):
        centre = pick.getrandbits(64)
        for _ in range(pick.choice([1, 2, 5, 40])):
            value = centre
            for bit in pick.sample(range(64), pick.randint(0, 3)):
                value ^= 1 << bit
            found.append(value)
    return found


def linked(spark, values: list[int], distance: int, crowd: int) -> dict[int, int]:
    signed = [(i, simhash._signed(v)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(signed, "doc_id long, fp long")
    found = {r["fp"]: r["component_id"] for r in simhash.classes(frame, distance, crowd).collect()}
    return {i: found[v] for i, v in signed}


@pytest.mark.parametrize("distance, crowd, seed", [(2, 64, 1), (2, 0, 2), (2, 3, 3), (1, 64, 4), (1, 1, 5)])
def test_components_against_all_pairs(spark, distance, crowd, seed):
    values = crowds(seed, 40) + [0, 3, (1 << 64) - 1]
    want = plain_components(values, distance)
    assert linked(spark, values, distance, crowd) == dict(enumerate(want))


def test_chain(spark):
    # Each is two bits from the next, the ends are far apart.
    values = [(1 << 2 * n) - 1 for n in range(24)]
    assert set(linked(spark, values, 2, 64).values()) == {0}


def test_plan_finds_every_pair():
    pick = random.Random(7)
    values = crowds(8, 60)
    bits = np.array([[v >> b & 1 for b in range(64)] for v in values])
    plan = simhash.search_plan(len(values), bits.T @ bits)
    for _ in range(2000):
        a = pick.getrandbits(64)
        b = a
        for bit in pick.sample(range(64), 2):
            b ^= 1 << bit
        assert any(sum((a ^ b) >> bit & 1 for bit in chain) <= t for chain, t in plan)


def test_allocation_is_the_cheapest():
    pick = random.Random(3)
    for _ in range(50):
        costs = [[0.0, *sorted(pick.random() * 10 for _ in range(3))] for _ in range(3)]
        cost, thresholds = simhash.allocate(costs, 0)
        ways = [t for t in product((-1, 0, 1, 2), repeat=3) if sum(t) == 0]
        assert cost == pytest.approx(min(sum(c[t + 1] for c, t in zip(costs, way, strict=True)) for way in ways))
        assert sum(thresholds) == 0


DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, row string, place int, component_id int"


def rows(*pairs):
    return [(i, t, None, None, None, "f", "r", 1, 2) for i, t in pairs]


def test_queries_result(spark):
    texts = [(5, "a b c d"), (3, "A B  c\nd"), (9, None), (8, ""), (None, "x y z"), (7, "x y z"), (7, "x y z"), (None, "alone here it is")]
    found = simhash.near_duplicates(spark.createDataFrame(rows(*texts), DOCS)).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in found), key=str) == sorted(
        [(5, 3), (3, 3), (9, 8), (8, 8), (None, 7), (7, 7), (7, 7), (None, None)], key=str
    )
    assert {r["fingerprint"] for r in found if r["doc_id"] in (8, 9)} == {"0" * 16}
    assert {r["fingerprint"] for r in found if r["doc_id"] in (3, 5)} == {f"{plain_print('a b c d'):016x}"}


def test_one_of_each_group_stays(spark):
    texts = [(5, "a b c d"), (3, "A B  c\nd"), (3, "A B  c\nd"), (9, None), (8, ""), (None, "x y z"), (None, "x y z"), (2, "else it is"), (2, "quite other words")]
    docs = spark.createDataFrame(rows(*texts), DOCS)
    out = simhash.without_near_duplicates(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    # Two different texts that share an id are components of their own.
    assert got == sorted([(3, "A B  c\nd"), (8, ""), (None, "x y z"), (2, "else it is"), (2, "quite other words")], key=str)
    assert simhash.without_near_duplicates(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_native_hash_agrees(spark):
    # The seed and hash of the contract are those of the engine's own function.
    value = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert value == simhash._signed(xxhash.xxh64_intdigest(b"a b c", 42))
