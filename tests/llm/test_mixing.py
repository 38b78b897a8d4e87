from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing
from ledgerline.llm.common import word_count


def aims(sizes: dict) -> dict:
    """Targets by resharing the excess step by step, as the rule is worded."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.CYCLE[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    left = float(total)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def run(spark, rows, seed=1):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, row string, size string")
    found = mixing.mix(docs, word_count(F.col("text")), seed)
    return found.select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()


def made(n: int, sources: list, seed: int = 4) -> list[tuple]:
    pick = random.Random(seed)
    return [(i, pick.choice(sources), " ".join("w" for _ in range(pick.randint(0, 90))), "x", "y") for i in range(n)]


@pytest.mark.parametrize("sources", [["a"], ["a", "b", None], ["a"] * 30 + ["b", "c", "d", "é", None]])
def test_targets_and_copies(spark, sources):
    rows = made(400, sources)
    found = run(spark, rows)
    sizes: dict = {}
    for _, source, text, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = aims(sizes)
    taken = dict.fromkeys(sizes, 0)
    assert len(found) == len(rows)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for source, words in taken.items():
        assert abs(words - want[source]) <= 2 * 90
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_copies_follow_the_running_sum(spark):
    rows = made(60, ["a", "b"])
    found = {r["doc_id"]: r for r in run(spark, rows, 9)}
    for source in ("a", "b"):
        def place(row):
            size, digest = found[row[0]]["size"], hashlib.md5(str(row[0]).encode()).hexdigest()
            return (len(str(size)), str(size)[:2], digest[:2], size, digest)

        mine = sorted((r for r in rows if r[1] == source), key=place)
        share = min(found[mine[0][0]]["target"] / found[mine[0][0]]["source_size"], 3.0)
        for rank, row in enumerate(mine):
            u = mixing.offset(9)
            assert found[row[0]]["copies"] == math.floor((rank + 1) * share + u) - math.floor(rank * share + u)


def test_same_whatever_the_partitioning(spark):
    docs = spark.createDataFrame(made(200, ["a", "b", None]), "doc_id long, source string, text string, row string, size string")
    runs = [
        {r["doc_id"]: r["copies"] for r in mixing.mix(d, word_count(F.col("text")), 3).select("row.doc_id", "copies").collect()}
        for d in (docs, docs.repartition(7).orderBy(F.rand(3)))
    ]
    assert runs[0] == runs[1]


def test_edges(spark):
    assert run(spark, []) == []
    # Without words nothing is taken; nulls and repeated rows are documents of their own.
    assert [r["copies"] for r in run(spark, [(1, "a", None, None, None), (1, "a", "", None, None), (None, None, " \n", None, None)])] == [0] * 3
    twice = run(spark, [(7, None, "a b", None, None)] * 2 + [(None, "s", "c d e f", None, None)])
    assert sorted((r["source_size"], r["target"]) for r in twice) == [(4, pytest.approx(16 / 7))] * 2 + [(4, pytest.approx(40 / 7))]


def test_the_mix_repeats_rows(spark):
    rows = made(100, ["a", "b", "c"])
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, row string, size string")
    copies = {r["doc_id"]: r["copies"] for r in run(spark, rows, 5)}
    out = mixing.mixed(docs, word_count(F.col("text")), 5)
    assert out.columns == docs.columns
    seen: dict = {}
    for r in out.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}
