from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import lm
from ledgerline.llm.langid import held_out


def run(spark, rows, batch=12_000_000):
    docs = spark.createDataFrame(rows, "doc_id long, text string, batch string, word string")
    return lm.scored(docs, held_out(F.col("doc_id"), 7, 2), batch).collect()


def tokens(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split() + [b""]


def held(doc):
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 7 == 2


@pytest.mark.parametrize("batch", [12_000_000, 2_000])
def test_base_scores(spark, batch):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(50)
    rows = [(r[0], r[1], "b", "w") for r in table.collect()] + [(900, None, None, None), (901, " É É\x1ca ", "", ""), (None, "The the", "", "")]
    counts = Counter(t for d, text, *_ in rows if not held(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    texts = {d: tokens(t) for d, t, *_ in rows}
    got = run(spark, rows, batch)
    assert len(got) == len(rows)
    for r in got:
        mine = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(mine), sum(counts[t] > 0 for t in mine), n)
        assert r["held_out"] == held(r["doc_id"])
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in mine))


def test_score_against_brute_force():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(lm.FEATURES + 1, lm.CLASSES))
    chances = np.exp(lm.class_chances(weights, np.arange(300)))
    assert np.allclose(chances.sum(axis=1), 1)
    starts = np.array([0, 3])
    past = lm._histories(np.array([5, 6, 7, 8, 9]), starts)
    assert past.tolist() == [0, 5, 5 * lm.SYMBOLS + 6, 0, 8]


def test_gradient_is_the_slope_of_the_likelihood():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(lm.FEATURES + 1, lm.CLASSES)) / 5
    history, group, n = np.array([3, 3, 700]), np.array([1, 2, 1]), np.array([4.0, 2.0, 5.0])

    def likelihood(w):
        return float((n * lm.class_chances(w, history)[np.arange(3), group]).sum())

    touched, slope, curve = lm.gradient(weights, history, group, n)
    assert touched[-1] == lm.FEATURES and set(lm.features(history).ravel()) == set(touched[:-1])
    for row, column in ((lm.features(history)[0, 0], 1), (lm.features(history)[2, 2], 5), (lm.FEATURES, 2)):
        step = np.zeros_like(weights)
        step[row, column] = 1e-5
        assert (likelihood(weights + step) - likelihood(weights - step)) / 2e-5 == pytest.approx(slope[touched == row, column][0], abs=1e-4)
        assert curve[touched == row, column][0] >= 0


def test_features_and_decisions_tell_words_apart():
    # Words with one ending, which the model took for the same word before.
    words = [b"walking", b"talking", b"parking", b"marking", b"barking", b"working", b"looking", b"cooking"]
    symbol = lm._symbols(words)
    assert len(set(symbol >> lm.WORD_BITS)) == 1 and len(set(symbol)) == len(words)
    assert len(set(map(tuple, lm.features(lm._histories(symbol, np.array([0])))[1:]))) == len(words) - 1
    assert len(set(lm.sets(symbol))) > 1
    assert lm._unpacked(lm._packed(symbol)).tolist() == symbol.tolist()


def test_chances_of_classes_and_decisions_sum_to_one():
    rng = np.random.default_rng(3)
    table = rng.normal(size=lm.SIZE)
    every = np.arange(1 << lm.CLASS_BITS + lm.LEVELS)
    symbol = (every >> lm.LEVELS << lm.WORD_BITS) + every % (1 << lm.LEVELS)
    assert sorted(lm.sets(symbol)) == every.tolist()
    texts = np.stack([np.full(len(every), 77), np.full(len(every), 1234), symbol], axis=1).ravel()
    found = lm.log_chances(table, texts, np.arange(len(every)) * 3).reshape(-1, 3)
    assert np.exp(found[:, 2]).sum() == pytest.approx(1)
    assert np.allclose(found[:, :2], found[0, :2])


def test_slopes_are_those_of_the_likelihood():
    rng = np.random.default_rng(4)
    table, sums = rng.normal(size=lm.SIZE) / 5, np.zeros(lm.SIZE)
    symbol = lm._symbols([b"the", b"cat", b"sat", b"", b"the", b"dog", b""])
    starts = np.array([0, 4])
    lm.slopes(table, symbol, starts, sums)
    ends = np.cumsum([int(np.prod(shape)) for shape in lm.SHAPES])
    touched = np.flatnonzero(sums)
    for low, high in zip([0, *ends[:-1]], ends, strict=True):
        for at in rng.choice(touched[(touched >= low) & (touched < high)], 5):
            step = np.zeros(lm.SIZE)
            step[at] = 1e-5
            up, down = (lm.log_chances(table + x, symbol, starts).sum() for x in (step, -step))
            assert (up - down) / 2e-5 == pytest.approx(sums[at], abs=1e-3)


def test_a_word_depends_on_the_word_before_it(spark):
    # All four words share ending and count, so that only what is before them tells them apart.
    rows = [(i, "left walking right talking " * 20, None, None) for i in range(200)]
    probe = [(1000 + i, "left talking right walking " * 20, None, None) for i in range(50)]
    got = run(spark, rows + [r for r in probe if held(r[0])])
    seen = [r["score"] for r in got if r["doc_id"] < 200]
    swapped = [r["score"] for r in got if r["doc_id"] >= 1000]
    assert swapped and min(seen) > max(swapped) + 10


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = [r for r in lm.scored(docs, held_out(F.col("doc_id"), 7, 2)).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_token_numbers_survive_storing():
    for values in ([], [0, 1, 65535], [0, 65536, 1 << 23]):
        tokens = np.array(values, dtype=np.int32)
        assert lm._restored(lm._stored(tokens), len(values)).tolist() == values


@pytest.mark.parametrize("lengths", [[], [5], [1, 1, 1, 1], [9, 1, 1, 1], [1, 1, 9, 1], [3, 3, 3]])
def test_chunks_hold_every_text_once(lengths):
    found = list(lm._chunks(lengths, 3))
    assert [i for first, last in found for i in range(first, last)] == list(range(len(lengths)))
    assert all(first < last and sum(lengths[first : last - 1]) < 3 for first, last in found)


def test_counts_do_not_depend_on_chunks(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40)
    plain = lm.digested(docs, held_out(F.col("doc_id"), 7, 2)).drop("batch")
    want = sorted(map(str, plain.collect()))
    monkeypatch.setattr(lm, "COUNTED", 50)
    assert sorted(map(str, lm.digested(docs, held_out(F.col("doc_id"), 7, 2)).drop("batch").collect())) == want


def test_edges(spark):
    assert run(spark, []) == []
    only_held = next(i for i in range(100) if held(i))
    (r,) = run(spark, [(only_held, "a b", None, None)])
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0) and math.isfinite(r["score"])
    two = run(spark, [(1, "a b", None, None)] * 2)
    assert two[0] == two[1]
