from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from ledgerline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text: str | None) -> list[int]:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_counts_against_the_definition():
    pick = random.Random(4)
    parts = ["a", "b", "c", " ", " ", "\n", "\t", "\x0b", "\x1c", "\xa0", "é", "😀", "#", "*", "<"]
    for _ in range(1500):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 60)))
        assert quality.measure(text)[0] == plain_counts(text), text
    for text in (None, "", " \n ", "a a a a", "word " * 30_000):
        assert quality.measure(text)[0] == plain_counts(text)


def test_many_different_words_share_no_key():
    places = np.array([0, 1, 2, 5, 0, 1, 2])
    assert quality.repeated_words(places, 6) == quality.repeated_words(places, 1 << 40) == 6


def test_flat_trees_and_constraints():
    rng = np.random.default_rng(1)
    rows = rng.random((1500, 3))
    labels = ((rows[:, 0] < 0.6) & (rows[:, 1] > 0.2)).astype(float)
    labels[rng.random(1500) < 0.1] = 0
    model = quality.fit(rows, labels, [-1, 1, 0], trees=30)
    assert ((model.score(rows) >= 0.5) == labels).mean() > 0.85
    for f, direction in ((0, -1), (1, 1)):
        for _ in range(60):
            line = np.repeat(rng.random((1, 3)), 80, axis=0)
            line[:, f] = np.linspace(-0.5, 1.5, 80)
            assert (np.diff(model.margin(line)) * direction >= -1e-9).all()

    def walk(node: int, row: np.ndarray) -> float:
        while model.left[node] != node:
            node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
        return model.value[node]

    want = [model.start + sum(walk(r, row) for r in model.roots) for row in rows[:50]]
    assert np.allclose(model.margin(rows[:50]), want)


def test_held_out_accuracy_on_the_test_table(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where("doc_id % 3 <> 0"))
    judged = quality.judge(docs, model).select("row.doc_id", "judged.*")
    tested = judged.join(labels.where("doc_id % 3 = 0"), "doc_id").where("not base_failed").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in tested)
    assert right / len(tested) > 0.95


def test_edges(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, good, "x", "y"), (1, good, "x", "y"), (None, good, None, None), (2, None, None, None), (3, "", None, None), (4, "a b " * 40, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, judged string, row string")
    labels = spark.createDataFrame([(None, 1), (9, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)  # nothing to learn from
    out = quality.kept(docs, model)
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [1, 1, None]
    judged = quality.judge(docs, model).select("judged.*").collect()
    assert [r["base_failed"] for r in judged] == [False, False, False, True, True, True]
    assert [r["n_repeat_words"] for r in judged][-1] == 80
    assert quality.judge(docs.limit(0), model).count() == 0
