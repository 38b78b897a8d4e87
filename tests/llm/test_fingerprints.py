from __future__ import annotations

import hashlib
import re

import pytest

from ledgerline.llm import fingerprints as fp

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, anchors string, _to string, row string"


def plain_compare(spark, rows):
    """Brute force on the driver; hashes come from the engine."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    pairs = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        pairs.append((doc, text, text[: len(text) - half] + after[:half], after))
    words = sorted({w for p in pairs for t in p[1:] for w in WORD.findall(t)})
    frame = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) h")
    word_hash = {r["w"]: r["h"] for r in frame.collect()}
    two = {(a, b) for p in pairs for t in p[1:] for a, b in zip(WORD.findall(t), WORD.findall(t)[1:], strict=False)}
    frame = spark.createDataFrame([(a, b, word_hash[a], word_hash[b]) for a, b in two], "a string, b string, x long, y long") if two else None
    pair_hash = {(r["a"], r["b"]): r["h"] for r in frame.selectExpr("a", "b", "xxhash64(x, y) h").collect()} if two else {}

    def windows(text):
        found = WORD.findall(text)
        inner = [pair_hash[p] for p in zip(found, found[1:], strict=False)]
        return found, [(i, inner[i : i + 7]) for i in range(len(found) - 7) if min(inner[i : i + 7]) in (inner[i], inner[i + 6])]

    return pairs, windows, word_hash


@pytest.mark.parametrize("block", [1 << 23, 300])
def test_against_brute_force(spark, block, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = [(r[0] * 7 - 50, r[1]) for r in docs.collect()] + [(None, "only null id here"), (10_000, None), (10_001, ""), (10_002, "é😀x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(fp, "BLOCK_CHARS", block)
    monkeypatch.setattr(fp.followed, "__defaults__", (block,))
    got = {r["doc_id"]: r for r in fp.compared(frame).collect()}
    assert len(got) == len(rows)
    pairs, windows, word_hash = plain_compare(spark, rows)
    for doc, text, edited, _ in pairs:
        assert got[doc]["n_chars"] == len(text)
        assert got[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for shown, whole in ((got[doc]["fingerprint"], text), (got[doc]["edited_fingerprint"], edited)):
            found, anchors = windows(whole)
            places = [int(a.split("@")[1]) for a in shown.split()]
            if len(found) >= fp.WINDOW:
                assert places == [i for i, _ in anchors]
            else:
                want = [f"{(word_hash[w] >> 32) & 0xFFFFFFFF:08x}@{i}" for i, w in enumerate(found)]
                assert shown.split() == want


@pytest.mark.parametrize("n", range(8, 15))
def test_texts_with_words_have_anchors(spark, n):
    texts = [" ".join(f"w{n}x{i}y{j}" for j in range(n)) for i in range(40)] + ["", " \n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"].split() for r in fp.fingerprinted(docs).collect()}
    assert not got[40] and not got[41]
    pairs, windows, _ = plain_compare(spark, list(enumerate(texts)))
    for doc, text, *_ in pairs:
        chosen = [i for i, _ in windows(text)[1]]
        assert [int(a.split("@")[1]) for a in got[doc]] == (chosen or list(range(max(0, len(text.split()) - 7))))
    for r in fp.compared(docs.where("doc_id < 40")).collect():
        assert r["near_next"] == 0.0  # no two of them share a word


def test_likeness_counts_shared_anchors(spark):
    text = " ".join(f"w{i}" for i in range(400))
    moved = "x y z " + text
    docs = spark.createDataFrame([(2, text), (1, moved), (0, " ".join(f"v{i}" for i in range(400)))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in fp.compared(docs).collect()}
    assert got[2]["near_next"] > 0.95  # anchors don't depend on where a passage stands
    assert got[1]["near_next"] == 0.0
    assert 0.35 < got[2]["near_edited"] <= 1.0


def test_edges(spark):
    rows = [(5, "a b c", "x", "y", "z"), (5, "a b c", "x", "y", "z"), (None, None, None, None, None), (None, "", None, None, None), (4, None, "", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = fp.compared(docs).collect()
    assert len(got) == 5 and {r["n_chars"] for r in got} == {0, 5}
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 5}) == 1
    assert fp.compared(docs.limit(0)).count() == 0
    (alone,) = fp.compared(docs.limit(1)).collect()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"a ba ").hexdigest()
    assert fp.fingerprinted(docs).columns == [*docs.columns, "fingerprint"]


def test_plan_is_native_and_moves_the_text_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = fp.compared(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert plan.count("Exchange hashpartitioning") == 1
