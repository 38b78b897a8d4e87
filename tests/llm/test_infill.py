from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import infill


def made(text: str | None, key: object, seed: int = 1) -> tuple:
    """One row by the words of the contract."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:lo], text[lo:hi], text[hi:]
    if h4 % 100 < 20:
        return n, "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}"


SIGNS = "aZ é東𝟘👩́\n\x00<P>"


def texts(n: int, longest: int, seed: int = 2) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choices(SIGNS, k=pick.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("longest", [0, 1, 3, 9, 40, 700])
def test_rank_and_select(longest):
    """Every place of every code point, over word borders and several texts in a row."""
    whole = "".join(texts(20, longest))
    data = np.frombuffer(whole.encode(), dtype=np.uint8)
    points = infill.CodePoints(data)
    ends = np.cumsum([len(c.encode()) for c in whole]).astype(np.int64)
    if len(ends):
        assert points.select(np.arange(1, len(ends) + 1)).tolist() == ends.tolist()
    at = np.arange(len(data) + 1)
    assert points.rank(at).tolist() == [int((ends <= b).sum()) for b in at]


@pytest.mark.parametrize("group", [1, 100, 1 << 20])
def test_texts_in_groups(monkeypatch, group):
    monkeypatch.setattr(infill, "GROUP_BYTES", group)
    rows = [*texts(300, 50), "", "x<P>y", "<S", "ab<M>", "é" * 10_000]
    whole = pa.array(["skipped", *rows])
    found = infill.arranged(list(range(len(rows))), whole.slice(1), 1)
    assert [(*f[:4], f[4].decode()) for f in found] == [made(t, i) for i, t in enumerate(rows)]


def test_in_spark(spark):
    """Outputs and the way back; nulls, repeated rows, marks in texts, other columns with the names of ours."""
    rows = [(i, t) for i, t in enumerate(texts(400, 30))]
    rows += [(None, "a null id"), (None, None), (5, None), (7, "twice"), (7, "twice"), (-3, "minus"), (9, "<M>"), (4, "x" * 10**6)]
    frame = spark.createDataFrame([(*r, "o", "f") for r in rows], "doc_id long, text string, output string, form string")
    found = infill.transformed(frame.repartition(3))
    back = found.withColumn("back", infill.restored(F.col("form"), F.col("output"))).collect()
    want = sorted(((k, *made(t, k), t or "") for k, t in rows), key=str)
    assert sorted((tuple(r) for r in back), key=str) == want
    forms = {r["form"] for r in back}
    assert forms == {"plain", "psm", "spm"}
    hashed = infill.digest(frame).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((tuple(r) for r in hashed), key=str) == sorted(
        ((k, *(m := made(t, k))[:4], sha(m[4]), sha(t or "")) for k, t in rows), key=str
    )


def test_empty_table_and_text_keys(spark):
    frame = spark.createDataFrame([("k", "some words here")], "doc_id string, text string")
    assert [tuple(r) for r in infill.transformed(frame).collect()] == [("k", *made("some words here", "k"))]
    assert infill.transformed(frame.limit(0)).count() == 0


def test_marks_that_cuts_make(spark):
    """Parts that begin or end with pieces of marks don't mislead the way back."""
    pieces = ["<", "P>", "<S", ">", "M", "<M", "S>"]
    pick = random.Random(8)
    rows = [(i, "".join(pick.choices(pieces, k=6))) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = infill.transformed(frame)
    back = found.select("doc_id", infill.restored(F.col("form"), F.col("output")).alias("back")).collect()
    assert {tuple(r) for r in back} == set(rows)
