from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from ledgerline.llm import search
from ledgerline.llm.common import staged

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(UPPER))


def brute(docs: list[tuple], queries: list[tuple], k: int) -> set[tuple]:
    """(item, rank, id, score) as the contract words it, over every document."""
    found = [(key, Counter(terms(text)), len(terms(text))) for key, text in docs]
    n, l = sum(size > 0 for *_, size in found), sum(size for *_, size in found)
    df = Counter(t for _, counts, _ in found for t in counts)
    made = set()
    for item, text in queries:
        scores = []
        for key, counts, size in found:
            score = 0
            for t in terms(text):
                if counts[t]:
                    m = 75 + 25 * size * n // l
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score:
                scores.append((-score, key is None, key or 0, key))
        made |= {(item, i + 1, key, -score) for i, (score, _, _, key) in enumerate(sorted(scores, key=lambda s: s[:3])[:k])}
    return made


def corpus(n: int, seed: int, words: int = 60) -> list[tuple]:
    pick = random.Random(seed)
    names = [f"w{i}" for i in range(words)]
    weight = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(pick.choices(names, weight, k=pick.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("text", ["", "A-b_C1 é\x00Ünder ÀB", "naïve 東京,大阪 x y", "\x7f{}~`'[0"])
def test_terms(text):
    assert [t.decode() for t in search.terms_of(text)] == terms(text)
    assert search.terms_of(None) == []


def test_numbers_come_back():
    values = [0, 1, 127, 128, 16383, 16384, 1 << 40, (1 << 62) - 1, 5]
    data, ends = search.packed_numbers(pa.array(values).to_numpy())
    assert search.unpacked_numbers(data).tolist() == values and ends[-1] == len(data)
    assert search.unpacked_numbers(data[ends[2] : ends[4]]).tolist() == values[3:5]


@pytest.mark.parametrize("k, block, window, docs", [(1, 2, 5, 7), (3, 4, 16, 1000), (20, 128, 1024, 50), (50, 3, 7, 90)])
def test_against_every_document(monkeypatch, k, block, window, docs):
    """Blocks, windows and shards of awkward sizes, with equal scores and repeated texts, give the scores of all."""
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "WINDOW", window)
    monkeypatch.setattr(search, "SHARD_DOCS", docs)
    rows = corpus(300, k)
    rows += [(1000 + i, rows[i % 5][1]) for i in range(60)] + [(7, "é É w1"), (None, "w3 w3"), (2000, None), (2001, "")]
    queries = [(i, text) for i, (_, text) in enumerate(corpus(25, 99))] + [(90, "É w1 w1 none"), (91, "!"), (92, None)]
    shards, shard = [], search.Shard()
    for key, text in rows:
        shard.add(key, text)
        if shard.full():
            shards.append(shard)
            shard = search.Shard()
    shards.append(shard)
    lists = [pa.Table.from_batches(s.rows(i, pa.int64(), step=7)).to_pylist() for i, s in enumerate(shards) if s.ids]
    whole = [row for rows_ in lists for row in rows_ if row["term"] is None]
    about = search.Corpus(sum(r["n"] for r in whole), sum(r["total"] for r in whole))
    df: dict = defaultdict(int)
    for rows_ in lists:
        for row in rows_:
            if row["term"] is not None:
                df[row["term"]] += row["n"]
    weight = defaultdict(int, {t: about.weight(n) for t, n in df.items()})
    asked = [(i, Counter(terms(text))) for i, text in queries]
    hits = [hit for rows_ in lists for hit in search.shard_hits(rows_, asked, weight, about, k)]
    made = set()
    for item, _ in queries:
        mine = sorted(((-s, d is None, d or 0, d) for i, d, s in hits if i == item), key=lambda s: s[:3])[:k]
        made |= {(item, rank + 1, d, -s) for rank, (s, _, _, d) in enumerate(mine)}
    assert made == brute(rows, queries, k)


def test_blocks_are_skipped(monkeypatch):
    """A document that holds the rare term outranks all others: the common list is hardly decompressed."""
    opened = []
    know = search.Postings.know
    monkeypatch.setattr(search.Postings, "know", lambda self, blocks: know(self, opened.extend(b := list(blocks)) or b))
    shard = search.Shard()
    for i in range(8000):
        shard.add(i, "rare rare rare rare word" if i in (3, 900) else "word " + "filler " * (5 + i % 7))
    rows = pa.Table.from_batches(shard.rows(0, pa.int64())).to_pylist()
    about = search.Corpus(8000, rows[0]["total"])
    lists = {r["term"]: r["n"] for r in rows[1:]}
    weight = defaultdict(int, {t: about.weight(n) for t, n in lists.items()})
    weight["word"] = 1
    found = search.shard_hits(rows, [(0, Counter(["rare", "word"]))], weight, about, 2)
    assert [doc for _, doc, _ in found] == [3, 900]
    assert len(opened) < 8000 // search.BLOCK / 4


def run(spark, docs, queries, k):
    frame = spark.createDataFrame(docs, "doc_id long, text string, term string, shard int, n string")
    asked = spark.createDataFrame(queries, "item_id long, text string, score string, query long")
    found = search.ranked(frame.repartition(3), asked, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return {tuple(r) for r in found.collect()}


def test_in_spark(spark, monkeypatch):
    """Several shards and blocks of queries, nulls, ties, repeated rows, other columns of the index's names."""
    monkeypatch.setattr(search, "SHARD_DOCS", 40)
    monkeypatch.setattr(search, "QUERY_BYTES", 20)
    docs = corpus(200, 5) + [(500, "w1 w2"), (501, "w1 w2"), (None, "w1 w2"), (502, None), (503, "x" * 100_000)]
    queries = corpus(12, 6) + [(70, None), (71, "..."), (72, "absent"), (None, "w5 w6")]
    made = run(spark, [(*d, "t", 1, "n") for d in docs], [(*q, "s", 2) for q in queries], 5)
    assert made == brute(docs, queries, 5)


def test_empty_tables(spark):
    one = [(1, "a b", "", 0, "")]
    assert run(spark, [], [(1, "a", "", 0)], 3) == set()
    assert run(spark, one, [], 3) == set()
    assert run(spark, [(1, None, "", 0, ""), (2, "", "", 0, "")], [(1, "a", "", 0)], 3) == set()


def test_index_holds_every_row(spark):
    docs = spark.createDataFrame([(i % 3 or None, "a A b" if i % 2 else None) for i in range(30)], "doc_id long, text string")
    index = staged(search.indexed(docs), "index")
    whole = index.where("term is null").collect()
    assert sum(len(r["ids"]) for r in whole) == 30 and sum(r["total"] for r in whole) == 45
    lists = index.where("term = 'a'").collect()
    assert sum(r["n"] for r in lists) == 15 and sum(r["total"] for r in lists) == 30
