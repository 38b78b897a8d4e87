from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from itertools import accumulate

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import mixing, pii, quality, registry
from ledgerline.llm.common import staged, table, word_count

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "pii", "mixing", "packing"]


def test_stages_one_by_one(spark):
    docs = table(spark, FOLDER, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, FOLDER), f"test-{name}")
        if name in ("quality", "simhash"):
            assert 0 < docs.count() < before.count() and docs.exceptAll(before).count() == 0
        if name == "pii":
            assert docs.count() == before.count()
            assert docs.where("text rlike '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+|@mail'").count() == 0
        if name == "mixing":
            assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name != "packing":
            assert docs.columns == COLUMNS
    assert docs.agg({"length": "max"}).first()[0] <= 2048


def plain_fingerprint(text):
    """As the contract of the SimHash words it."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_stages_against_brute_force(spark):
    """Every stage on all that the one before it kept, row by row: rules and trees, all pairs of fingerprints, spans of each
    text, the mix as SQL, and the tokens of every document in gapless sequences."""
    docs = table(spark, FOLDER, "documents").orderBy("doc_id").limit(120)
    labels = table(spark, FOLDER, "labels")
    stages = dict(corpus_pipeline.STAGES)
    kept = staged(stages["quality"](spark, docs, FOLDER), "brute-quality")
    model = quality.train(docs, labels)
    good = set()
    for row in docs.collect():
        counts, statistics = quality.measure(row["text"])
        if not quality.base_failed(counts[0], counts[4]) and model.score(np.array([statistics]))[0] >= quality.KEEP_FROM:
            good.add(row["doc_id"])
    assert {r["doc_id"] for r in kept.collect()} == good and len(good) > 20

    single = staged(stages["simhash"](spark, kept, FOLDER), "brute-simhash")
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in kept.collect()}
    group = {d: d for d in prints}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                group[max(top(a), top(b))] = min(top(a), top(b))
    left = {r["doc_id"] for r in single.collect()}
    assert sorted(map(top, left)) == sorted({top(d) for d in prints}) and len(left) < len(prints)

    clean = staged(stages["pii"](spark, single, FOLDER), "brute-pii")
    want = {(r["doc_id"], pii.redact(r["text"], pii.spans(r["text"]))) for r in single.collect()}
    assert {(r["doc_id"], r["text"]) for r in clean.collect()} == want

    mix = staged(stages["mixing"](spark, clean, FOLDER), "brute-mixing")
    duck = duckdb.connect()
    duck.register("documents", clean.toArrow())
    taken = duck.execute(mixing.SQL.format(offset=repr(mixing.offset(registry.MIX_SEED)))).fetchall()
    names = [c[0] for c in duck.description]
    rows = [dict(zip(names, r, strict=True)) for r in taken]
    copies = Counter(r["doc_id"] for r in mix.collect())
    assert {d: n for d, n in copies.items()} == {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]}

    packed = stages["packing"](spark, mix, FOLDER).collect()
    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    wanted: Counter = Counter()
    for r in mix.collect():
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0], dtype="<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            wanted[r["doc_id"], n, zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed) == wanted
    bins: dict = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        ends = list(accumulate(length for _, length in sorted(pieces)))
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_mixed_texts_are_the_same_at_any_partitioning(spark):
    """Also where rows share id and size, and where ids are null."""
    rows = [(None if i % 3 else i % 2, "abc"[i % 2], f"w{i} w w") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    size = word_count(F.col("text"))
    found = [sorted(map(str, mixing.mixed(docs.repartition(n, *by), size, 3).collect())) for n, by in ((1, ()), (4, ()), (7, ("text",)))]
    assert found[0] == found[1] == found[2] and len(found[0]) > 0


def test_labels_that_differ_are_left_out(spark):
    """A document with both labels teaches nothing, in whatever order the labels come."""
    docs = table(spark, FOLDER, "documents")
    labels = table(spark, FOLDER, "labels").select("doc_id", "quality")
    both = labels.unionByName(labels.limit(40).withColumn("quality", 1 - F.col("quality")))
    alone = labels.join(labels.limit(40), "doc_id", "left_anti")
    models = [quality.train(docs, x) for x in (alone, both.repartition(1), both.repartition(5).orderBy(F.desc("quality")))]
    for model in models[1:]:
        assert all(np.array_equal(a, b) for a, b in zip(vars(models[0]).values(), vars(model).values(), strict=True))


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, FOLDER, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_registered_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(FOLDER):
        duck.execute(f"create view {file.split('.')[0]} as select * from '{FOLDER}/{file}'")
    found = registry.QUERIES[name](spark, FOLDER)
    want = duck.execute(f"select {', '.join(found.columns)} from ({registry.SQL[name]})").fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
