from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import langid


def test_profile():
    assert langid.profile(None) is None and langid.profile(" 12 !?") is None
    one, two = langid.profile("Ab, cd"), langid.profile("ab --- CD!!")
    assert np.allclose(one, two) and abs(np.linalg.norm(one) - 1) < 1e-4
    assert langid.profile("中文 𠀀") is not None
    assert langid.profile("word " * 400_000) is not None


def test_machine_separates():
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.normal(1, 1, (80, 6)), rng.normal(-1, 1, (400, 6))]).astype(np.float32)
    signs = np.array([1] * 80 + [-1] * 400)
    assert (np.sign(rows @ langid.svm(rows, signs)) == signs).mean() > 0.95


def test_families_join_the_closest():
    means = np.eye(4) + 0.01
    means[1] = means[3] + 0.05
    assert sorted(langid.families(means), key=len)[-1] in ([1, 3], [0, 1, 3], [1, 2, 3])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in out)


def test_labels_of_held_out_documents_are_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    one, two = (sorted(map(tuple, langid.identified(d).collect())) for d in (docs, changed))
    assert one == two


def test_edges(spark):
    rows = [(1, "das ist gut", "de", "x"), (1, "das ist gut", "de", "x"), (2, None, None, None), (3, "12", "en", ""), (None, "it is", None, "y"), (4, "", "fr", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _found string")
    out = langid.identified(docs).collect()
    assert [r["lang_pred"] == "und" for r in out] == [False, False, True, True, False, True]
    assert langid.identified(docs.limit(0)).count() == 0
    nothing = langid.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and {r["score"] for r in nothing} == {0.0}
