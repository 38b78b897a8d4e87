"""The queries of the text operators, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    counting,
    fingerprints,
    html,
    infill,
    langid,
    lm,
    mixing,
    packing,
    pii,
    quality,
    search,
    secrets,
    simhash,
)
from ledgerline.llm.common import staged, table, word_count

MIX_SEED = 20240601
INFILL_SEED = 1
TOKEN_LIMIT = 1024
HITS = 20


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The vocabulary file of a public tokenizer; executors have it at the same place."""
    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer_path())


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.judge(docs, model).select("row.doc_id", "judged.*")


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(table(spark, folder, "pages"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identified(table(spark, folder, "documents").select("doc_id", "text", "lang"))


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared(table(spark, folder, "documents"))


def op7_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lm.scored(docs, langid.held_out(F.col("doc_id"), 7, 2))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    found = mixing.mix(sized, F.col("size"), MIX_SEED)
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return found.select("row.doc_id", "size", "source_size", "target", taken)


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets_of(table(spark, folder, "documents"))


def op11_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return counting.counted(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), TOKEN_LIMIT)


def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), HITS)


def op13_infill(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digest(table(spark, folder, "documents"), INFILL_SEED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_pii": op2_pii,
    "op3_quality": op3_quality,
    "op4_html": op4_html,
    "op5_language": op5_language,
    "op6_fingerprints": op6_fingerprints,
    "op7_lm": op7_lm,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_tokens": op11_tokens,
    "op12_search": op12_search,
    "op13_infill": op13_infill,
}
SQL = {
    "op9_mixing": mixing.SQL.format(offset=repr(mixing.offset(MIX_SEED))),
    "op12_search": search.sql(HITS),
    "op13_infill": infill.SQL.format(seed=INFILL_SEED),
}
