"""What the text operators share: reading tables, written cuts of a plan, words and null-safe keys."""

from __future__ import annotations

import sys
import types

import ledgerline.llm
from ledgerline.session import prepare, shared_folder
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What runs inside tasks is sent along with them, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(ledgerline.llm)

# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows per Arrow batch: texts can be very long, so that a batch stays small even when all of them are.
BATCH_ROWS = 512


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's runtime settings and small Arrow batches."""
    prepare(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def staged(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: later jobs neither repeat the work nor lose it
    with an executor."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def null_last(column: str | Column) -> Column:
    """A text as a key that is never null, keeps its order, and puts null last."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("a"), column.cast("string")), F.lit("b"))


def worker_memory() -> dict:
    """What a Python worker keeps from one task to the next."""
    name = "ledgerline_worker_memory"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def inner_name(taken: list[str], wanted: str) -> str:
    """A column name that the caller's frame does not use."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted
