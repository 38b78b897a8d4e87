"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import hash_bytes

META = ("_ingested_at", "_batch_id", "_source", "_record_hash")


def latest_by(df: DataFrame, key: str, newest_first: tuple[str, ...] = ("_ingested_at", "_batch_id")) -> DataFrame:
    """The newest row of each key; rows without a key are dropped first.

    The record hash breaks ties, so that a query reads no other column for the order; feeds without one fall back
    on all remaining business columns. Either way the order is total up to equal rows and the result does not depend
    on partitioning. The ``row_number() = 1`` shape lets Catalyst put a group limit below the exchange: each map
    task keeps one row per key, so a key that is repeated very often is thinned out before the shuffle.
    """
    hashed = dict(df.dtypes).get("_record_hash")
    ties = [F.col("_record_hash")] if hashed else [F.col(c) for c in df.columns if c != key and c not in META]
    if hashed == "string":
        ties = [hash_bytes("_record_hash")]
    order = [c.desc_nulls_last() for c in (*map(F.col, newest_first), *ties)]
    window = Window.partitionBy(key).orderBy(*order)
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_per_group(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The row with the greatest ``by`` in each group, ties broken by the other columns."""
    ties = [c for c in df.columns if c != by and c not in keys and c not in META]
    order = [F.col(c).desc_nulls_last() for c in (by, *ties)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def slice_of(df: DataFrame, key: str, number: int, count: int) -> DataFrame:
    """The rows of one of ``count`` slices of the keys. All rows of a key, and those without one, are in the same slice."""
    return df if count == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(count)) == number)
