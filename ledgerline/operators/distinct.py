"""Exact distinct counts that can be added up: one bitmap of ids per group.

Ids get numbers without gaps, and a group is a set of rows (group, word, bitmap) of 32 768 ids each. Bitmaps of finer groups
are combined into those of coarser ones by a bitwise or, so that the facts are read once for all periods and cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


def numbered(ids: DataFrame, key: str, number: str = "number", buckets: int = BUCKETS) -> DataFrame:
    """Each different id of column ``key`` once, with a number from 0 on without gaps; null has none.

    Ids are numbered within hash buckets, and the buckets' sizes, one row each, are summed up before. The result depends
    on the ids alone.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")
    different = ids.select(key).where(F.col(key).isNotNull()).distinct().select(key, bucket)
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # over at most ``buckets`` rows
    sizes = different.groupBy("_bucket").agg(F.count("*").alias("_size"))
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    found = different.withColumn("_place", place).join(F.broadcast(starts), "_bucket")
    return found.select(key, (F.col("_start") + F.col("_place")).alias(number))


def presence(rows: DataFrame, number: str, by: Sequence[str | Column]) -> DataFrame:
    """Which numbers occur in each group: the columns ``by``, ``word`` and ``bitmap``. Rows without a number are left out."""
    at = F.col(number) + 1
    placed = rows.where(F.col(number).isNotNull()).withColumns(
        {"_word": F.bitmap_bucket_number(at), "_bit": F.bitmap_bit_position(at)}
    )
    return placed.groupBy(*by, F.col("_word").alias("word")).agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def merged(present: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The presence of coarser groups."""
    return present.groupBy(*by, "word").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(present: DataFrame, by: Sequence[str], count: str) -> DataFrame:
    """How many different ids each group has; groups may still be split over several rows of a word."""
    return merged(present, by).groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(count))


def shared(one: DataFrame, other: DataFrame, by: Sequence[str], count: str) -> DataFrame:
    """How many different ids a group has on both sides, each of which has one row per group and word. Groups without any
    have no row."""
    both = one.unionByName(other).groupBy(*by, "word").agg(F.count("*").alias("_sides"), F.bitmap_and_agg("bitmap").alias("bitmap"))
    alike = both.where(F.col("_sides") == 2).groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(count))
    return alike.where(F.col(count) > 0)
