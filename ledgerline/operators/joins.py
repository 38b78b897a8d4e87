"""Joins of a large, possibly skewed table to a table with one row per key."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 65_536
HEAVY_FACTOR = 4
ROWS_PER_SALT = 1_000_000


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame, the number it uses itself to choose broadcast joins."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _broadcast_limit(df: DataFrame) -> int:
    return size_in_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def size_in_bytes(text: str) -> int:
    """A size as Spark's settings write it: a number of bytes, or one with a unit such as ``64MB`` or ``10m``."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)i?b?\s*", text.lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    *,
    row_id: str,
    profile: DataFrame | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per ``key``.

    If the right side is estimated to be within Spark's broadcast limit the plain join is used: Spark checks the
    size again and broadcasts it, so no key can be hot. Otherwise the join is salted where it needs to be (see
    :func:`spread_join`). ``sized_by`` names a frame whose size stands for ``right`` where that is itself a join,
    for which the estimate is the product of both sides.
    """
    if planned_bytes(right if sized_by is None else sized_by) <= _broadcast_limit(right):
        return left.join(right, key, how)
    return spread_join(left, right, key, how, row_id=row_id, profile=profile)


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", **options) -> DataFrame:
    """Join that stays balanced when one key (or null) holds a large share of ``left``.

    ``right`` has at most one row per key. For the options see :func:`salted_sides`.
    """
    spread, copies = salted_sides(left, right, key, **options)
    return spread.join(copies, [key, "_salt"], how).drop("_salt")


def salted_sides(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    row_id: str,
    profile: DataFrame | None = None,
    buckets: int = BUCKETS,
    heavy_factor: int = HEAVY_FACTOR,
    rows_per_salt: int = ROWS_PER_SALT,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt`` column that splits the heavy keys of ``left``.

    A histogram counts the left rows per hash bucket of the key. It has at most ``buckets`` rows whatever the
    data size, so it can be broadcast. Buckets far above the mean are cut into salts by a hash of ``row_id``;
    right rows of those buckets are copied once per salt, all other rows keep salt 0. Each left row meets
    exactly one copy, so the result is that of the plain join. Salts depend on the data only, so recomputed
    tasks agree. ``profile`` may name a cheaper frame to count, e.g. the raw feed ``left`` was made from; it
    only steers the balance, never the result.
    """
    key_type = left.schema[key].dataType

    def bucket() -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast(key_type)), F.lit(buckets)).cast("int").alias("_bucket")

    counted = left if profile is None else profile
    histogram = counted.groupBy(bucket()).agg(F.count("*").alias("_rows"))
    # Every bucket's total against the mean; a window over at most `buckets` rows.
    mean = F.sum("_rows").over(Window.partitionBy()) / F.lit(float(buckets))
    allowed = F.greatest(mean * heavy_factor, F.lit(float(rows_per_salt)))
    heavy = (
        histogram.withColumn("_allowed", allowed)
        .where(F.col("_rows") > F.col("_allowed"))
        .select("_bucket", F.ceil(F.col("_rows") / F.col("_allowed")).cast("int").alias("_salts"))
    )
    salts = F.coalesce("_salts", F.lit(1))
    spread = (
        left.withColumn("_bucket", bucket())
        .join(F.broadcast(heavy), "_bucket", "left")
        .withColumn("_salt", F.pmod(F.xxhash64(row_id), salts).cast("int"))
        .drop("_bucket", "_salts")
    )
    copies = (
        right.withColumn("_bucket", bucket())
        .join(F.broadcast(heavy), "_bucket", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_bucket", "_salts")
    )
    return spread, copies


def orphan_rows(child: DataFrame, parent: DataFrame, key: str, nulls_are_orphans: bool) -> DataFrame:
    """One row: how many child rows have no parent.

    Children are counted per key before the join, so a key that all orphans share is one row by then.
    """
    counted = child.groupBy(key).agg(F.count("*").alias("_rows"))
    if not nulls_are_orphans:
        counted = counted.where(F.col(key).isNotNull())
    return counted.join(parent.select(key).distinct(), key, "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orphans")
    )
