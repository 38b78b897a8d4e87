"""The salted lookup gives what a plain join gives, with one key holding most rows."""

from __future__ import annotations

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from ledgerline.operators import joins
from ledgerline.plans import catalog
from ledgerline.plans.warehouse import Warehouse
from ledgerline.sources.fixtures import FixtureSource


@pytest.fixture(scope="module")
def skewed(spark):
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))  # a third of the rows
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
        .cast("long")
    )
    left = spark.range(6000).select(F.col("id").alias("row"), key.alias("k"))
    right = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return left, right


def _spread(left, right, how, **more):
    return joins.spread_join(
        left, right, "k", how, row_id="row", buckets=64, heavy_factor=2, rows_per_salt=50, **more
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(skewed, how):
    left, right = skewed
    plain = left.join(right, "k", how)
    spread = _spread(left, right, how).select(*plain.columns)
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_other_key_type_and_rough_profile(skewed):
    left, right = skewed
    right = right.withColumn("k", F.col("k").cast("int"))
    profile = left.where("row < 3000").select("k")
    spread = _spread(left, right, "left", profile=profile)
    assert spread.count() == left.count()
    assert spread.agg(F.sum("v")).first()[0] == left.join(right, "k", "left").agg(F.sum("v")).first()[0]


def test_hot_key_is_cut_into_many_salts(skewed):
    left, right = skewed
    spread, copies = joins.salted_sides(
        left, right, "k", row_id="row", buckets=64, heavy_factor=2, rows_per_salt=50
    )
    largest = spread.groupBy("k", "_salt").count().agg(F.max("count")).first()[0]
    salts = spread.where("k = 7").select("_salt").distinct().count()
    assert salts > 5
    assert largest < 2000 / 3  # the hot key holds 2000 rows
    # Only keys that share a bucket with a hot one are copied.
    assert copies.where("k = 7").count() >= salts
    assert copies.count() < right.count() * 2


def test_lookup_is_plain_only_while_the_right_side_is_small(spark, skewed):
    left, right = skewed
    plain = joins.lookup(left, right, "k", "left", row_id="row")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = joins.lookup(left, right, "k", "left", row_id="row")
        assert "_salt" in spread._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "_salt" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_orphans_are_counted_per_key_first(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "k long")
    assert joins.orphan_rows(child, parent, "k", nulls_are_orphans=False).first().orphans == 3
    assert joins.orphan_rows(child, parent, "k", nulls_are_orphans=True).first().orphans == 4


@pytest.mark.parametrize("name", ["stg_order_items", "fct_order_items", "fct_payments", "fct_refunds"])
def test_models_are_the_same_with_every_lookup_salted(spark, monkeypatch, name):
    source = FixtureSource(spark, TESTDATA)
    plain = Warehouse(spark, source, catalog.TEST_SETTINGS)[name]
    want = sorted(map(str, plain.collect()))
    monkeypatch.setitem(joins.salted_sides.__kwdefaults__, "rows_per_salt", 5)
    monkeypatch.setitem(joins.salted_sides.__kwdefaults__, "buckets", 64)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = Warehouse(spark, source, catalog.TEST_SETTINGS)[name]
        assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, salted.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("text, size", [("10485760", 10485760), ("64MB", 64 << 20), ("10m", 10 << 20), ("1 g", 1 << 30), ("-1", -1), ("5KiB", 5 << 10)])
def test_sizes_are_read_as_spark_writes_them(text, size):
    assert joins.size_in_bytes(text) == size
