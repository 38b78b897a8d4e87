from __future__ import annotations

import hashlib

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from ledgerline.operators import defects
from ledgerline.plans import jobs
from ledgerline.plans.warehouse import Warehouse
from ledgerline.sources.fixtures import FixtureSource


@pytest.fixture(scope="module")
def clean(spark):
    return FixtureSource(spark, TESTDATA).clean()


def test_draw_depends_on_the_key_only(spark):
    df = spark.range(1000).withColumn("d", defects.draw(F.col("id"), "null_product_sku"))
    want = {i: int(hashlib.md5(f"{i}|null_product_sku|42".encode()).hexdigest()[:8], 16) for i in range(1000)}
    assert {r.id: r.d for r in df.repartition(7).collect()} == want


def test_all_defects_show_up_at_about_their_rate(clean):
    share = 0.4  # few rows in the test set, so more defects than usual
    picked = clean["orders"].where(defects.picked(F.col("order_id"), "duplicate_orders", share)).count()
    assert picked / clean["orders"].count() == pytest.approx(0.2, abs=0.05)
    report = {r.defect_type: r for r in defects.defect_report(clean).collect()}
    assert set(report) == set(defects.RATES)


def test_report_agrees_with_the_data(clean):
    made = defects.inject(clean)
    report = {r.defect_type: r.affected for r in defects.defect_report(clean).collect()}
    count = {
        "duplicate_orders": made["orders"].count() - clean["orders"].count(),
        "orphan_order_items": made["order_items"].where(F.col("order_id") == defects.NO_ORDER_ITEM).count(),
        "orphan_payments": made["payments"].dropDuplicates().where(F.col("order_id") == defects.NO_ORDER_PAYMENT).count(),
        "duplicate_payments": made["payments"].count() - clean["payments"].count(),
    }
    assert count == {k: report[k] for k in count}
    changed = made["refunds"].alias("m").join(clean["refunds"].alias("c"), "refund_id").where("m.amount > c.amount")
    assert changed.count() == report["refund_exceeds_payment"]
    assert changed.selectExpr("round(m.amount / c.amount, 2) as f").distinct().count() <= 2  # one factor, up to cents


def test_untouched_columns_keep_their_types(clean):
    made = defects.inject(clean)
    for name in ("refunds", "customers", "products", "inventory", "shipments"):
        assert made[name].schema == clean[name].schema or [f.dataType for f in made[name].schema] == [
            f.dataType for f in clean[name].schema
        ]


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_numbers_at_any_partitioning(clean, partitions):
    """As many rows as wanted get each defect, and they are the same ones however the rows lie."""
    dealt = {n: f.dropDuplicates([defects.KEYS[n]]).repartition(partitions) for n, f in clean.items()}
    picks = defects.exact_picks(dealt, 0.02)
    found = {r.defect_type: r for r in defects.affected(dealt, picks).collect()}
    assert set(found) == set(defects.RATES)
    for name, row in found.items():
        assert row.affected == row.wanted >= 1, name
    made = defects.inject(dealt, picks)
    orders = dealt["orders"].count()
    assert made["orders"].count() == orders + defects.wanted(orders, "duplicate_orders")
    assert made["customers"].where("email is null").count() - dealt["customers"].where("email is null").count() <= found["null_customer_email"].wanted
    keys = sorted(r.order_id for r in dealt["orders"].where(picks["duplicate_orders"]).collect())
    every = dealt["orders"].select("order_id", defects.draw(F.col("order_id"), "duplicate_orders").alias("d")).collect()
    least = sorted(every, key=lambda r: (r.d, str(r.order_id)))[: len(keys)]
    assert keys == sorted(r.order_id for r in least)


def test_exact_numbers_of_equal_draws(spark, monkeypatch):
    """Where all draws are alike the keys decide; more than there are means all; null keys are never picked."""
    monkeypatch.setattr(defects, "draw", lambda key, name, seed=0: F.lit(70_000).cast("long") + F.length(key.cast("string")) * 0)
    rows = spark.createDataFrame([(f"{i:03d}",) for i in range(20)] + [(None,)], "product_id string")
    for number, want in ((0, 0), (1, 1), (7, 7), (20, 20), (500, 20)):
        pick = defects.least_draws(rows, "null_product_sku", number)
        found = sorted(r.product_id for r in rows.where(pick).collect())
        assert found == [f"{i:03d}" for i in range(want)]


def test_draws_are_counted_once_with_the_rows_without_a_key(spark):
    rows = spark.createDataFrame([(f"{i:03d}",) for i in range(500)] + [(None,)] * 3, "product_id string")
    sizes = defects.draw_sizes(rows, "null_product_sku")
    assert sizes[None] == 3 and sum(sizes.values()) == 503
    again = defects.least_draws(rows, "null_product_sku", 40)
    known = defects.least_draws(rows, "null_product_sku", 40, sizes=sizes)
    assert rows.where(again).count() == 40 == rows.where(again & known).count()


def test_keys_worked_out_from_all_lines_are_counted_from_files(spark):
    warehouse = Warehouse(spark, FixtureSource(spark, TESTDATA))
    clean, counted, picks = jobs._exact(warehouse)
    for name in ("order_items", "inventory"):
        plan = counted[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
        assert sorted(counted[name].collect()) == sorted(clean[name].select(*counted[name].columns).collect())
