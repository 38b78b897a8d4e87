from __future__ import annotations

import json
from datetime import date

import pytest
from conftest import TESTDATA, by_key
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.plans import catalog, quality


@pytest.fixture(scope="module")
def table(spark):
    return quality.run(catalog.open_warehouse(spark, TESTDATA)).collect()


def test_all_checks_answer(table):
    assert [r.check_id for r in sorted(table, key=lambda r: r.position)] == [c.check_id for c in quality.CHECKS]
    assert not [r.check_id for r in table if r.status == "ERROR"]
    assert all(0 <= r.pass_rate <= 1 for r in table)


def test_known_outcomes(table):
    rows = {r.check_id: r for r in table}
    assert rows["uniq_001"].status == "PASS" and rows["ref_001"].status == "PASS"
    assert rows["ref_002"].status == "WARN" and rows["fin_001"].status == "WARN"
    assert rows["fin_002"].status == "FAIL"
    # An INFO check that finds something fails too.
    assert (rows["comp_003"].severity, rows["comp_003"].status) == ("INFO", "FAIL")
    assert rows["uniq_001"].message == "0 duplicate order_ids detected"


def test_empty_tables_are_skipped_and_do_not_block(small):
    table = quality.run(small())
    assert {r.status for r in table.collect()} == {"SKIPPED"}
    assert quality.gate(table).first().blocked is False
    quality.enforce(table)


def test_a_failing_check_is_an_error_and_the_others_go_on(small):
    wh = small(orders=[dict(order_id="O1")])
    wh.replace("stg_products", wh["stg_products"].drop("sku"))
    rows = by_key(quality.run(wh), "check_id")
    assert rows["uniq_004"].status == rows["comp_002"].status == "ERROR"
    assert rows["comp_002"].message.startswith("Check raised exception: ")
    assert rows["uniq_001"].status == "PASS"
    assert quality.gate(quality.run(wh)).first().blocked  # uniq_004 is critical


def test_errors_at_run_time_are_contained(small):
    wh = small(orders=[dict(order_id="O1")], customers=[dict(customer_id="C1")])
    broken = wh["stg_customers"].selectExpr("raise_error('gone') as email", "customer_id")
    wh.replace("stg_customers", broken)
    rows = by_key(quality.run(wh), "check_id")
    assert rows["comp_001"].status == "ERROR"
    assert rows["uniq_001"].status == "PASS"


def test_gate_raises_on_critical_findings(small):
    wh = small(
        orders=[dict(order_id="O1")],
        payments=[dict(payment_id="a"), dict(payment_id="b")],
        refunds=[dict(amount=500.0)],
    )
    table = quality.run(wh)
    rows = by_key(table, "check_id")
    assert rows["fin_005"].records_failed == 1 and rows["fin_002"].records_failed == 1
    with pytest.raises(quality.QualityGateError):
        quality.enforce(table)


def test_null_keys_are_no_orphans_and_ghosts_are_counted_by_row(small):
    wh = small(
        orders=[dict(order_id="O1")],
        payments=[dict(payment_id=str(i), order_id=o) for i, o in enumerate(["O1", None, "ghost", "ghost", "ghost"])],
    )
    rows = by_key(quality.run(wh), "check_id")
    assert (rows["ref_002"].records_checked, rows["ref_002"].records_failed) == (5, 3)
    # One order with repeated payments, however many rows it has.
    assert rows["fin_005"].records_failed == 1


def test_low_volume_days(small):
    days = [(1, 10), (2, 10), (3, 7)]
    orders = [dict(order_id=f"{d}-{i}", order_date=date(2024, 1, d)) for d, n in days for i in range(n)]
    row = by_key(quality.run(small(orders=orders)), "check_id")["comp_004"]
    assert (row.records_checked, row.records_failed) == (3, 0)  # 7 is not below 0.7 x 9
    row = by_key(quality.run(small(orders=orders[:-1])), "check_id")["comp_004"]
    assert row.records_failed == 1
    assert row.message == "1 days >30% below average daily orders (9)"


def test_written_shared_tables_give_the_same_result(spark, table, tmp_path):
    again = quality.run(catalog.open_warehouse(spark, TESTDATA).copy(), folder=str(tmp_path)).collect()
    assert sorted(again) == sorted(table)


def test_report_is_flat_json_with_all_checks(small, tmp_path):
    made = quality.report(quality.run(small(orders=[dict(order_id="O1")])), "20240501T000000Z")
    made.coalesce(1).write.json(str(tmp_path / "report"))
    part, = (tmp_path / "report").glob("part-*.json")
    report = json.loads(part.read_text())
    assert report["run_at"] == "20240501T000000Z" and report["total_checks"] == 18
    assert [c["check_id"] for c in report["checks"]] == [c.check_id for c in quality.CHECKS]


def test_schema_tests(small):
    wh = small(customers=[dict(email=None)], products=[dict(product_id="P"), dict(product_id="P")])
    rows = by_key(quality.not_null_tests(wh), "test_name")
    assert len(rows) == 18
    assert rows["not_null_raw_customers_email"].status == "warn"
    assert quality.unique_tests(wh).first().status == "fail"


def test_items_written_slice_by_slice_give_the_same_result(spark, table, tmp_path, monkeypatch):
    """Large order items: their checks run after the others, on written items."""
    monkeypatch.setattr(session, "FILE_BYTES_PER_SLICE", 50_000)
    monkeypatch.setattr(quality, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    plans = []
    counted = quality._counted

    def noted(warehouse, profile, *rest):
        plans.append((warehouse, profile))
        return counted(warehouse, profile, *rest)

    monkeypatch.setattr(quality, "_counted", noted)
    warehouse = catalog.open_warehouse(spark, TESTDATA).copy()
    assert sorted(quality.run(warehouse).collect()) == sorted(table)
    assert [profile for _, profile in plans[-2:]] == list(quality.ITEM_PROFILES)
    written, = {made for made, _ in plans[-2:]}
    assert written is not warehouse and {made for made, _ in plans[:-2]} == {warehouse}
    items = spark.read.parquet(str(tmp_path / "checked-items" / "clean_order_items"))
    assert items.count() == items.select("order_item_id").distinct().count() == warehouse["clean_order_items"].count()
    assert len({p.name.split("-")[2] for p in (tmp_path / "checked-items").rglob("part-*.parquet")}) > 1


def test_items_that_cannot_be_read_are_errors_of_their_checks_only(small, monkeypatch):
    wh = small(orders=[dict(order_id="O1")], order_items=[dict(order_id="O1")])
    gone = F.raise_error(F.lit("items are gone")).cast("string")
    wh.replace("raw_order_items", wh["raw_order_items"].withColumn("order_id", F.coalesce(gone, "order_id")))
    monkeypatch.setattr(quality, "slices", lambda feed: 2)
    rows = by_key(quality.run(wh), "check_id")
    assert rows["ref_001"].status == "ERROR"
    assert rows["uniq_001"].status == "PASS"
