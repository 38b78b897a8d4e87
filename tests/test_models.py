"""Boundaries and traps of the models on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import by_key

from ledgerline.settings import Settings


def test_newest_row_wins_and_null_keys_go(small):
    orders = small(
        orders=[
            dict(order_id="O1", order_status="Completed", _ingested_at=datetime(2024, 1, 1)),
            dict(order_id="O1", order_status="SHIPPED", _ingested_at=datetime(2024, 1, 2)),
            dict(order_id=None),
            dict(order_id="O2", order_status="weird"),
            dict(order_id="O3", order_status=None),
            dict(order_id="O4", total_amount=-1.0),
        ]
    )["stg_orders"]
    rows = by_key(orders, "order_id")
    assert {k: r.order_status for k, r in rows.items()} == {"O1": "shipped", "O2": "unknown", "O3": "unknown"}


def test_ties_are_broken_the_same_way_for_any_partitioning(small):
    rows = [dict(order_id="O1", total_amount=float(i), order_date=date(2024, 1, 1 + i % 3)) for i in range(20)]
    picked = set()
    for parts in (1, 3, 7):
        wh = small(orders=rows)
        wh.replace("raw_orders", wh["raw_orders"].repartition(parts))
        picked.add(tuple(wh["stg_orders"].collect()))
    assert len(picked) == 1


def test_customer_whose_newest_row_has_no_email_is_dropped(small):
    wh = small(
        customers=[
            dict(customer_id="C1", email="old@x.y", _ingested_at=datetime(2024, 1, 1)),
            dict(customer_id="C1", email=None, _ingested_at=datetime(2024, 1, 2)),
            dict(customer_id="C2", email=" Ann@X.Y ", first_name=" Ann ", country=" us "),
        ]
    )
    row, = wh["stg_customers"].collect()
    assert (row.customer_id, row.email, row.first_name, row.country) == ("C2", "ann@x.y", "Ann", "US")


def test_products_need_a_sku_and_a_margin(small):
    wh = small(
        products=[
            dict(product_id="P1"),
            dict(product_id="P2", sku=None),
            dict(product_id="P3", unit_cost=10.0),
            dict(product_id="P4", unit_cost=0.0),
            dict(product_id="P5", list_price=None),
        ]
    )
    assert [r.product_id for r in wh["stg_products"].collect()] == ["P1"]


def test_orphan_and_empty_items_are_removed(small):
    wh = small(
        orders=[dict(order_id="O1")],
        order_items=[dict(order_id="O1"), dict(order_id="nope"), dict(order_id="O1", quantity=0), dict(unit_price=0.0)],
    )
    assert [r.order_item_id for r in wh["stg_order_items"].collect()] == ["O1"]


def test_negative_stock_is_clamped_but_its_value_is_kept(small):
    rows = by_key(
        small(
            inventory=[
                dict(inventory_id="a", closing_qty=-3, inventory_value=-12.0),
                dict(inventory_id="b", closing_qty=None),
                dict(inventory_id="c", closing_qty=9),
                dict(inventory_id="d", closing_qty=10, sold_qty=0),
                dict(inventory_id="e", closing_qty=7, sold_qty=7),
            ]
        )["fct_inventory"],
        "inventory_id",
    )
    assert [(rows[k].closing_qty, rows[k].stock_status) for k in "abcd"] == [
        (0, "out_of_stock"), (0, "out_of_stock"), (9, "low_stock"), (10, "in_stock"),
    ]
    assert rows["a"].inventory_value == Decimal("-12.00")
    assert rows["d"].days_of_supply is None
    assert rows["e"].days_of_supply == pytest.approx(30.0)


def test_on_time_needs_a_delivery(small):
    rows = by_key(
        small(
            shipments=[
                dict(shipment_id="a"),
                dict(shipment_id="b", delivered_date=date(2024, 3, 16), shipment_status="misplaced"),
                dict(shipment_id="c", delivered_date=None),
            ]
        )["fct_shipments"],
        "shipment_id",
    )
    assert [rows[k].is_on_time for k in "abc"] == [True, False, False]
    assert [rows[k].days_late for k in "abc"] == [-1, 1, None]
    assert rows["b"].shipment_status == "unknown"


def test_discount_is_taken_off_twice_and_only_completed_refunds_count(small):
    wh = small(
        orders=[dict(order_id="O1"), dict(order_id="O2")],
        order_items=[dict(order_id="O1", revenue=90.0, discount=10.0, cost=40.0) for _ in range(2)],
        refunds=[dict(order_id="O1", amount=5.0), dict(order_id="O1", amount=7.0), dict(order_id="O1", status="pending")],
    )
    rows = by_key(wh["fct_orders"], "order_id")
    first = rows["O1"]
    assert (first.gross_revenue, first.net_revenue, first.gross_profit) == (180, 180 - 20 - 12, 180 - 20 - 12 - 80)
    assert first.has_refund and first.has_multiple_refunds and first.refund_count == 2
    assert (rows["O2"].net_revenue, rows["O2"].item_count, rows["O2"].gross_margin_pct) == (0, 0, None)


@pytest.mark.parametrize(
    "paid, status", [(100.0, "MATCHED"), (99.0, "MATCHED"), (98.99, "WARNING"), (0.01, "WARNING"), (200.01, "EXCEPTION")]
)
def test_reconciliation_bands(small, paid, status):
    wh = small(orders=[dict(order_id="O1")], payments=[dict(order_id="O1", amount=paid)])
    assert wh["int_payment_reconciliation"].first().reconciliation_status == status


def test_exact_hundred_is_a_warning(small):
    wh = small(orders=[dict(order_id="O1", total_amount=150.0)], payments=[dict(order_id="O1", amount=50.0)])
    assert wh["int_payment_reconciliation"].first().reconciliation_status == "WARNING"


def test_payment_of_no_order_is_unknown(small):
    wh = small(
        orders=[dict(order_id="O1")],
        payments=[dict(payment_id="a", order_id="ghost"), dict(payment_id="b"), dict(payment_id="c", status="failed")],
    )
    rows = by_key(wh["fct_payments"], "payment_id")
    assert (rows["a"].reconciliation_status, rows["a"].payment_variance) == ("UNKNOWN", 0)
    assert rows["b"].is_duplicate and rows["b"].reconciliation_status == "MATCHED"


def test_over_refund_compares_one_refund_with_what_was_paid(small):
    wh = small(
        orders=[dict(order_id="O1")],
        payments=[dict(order_id="O1", amount=60.0), dict(order_id="O9", amount=10.0)],
        refunds=[dict(refund_id="a", amount=60.0), dict(refund_id="b", amount=60.01), dict(refund_id="c", order_id="O9")],
    )
    rows = by_key(wh["fct_refunds"], "refund_id")
    assert [rows[k].is_over_refund for k in "abc"] == [False, True, False]
    # The order does not exist, its payments do.
    assert rows["c"].customer_id is None and rows["c"].order_paid_amount == 10


def test_value_tiers_and_customers_without_orders(small):
    wh = small(
        customers=[dict(customer_id=c) for c in ("C1", "C2", "C3", "C4")],
        orders=[dict(order_id=f"O{i}", customer_id=f"C{i}", order_date=date(2024, 9, 30)) for i in (1, 2, 3)],
        order_items=[
            dict(order_id="O1", revenue=1000.0), dict(order_id="O2", revenue=300.0), dict(order_id="O3", revenue=299.99),
        ],
    )
    rows = by_key(wh["mart_customer"], "customer_id")
    assert [rows[c].value_tier for c in ("C1", "C2", "C3", "C4")] == ["High", "Medium", "Low", "Low"]
    assert (rows["C1"].recency_status, rows["C1"].days_since_last_order) == ("Lapsing", 92)
    assert (rows["C4"].recency_status, rows["C4"].days_since_last_order) == ("Churned", None)
    assert (rows["C4"].order_count, rows["C4"].avg_order_value, rows["C4"].is_repeat_customer) == (0, 0.0, False)


def test_cancelled_orders_are_no_sales(small):
    wh = small(
        customers=[dict(customer_id="C1")],
        orders=[dict(order_id="O1"), dict(order_id="O2", order_status="cancelled"), dict(order_id="O3", order_status="?")],
    )
    assert wh["int_customer_orders"].first().order_count == 1
    assert wh["mart_sales"].first().order_count == 1


def test_payout_variance_as_defined(small):
    wh = small(
        orders=[dict(order_id="O1")],
        order_items=[dict(order_id="O1", revenue=100.0)],
        refunds=[dict(order_id="O1", amount=10.0)],
        payouts=[dict(payout_id="a"), dict(payout_id="b", period_start=date(2023, 1, 1))],
    )
    rows = by_key(wh["fct_payouts"], "payout_id")
    # Net revenue is 90; refunds come off a second time.
    assert rows["a"].payout_variance == 97 - (90 - 3 - 10)
    assert rows["a"].reconciliation_status == "WARNING"
    assert rows["b"].payout_variance == 97 - (0 - 3 - 0)


def test_cost_per_new_customer_matches_channels_by_lower_case(small):
    wh = small(
        customers=[dict(customer_id="C1"), dict(customer_id="C2")],
        orders=[dict(order_id="O1", customer_id="C1"), dict(order_id="O2", customer_id="C2")],
        advertising=[dict(), dict(channel="other", campaign_id=2)],
    )
    rows = {r.campaign_id: r.approx_cac for r in wh["mart_marketing"].collect()}
    assert rows == {1: 25.0, 2: None}


def test_latest_snapshot_per_site(small):
    wh = small(
        products=[dict(product_id="P1")],
        inventory=[
            dict(inventory_id="a", date=date(2024, 1, 1), closing_qty=50),
            dict(inventory_id="b", date=date(2024, 2, 1), closing_qty=0),
            dict(inventory_id="c", date=date(2024, 1, 1), warehouse_id=2, closing_qty=5),
        ],
    )
    rows = {r.warehouse_code: (r.available_qty, r.stock_status) for r in wh["mart_inventory"].collect()}
    assert rows == {"WH-EAST": (0, "out_of_stock"), "WH-WEST": (5, "low_stock")}


def test_calendar(small):
    dates = small()["dim_date"]
    assert dates.count() == 731
    row = dates.where("date_id = date '2024-12-29'").first()  # a Sunday
    assert (row.day_of_week, row.is_weekend, row.week_of_year, row.quarter_label) == (0, True, 52, "Q4")
    assert (row.month_name, row.month_abbr, row.day_name) == ("December", "Dec", "Sunday")
    fiscal = small(Settings().but(fiscal_year_start_month=7))["dim_date"]
    row = fiscal.where("date_id = date '2024-07-01'").first()
    assert (row.fiscal_year, row.fiscal_quarter) == (2025, 1)


def test_written_layers_give_the_same_mart(small, tmp_path):
    rows = dict(orders=[dict(order_id="O1"), dict(order_id="O2")], order_items=[dict(order_id="O1")])
    lazily = small(**rows)["mart_sales"].collect()
    written = small(**rows)
    paths = written.materialise(("stg_orders", "int_order_revenue", "mart_sales"), str(tmp_path))
    assert written["mart_sales"].collect() == lazily
    assert set(paths) == {"stg_orders", "int_order_revenue", "mart_sales"}


def test_bucketed_tables_are_joined_without_a_shuffle(spark, small, tmp_path):
    wh = small(
        orders=[dict(order_id=f"O{i}") for i in range(20)],
        order_items=[dict(order_id=f"O{i % 25}", revenue=float(i)) for i in range(60)],
        refunds=[dict(order_id="O3")],
    )
    lazily = sorted(wh["int_order_revenue"].collect())
    names = ("stg_orders", "clean_order_items", "completed_refunds")
    wh.save_tables(names, "layer_test", str(tmp_path), {n: ("order_id", 4) for n in names})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = wh["int_order_revenue"]._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
        assert sorted(wh["int_order_revenue"].collect()) == lazily
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("drop database layer_test cascade")
