"""Written shared tables and daily sums: the same answers, without reading the feeds or facts again."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import TESTDATA

from ledgerline.plans import analysis, catalog, metrics, rollups
from ledgerline.plans.reports import Slice, sliced
from ledgerline.settings import Settings

YEAR = Settings().but(spine_start=date(2023, 1, 1), spine_end=date(2024, 12, 31))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def shop(small):
    days = [date(2023, 3, 5), date(2024, 1, 10), date(2024, 3, 6), date(2024, 3, 6)]
    return small(
        YEAR,
        customers=[dict(customer_id="C1"), dict(customer_id="C2")],
        orders=[dict(order_id=f"O{i}", order_date=d, channel_id=1 + i % 2, customer_id="C1" if i < 3 else "C2") for i, d in enumerate(days)],
        order_items=[dict(order_id=f"O{i}", revenue=100.0 * (i + 1), cost=50.0) for i in range(4)],
        refunds=[dict(order_id="O3", refund_date=date(2024, 3, 6), amount=40.0)],
        advertising=[dict(date=date(2024, 3, 1), spend=30.0)],
        inventory=[
            dict(inventory_id=f"I{i}", date=date(2024, m, d), product_id=p, closing_qty=q, warehouse_id=w)
            for i, (m, d, p, q, w) in enumerate([(1, 1, "P1", 0, 1), (1, 9, "P1", 0, 1), (1, 9, "P2", 3, 2), (3, 1, "P2", 0, 1)])
        ],
    )


def test_metrics_of_rollups_are_those_of_facts(shop):
    for by in ((), ("month",), ("year",)):
        assert rows(metrics.evaluate(rollups.rolled(shop), metrics.MONTHLY, by)) == rows(metrics.evaluate(shop, metrics.MONTHLY, by))


def test_channels_and_running_totals(shop):
    rolled = rollups.rolled(shop)
    for found in (
        lambda w: metrics.evaluate(w, metrics.CHANNEL, ("month", "channel_id")),
        lambda w: metrics.evaluate(w, ("total_inventory_value", "out_of_stock_skus"), ("warehouse_id",)),
        metrics.to_date,
        metrics.margin_change,
    ):
        assert rows(found(rolled)) == rows(found(shop))


def test_nothing_to_sum(small):
    empty = small(YEAR)
    names = ("order_count", "net_revenue", "new_customers", "inventory_turnover")
    assert rows(metrics.evaluate(rollups.rolled(empty), names)) == rows(metrics.evaluate(empty, names))


def test_a_slice_of_written_tables_does_without_their_sums(shop):
    where = Slice(date_from=date(2024, 1, 1))
    want = rows(metrics.evaluate(sliced(shop, where), ("net_revenue", "order_count")))
    assert rows(metrics.evaluate(sliced(rollups.rolled(shop), where), ("net_revenue", "order_count"))) == want


def test_written_once_and_again_when_gone(shop, tmp_path, monkeypatch):
    folders = iter(str(tmp_path / str(i)) for i in range(9))
    monkeypatch.setattr(rollups, "shared_folder", lambda spark, purpose: next(folders))
    first = rollups.rolled(shop)
    assert rollups.rolled(shop) is first
    (tmp_path / "1").rename(tmp_path / "moved")
    again = rollups.rolled(shop)
    assert again is not first and again["daily_sums"].inputFiles()[0].startswith(f"file://{tmp_path}/2")


def test_daily_sums_and_days_of_stock_read_the_inventory_once(spark):
    tables = rollups.shared(catalog.open_warehouse(spark, TESTDATA)).copy()
    tables.replace("stock_days", spark.createDataFrame([], tables["stock_days"].schema))
    plan = tables["daily_sums"]._jdf.queryExecution().executedPlan().toString()
    assert "/lineitem.parquet" not in plan and "/orders.parquet" in plan


def test_order_items_are_written_for_those_that_ask(shop, tmp_path, monkeypatch):
    written = lambda: sorted(p.name for p in tmp_path.glob("*/*"))
    folders = iter(str(tmp_path / str(i)) for i in range(9))
    monkeypatch.setattr(rollups, "shared_folder", lambda spark, purpose: next(folders))
    want = rows(analysis.row_counts(shop))
    rollups.rolled(shop)
    assert written() == sorted(rollups.SHARED + rollups.ROLLED)
    assert rows(analysis.row_counts(rollups.itemised(shop))) == want
    # Only the items are added, and a missing table below them is noticed.
    assert written() == sorted(rollups.SHARED + rollups.ROLLED + rollups.ITEMS)
    (tmp_path / "0").rename(tmp_path.parent / f"{tmp_path.name}-moved")
    assert rows(analysis.row_counts(rollups.itemised(shop))) == want
    assert rollups.shared(shop) is rollups.itemised(shop)


@pytest.mark.parametrize("name", ["met_monthly", "met_catalog", "ti_to_date", "ti_compare_months", "rpt_revenue_trend", "rpt_finance_kpis"])
def test_metrics_read_no_feed(spark, name):
    plan = catalog.queries()[name](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert "daily_sums" in plan and TESTDATA not in plan


@pytest.mark.parametrize("name, most", [("fct_refunds", 3), ("mart_finance", 4), ("val_financial_integrity", 1), ("val_orphan_records", 1),
    ("an_refund_analysis", 4), ("an_payment_reconciliation", 4)])
def test_reads_of_the_orders_file(spark, name, most):
    """The orders file feeds orders, payments, refunds and payouts here; each of these is read once."""
    plan = catalog.queries()[name](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "/orders.parquet" in line for line in plan.splitlines()) <= most
