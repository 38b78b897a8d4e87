from __future__ import annotations

from datetime import date

import pytest
from conftest import by_key

from ledgerline.plans import metrics
from ledgerline.settings import Settings

YEAR = Settings().but(spine_start=date(2023, 1, 1), spine_end=date(2024, 12, 31))


@pytest.fixture
def shop(small):
    days = [date(2023, 3, 5), date(2024, 1, 10), date(2024, 1, 20), date(2024, 3, 5), date(2024, 3, 6)]
    return small(
        YEAR,
        customers=[dict(customer_id="C1"), dict(customer_id="C2")],
        orders=[
            dict(order_id=f"O{i}", order_date=d, customer_id="C1" if i < 4 else "C2") for i, d in enumerate(days)
        ] + [dict(order_id="X", order_status="cancelled", order_date=days[0], customer_id="C1")],
        order_items=[dict(order_id=f"O{i}", revenue=100.0 * (i + 1), cost=50.0) for i in range(5)]
        + [dict(order_id="X", revenue=999.0, cost=1.0)],
        refunds=[dict(order_id="O3", refund_date=date(2024, 3, 6), amount=40.0, status="pending")],
        advertising=[dict(date=date(2024, 3, 1), spend=30.0)],
        inventory=[dict(date=date(2024, 1, 1), inventory_value=100.0), dict(date=date(2024, 3, 1), inventory_value=300.0)],
    )


def test_totals(shop):
    row = metrics.evaluate(shop, metrics.MONTHLY).first()
    # The cancelled order is left out of gross revenue and of the order count, not of the cost.
    assert (row.gross_revenue, row.order_count, row.cogs) == (1500, 5, 251)
    assert (row.total_refunds, row.net_revenue, row.gross_profit) == (40, 1460, 1209)
    assert row.new_customers == 2 and row.total_customers == 2 and row.repeat_customers == 1
    assert row.cac == 15.0 and row.roas == pytest.approx(100 / 30)
    assert row.inventory_turnover == pytest.approx(251 / 200)
    assert row.aov == pytest.approx(292.0)


def test_months_are_compared_by_calendar_not_by_row(shop):
    rows = {r.month: r for r in metrics.compare_months(shop, ("net_revenue",)).collect()}
    march, january = rows[date(2024, 3, 1)], rows[date(2024, 1, 1)]
    assert march.value == 860.0
    assert march.pm is None and march.mom_pct is None  # February is missing
    assert march.py == 100.0 and march.yoy_pct == pytest.approx(7.6)
    assert january.pm is None


def test_blank_margin_counts_as_zero(shop):
    rows = {r.month: r for r in metrics.margin_change(shop).collect()}
    january = rows[date(2024, 1, 1)]
    assert january.mom_pp == january.gross_margin_pct


def test_running_totals_restart_with_their_period(shop):
    rows = {(r.date_id, r.horizon): r for r in metrics.to_date(shop, ("net_revenue", "gross_margin_pct")).collect()}

    def net(day, horizon):
        value = rows[(day, horizon)].net_revenue
        return None if value is None else float(value)

    assert net(date(2024, 1, 9), "mtd") is None
    assert net(date(2024, 1, 31), "mtd") == 500.0
    assert net(date(2024, 2, 10), "mtd") is None and net(date(2024, 2, 10), "qtd") == 500.0
    assert net(date(2024, 3, 6), "mtd") == 860.0
    assert net(date(2024, 3, 6), "qtd") == net(date(2024, 12, 31), "ytd") == 1360.0
    assert net(date(2024, 4, 1), "qtd") is None
    assert net(date(2024, 3, 6), "day") == 460.0
    assert rows[(date(2024, 1, 31), "mtd")].gross_margin_pct == pytest.approx(400 / 500)


def test_stock_months_add_up_over_the_year(shop):
    rows = {(r.date_id, r.horizon): r for r in metrics.to_date(shop, ("inventory_turnover",)).collect()}
    assert rows[(date(2024, 12, 31), "ytd")].inventory_turnover == pytest.approx(200 / 200)


def test_refunds_by_channel_are_those_of_the_orders(shop):
    row = metrics.evaluate(shop, ("total_refunds", "net_revenue"), ("channel_id",)).first()
    assert row.total_refunds == 0 and row.net_revenue == 1500  # the only refund is pending


def test_unknown_dimensions_are_refused(shop):
    with pytest.raises(ValueError):
        metrics.evaluate(shop, ("net_revenue",), ("channel_id", "carrier"))


def test_catalog(shop):
    assert len(metrics.CATALOG) == 13
    assert metrics.describe("gross_revenue").formula and metrics.describe("nothing") is None
    rows = by_key(metrics.catalog_values(shop), "name")
    assert rows["order_count"].value == 5.0 and rows["ltv"].display_name == "Customer LTV"
