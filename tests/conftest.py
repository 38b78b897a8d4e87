from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerline.plans.warehouse import Warehouse  # noqa: E402
from ledgerline.session import local_session  # noqa: E402
from ledgerline.settings import Settings  # noqa: E402
from ledgerline.sources.schemas import RAW_SCHEMAS  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


DEFAULTS = {
    "customers": dict(first_name="Ann", last_name="Lee", email="a@b.c", signup_date=date(2023, 1, 5), country="us",
                      state="ny", city="New York", customer_segment="retail", acquisition_channel="email"),
    "products": dict(sku="S", product_name="Cup", category="Home", subcategory="Kitchen", brand="B", unit_cost=4.0,
                     list_price=10.0, supplier="X"),
    "orders": dict(customer_id="C1", order_date=date(2024, 3, 10), channel_id=4, channel="email",
                   order_status="completed", subtotal=100.0, discount=0.0, tax=0.0, shipping=0.0, total_amount=100.0),
    "order_items": dict(order_id="O1", product_id="P1", quantity=1, unit_price=10.0, discount=0.0, cost=4.0,
                        revenue=10.0, gross_profit=6.0),
    "payments": dict(order_id="O1", payment_date=date(2024, 3, 10), payment_method="card", amount=100.0,
                     status="completed"),
    "refunds": dict(order_id="O1", refund_date=date(2024, 3, 20), amount=5.0, reason="damaged", status="completed"),
    "shipments": dict(order_id="O1", warehouse_id=1, warehouse="WH-EAST", carrier="UPS", shipped_date=date(2024, 3, 11),
                      estimated_delivery_date=date(2024, 3, 15), delivered_date=date(2024, 3, 14),
                      shipment_status="delivered"),
    "inventory": dict(date=date(2024, 3, 1), product_id="P1", warehouse_id=1, warehouse="WH-EAST", opening_qty=10,
                      received_qty=0, sold_qty=1, adjustment_qty=0, closing_qty=9, unit_cost=4.0, inventory_value=36.0),
    "advertising": dict(date=date(2024, 3, 2), campaign_id=1, campaign_name="Spring", channel_id=4, channel="Email",
                        impressions=100, clicks=10, conversions=2, spend=50.0, attributed_revenue=100.0),
    "payouts": dict(payout_date=date(2024, 4, 5), platform="direct", period_start=date(2024, 3, 1),
                    period_end=date(2024, 3, 31), gross_sales=100.0, fees=3.0, refunds=0.0, adjustments=0.0,
                    net_payout=97.0),
}
KEYS = {
    "customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "order_item_id",
    "payments": "payment_id", "refunds": "refund_id", "shipments": "shipment_id", "inventory": "inventory_id",
    "advertising": "ad_record_id", "payouts": "payout_id",
}


class SmallSource:
    """Raw feeds made of a few dictionaries; missing fields take default values. Keys are strings here."""

    def __init__(self, spark, **rows):
        self.spark, self.rows = spark, rows

    def raw(self, entity: str):
        name = "advertising" if entity == "ad_spend" else entity
        schema = RAW_SCHEMAS[name] + ", _ingested_at timestamp, _source string, _batch_id string"
        columns = [part.split()[0] for part in schema.split(", ")]
        made = []
        for i, row in enumerate(self.rows.get(name, [])):
            full = {**DEFAULTS[name], KEYS[name]: f"{name[0].upper()}{i + 1}", "_ingested_at": datetime(2024, 5, 1),
                    "_source": "test", "_batch_id": "b1", **row}
            made.append(tuple(full[c] for c in columns))
        return self.spark.createDataFrame(made, schema)


@pytest.fixture
def small(spark):
    def make(settings: Settings | None = None, **rows) -> Warehouse:
        return Warehouse(spark, SmallSource(spark, **rows), settings)

    return make


def by_key(df, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
