"""Declared schemas of the raw entities and the event feed, as the DDL text that readers accept."""

from __future__ import annotations

# Columns and types of the entities as the connectors deliver them.
RAW_SCHEMAS = {
    "customers": "customer_id string, first_name string, last_name string, email string, signup_date date, "
    "country string, state string, city string, customer_segment string, acquisition_channel string",
    "products": "product_id string, sku string, product_name string, category string, subcategory string, "
    "brand string, unit_cost double, list_price double, supplier string",
    "orders": "order_id string, customer_id string, order_date date, channel_id int, channel string, "
    "order_status string, subtotal double, discount double, tax double, shipping double, total_amount double",
    "order_items": "order_item_id string, order_id string, product_id string, quantity int, unit_price double, "
    "discount double, cost double, revenue double, gross_profit double",
    "payments": "payment_id string, order_id string, payment_date date, payment_method string, amount double, "
    "status string",
    "refunds": "refund_id string, order_id string, refund_date date, amount double, reason string, status string",
    "shipments": "shipment_id string, order_id string, warehouse_id int, warehouse string, carrier string, "
    "shipped_date date, estimated_delivery_date date, delivered_date date, shipment_status string",
    "inventory": "inventory_id string, date date, product_id string, warehouse_id int, warehouse string, "
    "opening_qty int, received_qty int, sold_qty int, adjustment_qty int, closing_qty int, unit_cost double, "
    "inventory_value double",
    "advertising": "ad_record_id string, date date, campaign_id int, campaign_name string, channel_id int, "
    "channel string, impressions int, clicks int, conversions int, spend double, attributed_revenue double",
    "payouts": "payout_id string, payout_date date, platform string, period_start date, period_end date, "
    "gross_sales double, fees double, refunds double, adjustments double, net_payout double",
}

# The test tables the feeds are derived from.
ORDERS_FILE = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string"
)
EVENTS_FILE = (
    "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
)
