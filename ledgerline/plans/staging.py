"""Staging models: typed, cleaned, one row per key where the feed may repeat itself.

Parameter names are the upstream tables; see :mod:`ledgerline.plans.warehouse`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import money, one_of, ratio
from ledgerline.operators.dedup import latest_by
from ledgerline.operators.joins import lookup

# Accepted states.
ORDER_STATES = ("completed", "processing", "shipped", "refunded", "cancelled")
PAYMENT_STATES = ("completed", "failed", "pending", "refunded")
REFUND_STATES = ("completed", "pending", "failed")
SHIPMENT_STATES = ("delivered", "delivered_late", "in_transit", "lost", "returned")

AUDIT = ("_ingested_at", "_source", "_batch_id")


def _moneys(*names: str):
    return [money(n).alias(n) for n in names]


def _ints(*names: str):
    return [F.col(n).cast("int").alias(n) for n in names]


def _dates(*names: str):
    return [F.col(n).cast("date").alias(n) for n in names]


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    # A customer whose newest row has no email is dropped, even if an older row had one.
    return (
        latest_by(raw_customers, "customer_id")
        .where(F.col("email").isNotNull())
        .select(
            "customer_id",
            F.trim("first_name").alias("first_name"),
            F.trim("last_name").alias("last_name"),
            F.lower(F.trim("email")).alias("email"),
            *_dates("signup_date"),
            F.upper(F.trim("country")).alias("country"),
            F.upper(F.trim("state")).alias("state"),
            F.trim("city").alias("city"),
            "customer_segment",
            "acquisition_channel",
            *AUDIT,
        )
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    return (
        raw_products.na.drop(subset=["product_id", "sku"])
        .where((F.col("list_price") > 0) & (F.col("unit_cost") > 0) & (F.col("unit_cost") < F.col("list_price")))
        .select(
            "product_id",
            "sku",
            F.trim("product_name").alias("product_name"),
            "category",
            "subcategory",
            "brand",
            *_moneys("unit_cost", "list_price"),
            "supplier",
            *AUDIT,
        )
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return (
        latest_by(raw_orders, "order_id")
        .where(F.col("total_amount") >= 0)
        .select(
            "order_id",
            "customer_id",
            *_dates("order_date"),
            *_ints("channel_id"),
            "channel",
            one_of("order_status", ORDER_STATES).alias("order_status"),
            *_moneys("subtotal", "discount", "tax", "shipping", "total_amount"),
            *AUDIT,
        )
    )


def clean_order_items(raw_order_items: DataFrame) -> DataFrame:
    """Order items before orphans are removed.

    Models that join or left-join to orders anyway start here: the join drops the orphans, and items can be
    summed per order first.
    """
    return (
        latest_by(raw_order_items, "order_item_id")
        .where((F.col("quantity") > 0) & (F.col("unit_price") > 0))
        .select(
            "order_item_id",
            "order_id",
            "product_id",
            *_ints("quantity"),
            *_moneys("unit_price", "discount", "cost", "revenue", "gross_profit"),
            *AUDIT,
        )
    )


def stg_order_items(clean_order_items: DataFrame, stg_orders: DataFrame, raw_order_items: DataFrame) -> DataFrame:
    return lookup(
        clean_order_items,
        stg_orders.select("order_id"),
        "order_id",
        "left_semi",
        row_id="order_item_id",
        profile=raw_order_items,
    ).select(*clean_order_items.columns)


def stg_payments(raw_payments: DataFrame) -> DataFrame:
    return (
        latest_by(raw_payments, "payment_id")
        .where(F.col("amount") > 0)
        .select(
            "payment_id",
            "order_id",
            *_dates("payment_date"),
            "payment_method",
            one_of("status", PAYMENT_STATES).alias("status"),
            *_moneys("amount"),
            *AUDIT,
        )
    )


def stg_refunds(raw_refunds: DataFrame) -> DataFrame:
    return (
        latest_by(raw_refunds, "refund_id")
        .where(F.col("amount") > 0)
        .select(
            "refund_id",
            "order_id",
            *_dates("refund_date"),
            *_moneys("amount"),
            "reason",
            one_of("status", REFUND_STATES).alias("status"),
            *AUDIT,
        )
    )


def stg_shipments(raw_shipments: DataFrame) -> DataFrame:
    on_time = F.col("delivered_date") <= F.col("estimated_delivery_date")
    return raw_shipments.na.drop(subset=["shipment_id", "order_id"]).select(
        "shipment_id",
        "order_id",
        *_ints("warehouse_id"),
        "warehouse",
        "carrier",
        *_dates("shipped_date", "estimated_delivery_date", "delivered_date"),
        one_of("shipment_status", SHIPMENT_STATES).alias("shipment_status"),
        F.coalesce(on_time, F.lit(False)).alias("is_on_time"),
        *AUDIT,
    )


def stg_inventory(raw_inventory: DataFrame) -> DataFrame:
    # inventory_value stays as delivered, also where the quantity is clamped.
    return raw_inventory.na.drop(subset=["inventory_id", "product_id", "date"]).select(
        "inventory_id",
        *_dates("date"),
        "product_id",
        *_ints("warehouse_id"),
        "warehouse",
        *_ints("opening_qty", "received_qty", "sold_qty", "adjustment_qty"),
        F.greatest(F.col("closing_qty").cast("int"), F.lit(0)).alias("closing_qty"),
        *_moneys("unit_cost", "inventory_value"),
        *AUDIT,
    )


def stg_ad_spend(raw_ad_spend: DataFrame) -> DataFrame:
    valid = (F.col("spend") >= 0) & (F.col("impressions") >= 0) & (F.col("clicks") <= F.col("impressions"))
    return (
        latest_by(raw_ad_spend, "ad_record_id")
        .where(valid)
        .select(
            "ad_record_id",
            *_dates("date"),
            *_ints("campaign_id"),
            "campaign_name",
            *_ints("channel_id"),
            "channel",
            *_ints("impressions", "clicks", "conversions"),
            *_moneys("spend", "attributed_revenue"),
            ratio("attributed_revenue", "spend").alias("roas"),
            ratio("clicks", "impressions").alias("ctr"),
            *AUDIT,
        )
    )


def stg_payouts(raw_payouts: DataFrame) -> DataFrame:
    return raw_payouts.na.drop(subset=["payout_id"]).select(
        "payout_id",
        *_dates("payout_date"),
        "platform",
        *_dates("period_start", "period_end"),
        *_moneys("gross_sales", "fees", "refunds", "adjustments", "net_payout"),
        *AUDIT,
    )
