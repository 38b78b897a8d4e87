"""Intermediate models. Facts are summed per key before they are joined, so no join fans out or runs hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    days_between,
    is_sale,
    money,
    month_of,
    ratio,
    reconciliation_status,
    stock_status,
    zero_if_null,
)
from ledgerline.operators.dedup import latest_per_group
from ledgerline.operators.joins import lookup
from ledgerline.settings import Settings


def completed_refunds(stg_refunds: DataFrame) -> DataFrame:
    """Completed refunds per order."""
    return (
        stg_refunds.where(F.col("status") == "completed")
        .groupBy("order_id")
        .agg(F.sum("amount").alias("total_refunds"), F.count("*").alias("refund_count"))
    )


def completed_payments(stg_payments: DataFrame) -> DataFrame:
    """Payments per order: the amount of the completed ones, the number of all and of the completed ones."""
    completed = F.col("status") == "completed"
    return stg_payments.groupBy("order_id").agg(
        F.sum(F.when(completed, F.col("amount"))).alias("paid_amount"),
        F.count("*").alias("payment_count"),
        F.count_if(completed).alias("completed_count"),
    )


def int_order_revenue(stg_orders: DataFrame, clean_order_items: DataFrame, completed_refunds: DataFrame) -> DataFrame:
    # Orphan items fall away in the left join, so items need no semi join first; orders keep the partitioning
    # of their dedup and the three sides meet without another shuffle of the orders.
    items = clean_order_items.groupBy("order_id").agg(
        F.sum("revenue").alias("gross_revenue"),
        F.sum("discount").alias("total_discount"),
        F.sum("cost").alias("total_cost"),
        F.count("*").alias("item_count"),
        F.sum("quantity").alias("unit_count"),
    )
    joined = stg_orders.join(items, "order_id", "left").join(completed_refunds, "order_id", "left")
    sums = {
        c: zero_if_null(c)
        for c in ("gross_revenue", "total_discount", "total_refunds", "total_cost", "item_count", "unit_count", "refund_count")
    }
    # Item revenue is already net of the line discount; the model subtracts the discount once more on purpose.
    net = sums["gross_revenue"] - sums["total_discount"] - sums["total_refunds"]
    return joined.select(
        "order_id",
        "customer_id",
        "order_date",
        "channel_id",
        "channel",
        "order_status",
        *[sums[c].alias(c) for c in ("gross_revenue", "total_discount", "total_refunds")],
        net.alias("net_revenue"),
        sums["total_cost"].alias("total_cost"),
        (net - sums["total_cost"]).alias("gross_profit"),
        *[sums[c].alias(c) for c in ("item_count", "unit_count", "refund_count")],
        "subtotal",
        F.col("discount").alias("order_discount"),
        "tax",
        "shipping",
        "total_amount",
    )


def customer_history(int_order_revenue: DataFrame) -> DataFrame:
    """Sums of each customer's sales.

    order_id is unique here, so counting rows counts distinct orders; one customer with very many orders is summed
    before the shuffle and meets its customer row as a single row.
    """
    return (
        int_order_revenue.where(is_sale())
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("order_count"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.sum("net_revenue").alias("lifetime_revenue"),
            F.sum("gross_profit").alias("lifetime_gross_profit"),
            F.sum("total_refunds").alias("lifetime_refunds"),
        )
        .withColumn("avg_order_value", F.col("lifetime_revenue").cast("double") / F.col("order_count"))
    )


def int_customer_orders(stg_customers: DataFrame, customer_history: DataFrame) -> DataFrame:
    repeat = zero_if_null("order_count") > 1
    return stg_customers.join(customer_history, "customer_id", "left").select(
        "customer_id",
        "customer_segment",
        "acquisition_channel",
        "signup_date",
        "country",
        "state",
        zero_if_null("order_count").alias("order_count"),
        "first_order_date",
        "last_order_date",
        "lifetime_revenue",
        "lifetime_gross_profit",
        "lifetime_refunds",
        "avg_order_value",
        repeat.alias("is_repeat_customer"),
        F.when(repeat, days_between("first_order_date", "last_order_date")).otherwise(0).alias("active_days"),
    )


def int_product_sales(clean_order_items: DataFrame, stg_orders: DataFrame, raw_order_items: DataFrame) -> DataFrame:
    # One row per order and product first: distinct orders become a plain count, and the join carries sums.
    lines = clean_order_items.groupBy("order_id", "product_id").agg(
        F.count("*").alias("_lines"),
        F.sum("quantity").alias("_units"),
        F.sum("revenue").alias("_revenue"),
        F.sum("discount").alias("_discount"),
        F.sum("cost").alias("_cost"),
        F.sum("gross_profit").alias("_profit"),
        F.sum("unit_price").alias("_price"),
    )
    orders = stg_orders.where(is_sale()).select("order_id", "order_date")
    sold = lookup(lines, orders, "order_id", "inner", row_id="product_id", profile=raw_order_items)
    return (
        sold.groupBy("product_id")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("_units").alias("units_sold"),
            F.sum("_revenue").alias("gross_revenue"),
            F.sum("_discount").alias("total_discounts"),
            F.sum("_cost").alias("total_cost"),
            F.sum("_profit").alias("total_gross_profit"),
            (F.sum("_price").cast("double") / F.sum("_lines")).alias("avg_selling_price"),
            F.min("order_date").alias("first_sold_date"),
            F.max("order_date").alias("last_sold_date"),
        )
        .withColumn("gross_margin_pct", ratio("total_gross_profit", "gross_revenue"))
    )


def payment_variance():
    """What an order's completed payments leave open, in money."""
    return F.col("total_amount") - money(zero_if_null("paid_amount"))


def payment_status(settings: Settings):
    return reconciliation_status(payment_variance(), settings.match_threshold, settings.warn_threshold)


def int_payment_reconciliation(
    stg_orders: DataFrame, completed_payments: DataFrame, completed_refunds: DataFrame, settings: Settings
) -> DataFrame:
    # Keyed on orders: a payment whose order does not exist never shows up here.
    paid, refunded = money(zero_if_null("paid_amount")), money(zero_if_null("total_refunds"))
    count = zero_if_null("payment_count")
    return (
        stg_orders.select("order_id", "total_amount")
        .join(completed_payments.drop("completed_count"), "order_id", "left")
        .join(completed_refunds.drop("refund_count"), "order_id", "left")
        .select(
            "order_id",
            F.col("total_amount").alias("order_total"),
            paid.alias("paid_amount"),
            refunded.alias("refund_amount"),
            count.alias("payment_count"),
            payment_variance().alias("payment_variance"),
            payment_status(settings).alias("reconciliation_status"),
            (refunded > paid).alias("has_over_refund"),
            (count > 1).alias("has_duplicate_payment"),
        )
    )


def int_campaign_performance(stg_ad_spend: DataFrame) -> DataFrame:
    return (
        stg_ad_spend.groupBy(
            "campaign_id", "campaign_name", "channel_id", "channel", month_of("date").alias("year_month")
        )
        .agg(
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("conversions").alias("total_conversions"),
            F.sum("spend").alias("total_spend"),
            F.sum("attributed_revenue").alias("total_attributed_revenue"),
        )
        .withColumns(
            {
                "roas": ratio("total_attributed_revenue", "total_spend"),
                "avg_ctr": ratio("total_clicks", "total_impressions"),
                "avg_cvr": ratio("total_conversions", "total_clicks"),
                "cost_per_conversion": ratio("total_spend", "total_conversions"),
            }
        )
    )


def int_inventory_movements(stg_inventory: DataFrame, settings: Settings) -> DataFrame:
    snapshots = stg_inventory.select(
        "product_id", "warehouse_id", "warehouse", "date", "closing_qty", "unit_cost", "inventory_value"
    )
    return latest_per_group(snapshots, ["product_id", "warehouse_id"], "date").select(
        "product_id",
        "warehouse_id",
        "warehouse",
        F.col("date").alias("snapshot_date"),
        F.col("closing_qty").alias("available_qty"),
        "unit_cost",
        "inventory_value",
        stock_status("closing_qty", settings.low_stock_below).alias("stock_status"),
    )
