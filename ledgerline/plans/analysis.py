"""Ad-hoc analyses, validation reports and the canned questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import divide, is_sale, month_of, zero_if_null
from ledgerline.operators.joins import lookup, orphan_rows
from ledgerline.plans.intermediate import payment_status
from ledgerline.plans.rollups import itemised, over, shared
from ledgerline.plans.warehouse import LAYERS
from ledgerline.session import shared_folder
from ledgerline.settings import Settings


def _pct(part, whole, digits: int):
    return F.round(divide(part, whole) * 100, digits)


# -- analyses -----------------------------------------------------------------------------------------------


def customer_ltv_segments(dim_customer: DataFrame) -> DataFrame:
    repeat = F.count_if("is_repeat_customer")
    return (
        dim_customer.where(F.col("lifetime_revenue") > 0)
        .groupBy("customer_segment", "value_tier", month_of("signup_date").alias("signup_cohort"))
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.round(F.sum("lifetime_revenue").cast("double") / F.count("*"), 2).alias("avg_ltv"),
            F.round(F.avg("order_count"), 1).alias("avg_orders"),
            repeat.alias("repeat_customers"),
            _pct(repeat, F.count("customer_id"), 1).alias("repeat_rate_pct"),
        )
        .orderBy("signup_cohort", F.desc("avg_ltv"), "customer_segment", "value_tier")
    )


def inventory_risk(
    fct_inventory: DataFrame, stg_products: DataFrame, dim_warehouse: DataFrame, raw_inventory: DataFrame
) -> DataFrame:
    products = stg_products.select("product_id", "category", "subcategory", "product_name", "sku")
    sites = dim_warehouse.select("warehouse_id", F.col("warehouse_code").alias("warehouse"))
    at_risk = fct_inventory.where(F.col("stock_status").isin("out_of_stock", "low_stock"))
    joined = lookup(at_risk, products, "product_id", "inner", row_id="inventory_id", profile=raw_inventory)
    return (
        joined.join(F.broadcast(sites), "warehouse_id")
        .select(
            "inventory_id",
            "category",
            "subcategory",
            "product_name",
            "sku",
            "warehouse",
            "closing_qty",
            "stock_status",
            F.round("days_of_supply", 1).alias("days_of_supply"),
            F.round("inventory_value", 2).alias("inventory_value"),
        )
        .orderBy("stock_status", F.asc_nulls_last("days_of_supply"), "inventory_id")
    )


def marketing_roas(fct_ad_spend: DataFrame, dim_date: DataFrame) -> DataFrame:
    # Summed by day first, then the calendar is attached: its range also limits the result.
    daily = fct_ad_spend.groupBy("date_id", "channel", "campaign_name").agg(
        *[F.sum(c).alias(c) for c in ("spend", "attributed_revenue", "impressions", "clicks", "conversions")]
    )
    spend, revenue = F.sum("spend"), F.sum("attributed_revenue")
    clicks, shown, bought = F.sum("clicks"), F.sum("impressions"), F.sum("conversions")
    return (
        daily.join(F.broadcast(dim_date.select("date_id", "year", "month_number", "month_name")), "date_id")
        .groupBy("year", "month_number", "month_name", "channel", "campaign_name")
        .agg(
            spend.cast("decimal(18,2)").alias("total_spend"),
            revenue.cast("decimal(18,2)").alias("attributed_revenue"),
            F.round(divide(revenue, spend), 2).alias("roas"),
            shown.alias("impressions"),
            clicks.alias("clicks"),
            bought.alias("conversions"),
            _pct(clicks, shown, 2).alias("ctr_pct"),
            F.round(divide(spend, bought), 2).alias("cost_per_conversion"),
        )
        .orderBy("year", "month_number", F.desc_nulls_last("roas"), "channel", "campaign_name")
        .drop("month_number")
    )


def payment_exceptions(
    stg_payments: DataFrame, fct_orders: DataFrame, completed_payments: DataFrame, dim_date: DataFrame,
    stg_orders: DataFrame, raw_payments: DataFrame, settings: Settings,
) -> DataFrame:
    # Orders get their verdict first, so that payments meet only flagged orders, and only once.
    flagged = (
        fct_orders.select("order_id", "net_revenue", "total_amount")
        .join(completed_payments.select("order_id", "paid_amount"), "order_id", "left")
        .select("order_id", "net_revenue", payment_status(settings).alias("reconciliation_status"))
        .where(F.col("reconciliation_status").isin("EXCEPTION", "WARNING"))
    )
    payments = stg_payments.withColumnRenamed("payment_date", "date_id")
    joined = lookup(
        payments, flagged, "order_id", "inner", row_id="payment_id", profile=raw_payments, sized_by=stg_orders
    )
    return (
        joined.join(F.broadcast(dim_date.select("date_id", "full_date")), "date_id")
        .select(
            "payment_id",
            "order_id",
            F.col("full_date").alias("payment_date"),
            F.col("amount").alias("payment_amount"),
            F.col("net_revenue").alias("order_net_revenue"),
            F.abs(F.col("amount") - F.col("net_revenue")).alias("variance"),
            "reconciliation_status",
            "payment_method",
        )
        .orderBy("reconciliation_status", F.desc("variance"), "payment_id")
    )


def refund_analysis(
    stg_refunds: DataFrame, fct_orders: DataFrame, completed_payments: DataFrame, dim_date: DataFrame,
    stg_orders: DataFrame, raw_refunds: DataFrame,
) -> DataFrame:
    # Refunds meet revenue and payments of their order in one join. An order's revenue counts once per refund, as the
    # report defines it.
    orders = fct_orders.select("order_id", "gross_revenue").join(
        completed_payments.select("order_id", "paid_amount"), "order_id", "left"
    )
    refunds = stg_refunds.select("refund_id", "order_id", F.col("refund_date").alias("date_id"), "amount")
    joined = lookup(
        refunds, orders, "order_id", "inner", row_id="refund_id", profile=raw_refunds, sized_by=stg_orders
    )
    daily = joined.groupBy("date_id").agg(
        F.count("refund_id").alias("_n"),
        F.sum("amount").alias("_amount"),
        F.sum("gross_revenue").alias("_gross"),
        F.count_if(F.col("amount") > zero_if_null("paid_amount")).alias("_over"),
    )
    amount, gross = F.sum("_amount"), F.sum("_gross")
    return (
        daily.join(F.broadcast(dim_date.select("date_id", "year", "month_number", "month_name")), "date_id")
        .groupBy("year", "month_number", "month_name")
        .agg(
            F.sum("_n").alias("refund_count"),
            amount.alias("total_refunds"),
            gross.alias("gross_revenue"),
            _pct(amount, gross, 2).alias("refund_rate_pct"),
            F.sum("_over").alias("over_refund_count"),
        )
        .orderBy("year", "month_number")
        .drop("month_number")
    )


def revenue_by_channel(fct_orders: DataFrame, dim_date: DataFrame, dim_channel: DataFrame) -> DataFrame:
    measures = ("gross_revenue", "total_discount", "total_refunds", "net_revenue", "gross_profit")
    daily = fct_orders.groupBy("date_id", "channel_id").agg(
        F.count("*").alias("_orders"), *[F.sum(m).alias(m) for m in measures]
    )
    net = F.sum("net_revenue")
    return (
        daily.join(F.broadcast(dim_date.select("date_id", "year", "month_number", "month_name")), "date_id")
        .join(F.broadcast(dim_channel.select("channel_id", "channel_name")), "channel_id")
        .groupBy("year", "month_number", "month_name", "channel_name")
        .agg(
            F.sum("_orders").alias("order_count"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("total_discount").alias("total_discounts"),
            F.sum("total_refunds").alias("total_refunds"),
            net.alias("net_revenue"),
            F.sum("gross_profit").alias("gross_profit"),
            F.round(divide(net, F.sum("_orders")), 2).alias("aov"),
            _pct(F.sum("gross_profit"), net, 1).alias("gross_margin_pct"),
        )
        .orderBy("year", "month_number", "channel_name")
        .drop("month_number")
    )


# -- validation ---------------------------------------------------------------------------------------------


def financial_integrity(
    fct_refunds: DataFrame, fct_orders: DataFrame, fct_payments: DataFrame, fct_payouts: DataFrame
) -> DataFrame:
    def exception():
        return F.count_if(F.col("reconciliation_status") == "EXCEPTION")

    def rows(one_row: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("check_name"), F.col(c).alias("failed_records")) for c in one_row.columns]
        return one_row.select(F.inline(F.array(*pairs)))

    orders = fct_orders.agg(
        F.count_if(F.col("net_revenue") < 0).alias("negative_net_revenue"),
        F.count_if(F.col("gross_profit") < -1000).alias("large_negative_profit"),
    )
    return (
        rows(fct_refunds.agg(F.count_if("is_over_refund").alias("over_refunds")))
        .unionByName(rows(orders))
        .unionByName(rows(fct_payments.agg(exception().alias("payment_exceptions"))))
        .unionByName(rows(fct_payouts.agg(exception().alias("payout_exceptions"))))
    )


def orphan_records(warehouse) -> DataFrame:
    # Facts keep the keys and the rows of their staging tables, so the staging tables are counted.
    children = {
        "orphan_order_items": "stg_order_items",
        "orphan_payments": "stg_payments",
        "orphan_refunds": "stg_refunds",
        "orphan_shipments": "stg_shipments",
    }
    whole = None
    for name, table in children.items():
        part = orphan_rows(warehouse[table], warehouse["stg_orders"], "order_id", nulls_are_orphans=True).select(
            F.lit(name).alias("check_name"), F.col("orphans").alias("failed_records")
        )
        whole = part if whole is None else whole.unionByName(part)
    return whole


def row_counts(warehouse) -> DataFrame:
    whole = None
    for name in LAYERS["marts"]:
        part = warehouse[name].agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        whole = part if whole is None else whole.unionByName(part)
    return whole.orderBy("table_name")


def written_counts(warehouse) -> DataFrame:
    """Rows of the written marts. The numbers are in the footers of their files, so that no column is read."""
    written = itemised(warehouse).copy()
    written.materialise(LAYERS["marts"], shared_folder(warehouse.spark, "counted"))
    return row_counts(written)


# -- canned questions ---------------------------------------------------------------------------------------


def monthly_revenue_answer(fct_orders: DataFrame) -> DataFrame:
    return (
        fct_orders.where(is_sale())
        .groupBy(month_of("date_id").alias("month"))
        .agg(F.sum("net_revenue").alias("net_revenue"), F.sum("gross_profit").alias("gross_profit"))
        .orderBy("month")
    )


def refunds_by_reason(stg_refunds: DataFrame) -> DataFrame:
    return (
        stg_refunds.groupBy("reason")
        .agg(F.count("*").alias("refund_count"), F.sum("amount").alias("total_amount"))
        .orderBy(F.desc("refund_count"), "reason")
    )


def top_products_by_margin(dim_product: DataFrame) -> DataFrame:
    return (
        dim_product.select("product_id", "product_name", "category", "realised_margin_pct")
        .orderBy(F.desc_nulls_last("realised_margin_pct"), "product_id")
        .limit(20)
    )


def campaigns_by_roas(mart_marketing: DataFrame) -> DataFrame:
    return mart_marketing.select(
        "year_month", "campaign_name", "channel", "total_spend", "total_attributed_revenue", "roas"
    ).orderBy(F.desc_nulls_last("roas"), "campaign_name", "year_month")


def order_sample(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.orderBy("order_id").limit(10)


# -- the static dimensions, seen through the facts that use them --------------------------------------------


def channel_usage(dim_channel: DataFrame, fct_orders: DataFrame) -> DataFrame:
    used = fct_orders.groupBy("channel_id").agg(F.count("*").alias("orders"))
    return dim_channel.join(used, "channel_id", "left")


def warehouse_usage(dim_warehouse: DataFrame, fct_shipments: DataFrame) -> DataFrame:
    used = fct_shipments.groupBy("warehouse_id").agg(F.count("*").alias("shipments"))
    return dim_warehouse.join(used, "warehouse_id", "left")


def calendar_usage(dim_date: DataFrame, stg_orders: DataFrame) -> DataFrame:
    used = stg_orders.groupBy(F.col("order_date").alias("date_id")).agg(F.count("*").alias("orders"))
    return dim_date.join(used, "date_id", "left")


QUERIES = {
    "an_customer_ltv_segments": customer_ltv_segments,
    "an_inventory_risk": inventory_risk,
    "an_marketing_roas": marketing_roas,
    "an_payment_reconciliation": payment_exceptions,
    "an_refund_analysis": refund_analysis,
    "an_revenue_by_channel": revenue_by_channel,
    "val_financial_integrity": over(shared, financial_integrity),
    "val_orphan_records": over(itemised, orphan_records),
    "val_row_counts": over(itemised, row_counts),
    "val_written_counts": written_counts,
    "ask_monthly_revenue": monthly_revenue_answer,
    "ask_refunds_by_reason": refunds_by_reason,
    "ask_top_products_by_margin": top_products_by_margin,
    "ask_campaigns_by_roas": campaigns_by_roas,
    "ask_order_sample": order_sample,
    "dim_channel": channel_usage,
    "dim_warehouse": warehouse_usage,
    "dim_date": calendar_usage,
}
