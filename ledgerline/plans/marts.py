"""Dimensions, facts and marts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    days_between,
    is_sale,
    month_of,
    ratio,
    reconciliation_status,
    stock_status,
    zero_if_null,
)
from ledgerline.functions.literals import values_table
from ledgerline.operators.joins import lookup
from ledgerline.settings import Settings

# The two static dimensions.
CHANNEL_ROWS = [
    (1, "organic_search", "Organic", "Search"),
    (2, "paid_search", "Paid", "Search"),
    (3, "social_media", "Paid", "Social"),
    (4, "email", "Owned", "Email"),
    (5, "direct", "Organic", "Direct"),
    (6, "affiliate", "Paid", "Affiliate"),
    (7, "referral", "Organic", "Referral"),
]
WAREHOUSE_ROWS = [
    (1, "WH-EAST", "East", "New York", "NY"),
    (2, "WH-WEST", "West", "Los Angeles", "CA"),
    (3, "WH-CENTRAL", "Central", "Chicago", "IL"),
    (4, "WH-SOUTH", "South", "Dallas", "TX"),
    (5, "WH-NORTH", "North", "Minneapolis", "MN"),
]


# -- dimensions ---------------------------------------------------------------------------------------------


def date_columns(day, fiscal_start: int = 1) -> list:
    """Calendar attributes of a date column; the fiscal calendar starts in ``fiscal_start``."""
    shifted = F.add_months(day, (13 - fiscal_start) % 12)
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_label"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_abbr"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.year(shifted).alias("fiscal_year"),
        F.quarter(shifted).alias("fiscal_quarter"),
    ]


def dim_date(spark: SparkSession, settings: Settings) -> DataFrame:
    spine = spark.range(1).select(
        F.explode(F.sequence(F.lit(settings.spine_start), F.lit(settings.spine_end))).alias("date_id")
    )
    return spine.select(
        "date_id", F.col("date_id").alias("full_date"), *date_columns(F.col("date_id"), settings.fiscal_year_start_month)
    )


def dim_channel(spark: SparkSession) -> DataFrame:
    return values_table(
        spark,
        CHANNEL_ROWS,
        {"channel_id": "int", "channel_name": "string", "channel_type": "string", "channel_group": "string"},
    )


def dim_warehouse(spark: SparkSession) -> DataFrame:
    return values_table(
        spark,
        WAREHOUSE_ROWS,
        {"warehouse_id": "int", "warehouse_code": "string", "region": "string", "city": "string", "state": "string"},
    )


def dim_customer(stg_customers: DataFrame, customer_history: DataFrame, settings: Settings) -> DataFrame:
    revenue = zero_if_null("lifetime_revenue")
    tier = (
        F.when(revenue >= settings.high_value_from, "High")
        .when(revenue >= settings.medium_value_from, "Medium")
        .otherwise("Low")
    )
    return stg_customers.join(customer_history, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "signup_date",
        "country",
        "state",
        "city",
        "customer_segment",
        "acquisition_channel",
        zero_if_null("order_count").alias("order_count"),
        "first_order_date",
        "last_order_date",
        revenue.alias("lifetime_revenue"),
        zero_if_null("lifetime_gross_profit").alias("lifetime_gross_profit"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        (zero_if_null("order_count") > 1).alias("is_repeat_customer"),
        tier.alias("value_tier"),
    )


def dim_product(stg_products: DataFrame, int_product_sales: DataFrame) -> DataFrame:
    sales = int_product_sales.select(
        "product_id", "units_sold", "gross_revenue", "total_gross_profit", "gross_margin_pct"
    )
    margin = F.col("list_price") - F.col("unit_cost")
    return stg_products.join(sales, "product_id", "left").select(
        "product_id",
        "sku",
        "product_name",
        "category",
        "subcategory",
        "brand",
        "supplier",
        "unit_cost",
        "list_price",
        margin.alias("standard_margin"),
        ratio(margin, "list_price").alias("standard_margin_pct"),
        zero_if_null("units_sold").alias("units_sold"),
        zero_if_null("gross_revenue").alias("gross_revenue"),
        zero_if_null("total_gross_profit").alias("total_gross_profit"),
        F.coalesce("gross_margin_pct", F.lit(0.0)).alias("realised_margin_pct"),
        F.concat("category", F.lit(" > "), "subcategory").alias("category_path"),
    )


# -- facts --------------------------------------------------------------------------------------------------


def fct_orders(int_order_revenue: DataFrame) -> DataFrame:
    return int_order_revenue.select(
        "order_id",
        "customer_id",
        F.col("order_date").alias("date_id"),
        "channel_id",
        "order_status",
        "gross_revenue",
        "total_discount",
        "total_refunds",
        "net_revenue",
        "total_cost",
        "gross_profit",
        ratio("gross_profit", "net_revenue").alias("gross_margin_pct"),
        "item_count",
        "unit_count",
        "refund_count",
        "subtotal",
        "order_discount",
        "tax",
        "shipping",
        "total_amount",
        ((F.col("order_status") == "refunded") | (F.col("refund_count") > 0)).alias("has_refund"),
        (F.col("refund_count") > 1).alias("has_multiple_refunds"),
    )


def sold_lines(clean_order_items: DataFrame, stg_orders: DataFrame, raw_order_items: DataFrame) -> DataFrame:
    """Order items with the attributes of their order. The inner join is also what removes orphan items."""
    orders = stg_orders.select(
        "order_id", "customer_id", F.col("order_date").alias("date_id"), "channel_id", "order_status"
    )
    items = clean_order_items.drop("_ingested_at", "_source", "_batch_id")
    return lookup(items, orders, "order_id", "inner", row_id="order_item_id", profile=raw_order_items)


def fct_order_items(sold_lines: DataFrame, stg_products: DataFrame, raw_order_items: DataFrame) -> DataFrame:
    products = stg_products.select("product_id", "category", "subcategory", "brand")
    joined = lookup(sold_lines, products, "product_id", "left", row_id="order_item_id", profile=raw_order_items)
    return joined.select(
        "order_item_id",
        "order_id",
        "product_id",
        "customer_id",
        "date_id",
        "channel_id",
        "category",
        "subcategory",
        "brand",
        "quantity",
        "unit_price",
        "discount",
        "cost",
        "revenue",
        "gross_profit",
        ratio("gross_profit", "revenue").alias("item_margin_pct"),
        ratio("revenue", "quantity").alias("effective_unit_price"),
    )


def fct_payments(
    stg_payments: DataFrame, int_payment_reconciliation: DataFrame, stg_orders: DataFrame, raw_payments: DataFrame
) -> DataFrame:
    verdicts = int_payment_reconciliation.select(
        "order_id", "reconciliation_status", "payment_variance", "has_duplicate_payment"
    )
    joined = lookup(
        stg_payments, verdicts, "order_id", "left", row_id="payment_id", profile=raw_payments, sized_by=stg_orders
    )
    return joined.select(
        "payment_id",
        "order_id",
        F.col("payment_date").alias("date_id"),
        "payment_method",
        "status",
        "amount",
        F.coalesce("reconciliation_status", F.lit("UNKNOWN")).alias("reconciliation_status"),
        zero_if_null("payment_variance").alias("payment_variance"),
        F.coalesce("has_duplicate_payment", F.lit(False)).alias("is_duplicate"),
    )


def fct_refunds(
    stg_refunds: DataFrame, stg_orders: DataFrame, completed_payments: DataFrame, raw_refunds: DataFrame
) -> DataFrame:
    # Orders and payment totals, which are partitioned alike, are matched first, so refunds are joined and read only
    # once. A refund of an unknown order may still have a payment total, hence the full join.
    orders = stg_orders.select("order_id", "customer_id", "channel_id")
    context = orders.join(completed_payments.select("order_id", "paid_amount"), "order_id", "full")
    total = zero_if_null("paid_amount")
    joined = lookup(stg_refunds, context, "order_id", "left", row_id="refund_id", profile=raw_refunds, sized_by=stg_orders)
    return joined.select(
        "refund_id",
        "order_id",
        "customer_id",
        "channel_id",
        F.col("refund_date").alias("date_id"),
        "reason",
        "status",
        "amount",
        total.alias("order_paid_amount"),
        (F.col("amount") > total).alias("is_over_refund"),
    )


def fct_inventory(stg_inventory: DataFrame, settings: Settings) -> DataFrame:
    supply = F.col("closing_qty").cast("double") / (F.col("sold_qty") / F.lit(30.0))
    return stg_inventory.select(
        "inventory_id",
        F.col("date").alias("date_id"),
        "product_id",
        "warehouse_id",
        "opening_qty",
        "received_qty",
        "sold_qty",
        "adjustment_qty",
        "closing_qty",
        "unit_cost",
        "inventory_value",
        stock_status("closing_qty", settings.low_stock_below).alias("stock_status"),
        F.when(F.col("sold_qty") > 0, supply).alias("days_of_supply"),
    )


def fct_shipments(stg_shipments: DataFrame) -> DataFrame:
    # datediff is null when either date is, which is what the model asks for.
    return stg_shipments.select(
        "shipment_id",
        "order_id",
        "warehouse_id",
        F.col("shipped_date").alias("date_id"),
        "carrier",
        "shipment_status",
        "is_on_time",
        "estimated_delivery_date",
        "delivered_date",
        days_between("shipped_date", "delivered_date").alias("transit_days"),
        days_between("estimated_delivery_date", "delivered_date").alias("days_late"),
    )


def fct_ad_spend(stg_ad_spend: DataFrame) -> DataFrame:
    return stg_ad_spend.withColumnRenamed("date", "date_id").drop("_ingested_at", "_source", "_batch_id")


COMPANY_SUMS = ("gross_revenue", "total_discounts", "total_refunds", "net_revenue", "order_count")


def _payouts_and_revenue(stg_payouts: DataFrame, int_order_revenue: DataFrame) -> DataFrame:
    """Payouts with the company's revenue of the month in which their period starts; their own refunds are renamed."""
    months = (
        int_order_revenue.where(is_sale())
        .groupBy(month_of("order_date").alias("year_month"))
        .agg(
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("total_discount").alias("total_discounts"),
            F.sum("total_refunds").alias("total_refunds"),
            F.sum("net_revenue").alias("net_revenue"),
            F.count("*").alias("order_count"),
        )
    )
    payouts = stg_payouts.withColumnRenamed("refunds", "payout_refunds")
    return payouts.withColumn("year_month", month_of("period_start")).join(months, "year_month", "left")


def _payout_check(settings: Settings):
    """Variance of a payout and its verdict."""
    # Company-wide revenue against one platform's payout, refunds taken off twice: kept as the model defines it.
    expected = zero_if_null("net_revenue") - F.col("fees") - zero_if_null("total_refunds")
    variance = F.col("net_payout") - expected
    return variance, reconciliation_status(variance, settings.match_threshold, settings.warn_threshold)


def fct_payouts(stg_payouts: DataFrame, int_order_revenue: DataFrame, settings: Settings) -> DataFrame:
    variance, verdict = _payout_check(settings)
    return _payouts_and_revenue(stg_payouts, int_order_revenue).select(
        "payout_id",
        F.col("payout_date").alias("date_id"),
        "platform",
        "period_start",
        "period_end",
        "gross_sales",
        "fees",
        F.col("payout_refunds").alias("refunds"),
        "adjustments",
        "net_payout",
        zero_if_null("net_revenue").alias("period_gross_revenue"),
        zero_if_null("total_refunds").alias("period_refunds"),
        variance.alias("payout_variance"),
        verdict.alias("reconciliation_status"),
    )


# -- marts --------------------------------------------------------------------------------------------------


def mart_sales(fct_orders: DataFrame, dim_channel: DataFrame) -> DataFrame:
    # Summed per month and channel id first; the seven channel rows are attached to the result.
    sums = (
        fct_orders.where(is_sale())
        .groupBy(month_of("date_id").alias("year_month"), "channel_id")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("total_discount").alias("total_discounts"),
            F.sum("total_refunds").alias("total_refunds"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("total_cost").alias("total_cost"),
            F.sum("gross_profit").alias("gross_profit"),
            F.sum("unit_count").alias("units_sold"),
            F.count_if("has_refund").alias("refund_order_count"),
        )
    )
    return sums.join(F.broadcast(dim_channel), "channel_id", "left").select(
        "year_month",
        "channel_id",
        "channel_name",
        "channel_type",
        "channel_group",
        "order_count",
        "gross_revenue",
        "total_discounts",
        "total_refunds",
        "net_revenue",
        "total_cost",
        "gross_profit",
        ratio("gross_profit", "net_revenue").alias("gross_margin_pct"),
        ratio("net_revenue", "order_count").alias("aov"),
        "units_sold",
        "refund_order_count",
    )


def mart_customer(dim_customer: DataFrame, settings: Settings) -> DataFrame:
    last = F.col("last_order_date")
    recency = (
        F.when(last >= F.lit(settings.active_since), "Active")
        .when(last >= F.lit(settings.lapsing_since), "Lapsing")
        .otherwise("Churned")
    )
    return dim_customer.drop("first_name", "last_name").withColumns(
        {
            "signup_cohort": month_of("signup_date"),
            "days_since_last_order": days_between(last, F.lit(settings.as_of)),
            "recency_status": recency,
        }
    )


def mart_marketing(int_campaign_performance: DataFrame, int_customer_orders: DataFrame) -> DataFrame:
    joined_in = (
        int_customer_orders.where(F.col("first_order_date").isNotNull())
        .groupBy(month_of("first_order_date").alias("year_month"), "acquisition_channel")
        .agg(F.count("*").alias("_new_customers"))
        .withColumn("_channel", F.lower("acquisition_channel"))
        .drop("acquisition_channel")
    )
    return (
        int_campaign_performance.withColumn("_channel", F.lower("channel"))
        .join(joined_in, ["year_month", "_channel"], "left")
        .withColumn("approx_cac", ratio("total_spend", "_new_customers"))
        .drop("_channel", "_new_customers")
    )


def mart_inventory(int_inventory_movements: DataFrame, stg_products: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    # At most one row per product and warehouse, so no product can be hot here.
    products = stg_products.select("product_id", "product_name", "category", "subcategory", "brand")
    sites = dim_warehouse.select("warehouse_id", "warehouse_code", "region")
    return (
        int_inventory_movements.drop("warehouse")
        .join(products, "product_id", "left")
        .join(F.broadcast(sites), "warehouse_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            "subcategory",
            "brand",
            "warehouse_id",
            "warehouse_code",
            "region",
            "snapshot_date",
            "available_qty",
            "unit_cost",
            "inventory_value",
            "stock_status",
        )
    )


def mart_finance(
    stg_payouts: DataFrame, int_order_revenue: DataFrame, stg_payments: DataFrame, settings: Settings
) -> DataFrame:
    # Payouts meet the months of revenue once, for their own verdict and for the company's sums.
    variance, verdict = _payout_check(settings)
    # Amounts and states of payments are the same in staging and in the fact table.
    payments = stg_payments.groupBy(month_of("payment_date").alias("year_month")).agg(
        F.sum("amount").alias("total_collected"),
        F.count_if(F.col("status") == "failed").alias("failed_payments"),
        F.count("*").alias("payment_count"),
    )
    sums = [*COMPANY_SUMS, *payments.columns[1:]]
    # Company totals are repeated on each platform row; they must not be summed over platforms.
    return (
        _payouts_and_revenue(stg_payouts, int_order_revenue)
        .join(payments, "year_month", "left")
        .select(
            "year_month",
            "platform",
            *[zero_if_null(c).alias(c) for c in sums],
            "gross_sales",
            "fees",
            "payout_refunds",
            "adjustments",
            "net_payout",
            variance.alias("payout_variance"),
            verdict.alias("reconciliation_status"),
            (zero_if_null("net_revenue") - zero_if_null("total_collected")).alias("revenue_payment_gap"),
        )
    )
