"""Report datasets: one query per visual, over the facts and the metric layer."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import divide, month_of
from ledgerline.operators.joins import lookup
from ledgerline.plans import metrics
from ledgerline.plans.rollups import over, rolled
from ledgerline.settings import Settings

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
    "December",
)
WAREHOUSE_CODES = ("WH-EAST", "WH-WEST", "WH-CENTRAL", "WH-SOUTH", "WH-NORTH")


# -- slicers ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Slice:
    """Report filters. Each applies to the frames that have its column; unset filters do nothing."""

    date_from: date | None = None
    date_to: date | None = None
    channel_name: str | None = None
    category: str | None = None
    customer_segment: str | None = None
    campaign_name: str | None = None
    warehouse_code: str | None = None
    carrier: str | None = None
    platform: str | None = None
    reconciliation_status: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        if "date_id" in df.columns:
            if self.date_from is not None:
                df = df.where(F.col("date_id") >= F.lit(self.date_from))
            if self.date_to is not None:
                df = df.where(F.col("date_id") <= F.lit(self.date_to))
        for name, value in vars(self).items():
            if value is not None and name in df.columns:
                df = df.where(F.col(name) == value)
        return df


# Models a page reads, and the columns of small tables by which their rows are sliced as well.
SLICED = ("fct_orders", "sold_lines", "fct_refunds", "fct_payments", "fct_ad_spend", "fct_inventory", "fct_shipments",
          "fct_payouts", "dim_customer")


def sliced(warehouse, where: Slice):
    """A warehouse whose facts hold only the rows of a slice, so that any report on it is filtered before it sums.

    Names of channels, warehouses and categories become semi joins on their keys; the rest are plain filters.
    """
    named = {
        "channel_id": ("dim_channel", "channel_name"),
        "warehouse_id": ("dim_warehouse", "warehouse_code"),
        "product_id": ("stg_products", "category"),
    }
    found = warehouse.copy()
    for model in SLICED:
        df = where.apply(warehouse[model])
        for key, (table, column) in named.items():
            value = getattr(where, column)
            if value is not None and key in df.columns and column not in df.columns:
                df = df.join(warehouse[table].where(F.col(column) == value).select(key), key, "left_semi")
        found.replace(model, df.select(*warehouse[model].columns))
    return found


def on_slice(report, **where):
    """A report over the rows of a slice."""
    return lambda warehouse: sliced(warehouse, Slice(**where)).run(report)


def order_detail(
    fct_orders: DataFrame, dim_channel: DataFrame, stg_customers: DataFrame, raw_orders: DataFrame, where: Slice
) -> DataFrame:
    """Drill-through to orders. Date and channel filters reach the orders before the customers are joined."""
    orders = where.apply(fct_orders.join(F.broadcast(dim_channel.select("channel_id", "channel_name")), "channel_id", "left"))
    customers = where.apply(stg_customers.select("customer_id", "customer_segment"))
    how = "left" if where.customer_segment is None else "inner"
    return lookup(orders, customers, "customer_id", how, row_id="order_id", profile=raw_orders).select(
        "order_id",
        "customer_id",
        "customer_segment",
        "date_id",
        "channel_name",
        "order_status",
        "net_revenue",
        "gross_profit",
        "total_amount",
    )


# -- executive page -----------------------------------------------------------------------------------------


def executive_kpis(warehouse) -> DataFrame:
    """One row per month: the cards of the first page."""
    names = ("net_revenue", "gross_profit", "gross_margin_pct", "order_count", "aov", "refund_rate")
    monthly = metrics.evaluate(warehouse, names, ("month",))
    months = Window.orderBy(F.year("month") * 12 + F.month("month"))  # one row per month, calendar-bounded

    def change(name: str, back: int):
        before = F.max(name).over(months.rangeBetween(-back, -back)).cast("double")
        return F.try_divide(F.coalesce(F.col(name).cast("double"), F.lit(0.0)) - before, before)

    target = warehouse.settings.refund_rate_target
    return monthly.withColumns(
        {
            "net_revenue_yoy_pct": change("net_revenue", 12),
            "order_count_mom_pct": change("order_count", 1),
            "refund_rate_target": F.lit(target),
            "refund_rate_met": F.col("refund_rate") <= target,
        }
    )


def revenue_trend(warehouse) -> DataFrame:
    """Month-to-date net revenue per day beside the same day last year."""
    running = metrics.to_date(warehouse, ("net_revenue",)).where(F.col("horizon") == "mtd")
    now = running.select("date_id", F.col("net_revenue").alias("net_revenue_mtd"))
    before = running.select(F.col("date_id").alias("_day"), F.col("net_revenue").alias("net_revenue_mtd_py"))
    return now.join(before, F.add_months("date_id", -12) == F.col("_day"), "left").drop("_day")


def revenue_by_channel(warehouse) -> DataFrame:
    sums = metrics.evaluate(warehouse, ("net_revenue",), ("channel_id",))
    names = warehouse["dim_channel"].select("channel_id", "channel_name")
    return sums.join(F.broadcast(names), "channel_id").orderBy(F.desc("net_revenue"), "channel_id")


def _by_product(lines: DataFrame, *keys: str) -> DataFrame:
    """Item sums per product and further keys: products are attached to sums, never to single lines."""
    return lines.groupBy("product_id", *keys).agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("revenue").alias("revenue"),
        F.sum("discount").alias("discount"),
        F.sum("gross_profit").alias("gross_profit"),
    )


def _with_category(sums: DataFrame, stg_products: DataFrame) -> DataFrame:
    return sums.join(stg_products.select("product_id", "category"), "product_id", "left")


def top_categories(stg_order_items: DataFrame, stg_products: DataFrame) -> DataFrame:
    return (
        _with_category(_by_product(stg_order_items), stg_products)
        .groupBy("category")
        .agg(F.sum("gross_profit").alias("gross_profit"))
        .orderBy(F.desc("gross_profit"), "category")
        .limit(10)
    )


# -- sales page ---------------------------------------------------------------------------------------------


def _steps(row: DataFrame, **amounts: str) -> DataFrame:
    steps = [
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), F.expr(e).cast("decimal(28,2)").alias("amount")
        )
        for i, (name, e) in enumerate(amounts.items(), start=1)
    ]
    return row.select(F.inline(F.array(*steps)))


def revenue_waterfall(warehouse) -> DataFrame:
    totals = metrics.evaluate(warehouse, ("gross_revenue", "total_discounts", "total_refunds", "net_revenue"))
    return _steps(
        totals, gross="gross_revenue", discounts="-total_discounts", refunds="-total_refunds", net="net_revenue"
    )


def monthly_trend(warehouse) -> DataFrame:
    return metrics.evaluate(warehouse, ("net_revenue", "gross_profit", "aov"), ("month",))


def category_margin_matrix(sold_lines: DataFrame, stg_products: DataFrame) -> DataFrame:
    lines = sold_lines.withColumn("_month", F.month("date_id"))
    sums = (
        _with_category(_by_product(lines, "_month"), stg_products)
        .groupBy("category", "_month")
        .agg(divide(F.sum("gross_profit"), F.sum("revenue")).alias("margin"))
        .withColumn("_name", F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.col("_month")))
    )
    return sums.groupBy("category").pivot("_name", list(MONTH_NAMES)).agg(F.first("margin"))


def channel_by_category(sold_lines: DataFrame, stg_products: DataFrame, dim_channel: DataFrame) -> DataFrame:
    return (
        _with_category(_by_product(sold_lines, "channel_id"), stg_products)
        .groupBy("channel_id", "category")
        .agg((F.sum("revenue") - F.sum("discount")).alias("net_revenue"))
        .join(F.broadcast(dim_channel.select("channel_id", "channel_name")), "channel_id", "left")
        .select("channel_name", "category", "net_revenue")
    )


def top_products(stg_order_items: DataFrame, stg_products: DataFrame) -> DataFrame:
    names = stg_products.select("product_id", "product_name")
    return (
        _by_product(stg_order_items)
        .withColumn("net_revenue", F.col("revenue") - F.col("discount"))
        .withColumn("gross_margin_pct", divide("gross_profit", "revenue"))
        .orderBy(F.desc("net_revenue"), "product_id")
        .limit(20)
        .join(names, "product_id", "left")
        .select("product_id", "product_name", "units_sold", "net_revenue", "gross_margin_pct")
        .orderBy(F.desc("net_revenue"), "product_id")
    )


# -- customer and marketing page ----------------------------------------------------------------------------


def new_and_repeat(warehouse) -> DataFrame:
    return metrics.evaluate(warehouse, ("new_customers", "repeat_customers"))


def cac_trend(warehouse) -> DataFrame:
    return metrics.evaluate(warehouse, ("total_ad_spend", "new_customers", "cac"), ("month",))


def ltv_histogram(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.groupBy("value_tier", "customer_segment").agg(
        F.count("*").alias("customers"),
        (F.sum("lifetime_revenue").cast("double") / F.count("*")).alias("avg_ltv"),
    )


def roas_by_channel(fct_ad_spend: DataFrame) -> DataFrame:
    roas = F.col("roas")
    return (
        fct_ad_spend.groupBy("channel")
        .agg(divide(F.sum("attributed_revenue"), F.sum("spend")).alias("roas"))
        .withColumn("band", F.when(roas > 3, "green").when(roas >= 1, "yellow").when(roas < 1, "red"))
        .orderBy(F.desc_nulls_last("roas"), "channel")
    )


def campaign_table(fct_ad_spend: DataFrame) -> DataFrame:
    return (
        fct_ad_spend.groupBy("channel", "campaign_name")
        .agg(
            *[F.sum(c).alias(c) for c in ("spend", "attributed_revenue", "impressions", "clicks", "conversions")]
        )
        .select(
            "channel",
            "campaign_name",
            "spend",
            "attributed_revenue",
            divide("attributed_revenue", "spend").alias("roas"),
            divide("clicks", "impressions").alias("ctr"),
            divide("conversions", "clicks").alias("cvr"),
        )
    )


def cohort_matrix(dim_customer: DataFrame) -> DataFrame:
    """New customers by signup cohort and month of the first order."""
    counted = (
        dim_customer.where(F.col("first_order_date").isNotNull())
        .groupBy(month_of("signup_date").alias("signup_cohort"), F.month("first_order_date").alias("_month"))
        .agg(F.count("*").alias("n"))
        .withColumn("_name", F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.col("_month")))
    )
    return counted.groupBy("signup_cohort").pivot("_name", list(MONTH_NAMES)).agg(F.sum("n"))


# -- inventory and fulfilment page --------------------------------------------------------------------------


def stock_kpis(warehouse) -> DataFrame:
    return metrics.evaluate(warehouse, ("out_of_stock_skus", "low_stock_skus", "total_inventory_value"))


def stock_by_category(fct_inventory: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Products per category that were ever in each state; states are made distinct before the join."""
    states = fct_inventory.select("product_id", "stock_status").distinct()
    return _with_category(states, stg_products).groupBy("category", "stock_status").agg(F.count("*").alias("skus"))


def on_time_gauge(fct_shipments: DataFrame, settings: Settings) -> DataFrame:
    rate = divide(F.count_if("is_on_time"), F.count("*"))
    return fct_shipments.agg(F.count("*").alias("shipment_count"), rate.alias("on_time_rate")).withColumns(
        {"target": F.lit(settings.on_time_target), "met": F.col("on_time_rate") >= settings.on_time_target}
    )


def value_by_warehouse(fct_inventory: DataFrame, stg_products: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    sums = fct_inventory.groupBy("product_id", "warehouse_id").agg(F.sum("inventory_value").alias("value"))
    return (
        _with_category(sums, stg_products)
        .groupBy("category", "warehouse_id")
        .agg(F.sum("value").alias("value"))
        .join(F.broadcast(dim_warehouse.select("warehouse_id", "warehouse_code")), "warehouse_id")
        .groupBy("category")
        .pivot("warehouse_code", list(WAREHOUSE_CODES))
        .agg(F.sum("value"))
    )


def late_by_carrier(fct_shipments: DataFrame) -> DataFrame:
    return fct_shipments.groupBy("carrier").agg(F.count_if(F.col("days_late") > 0).alias("late_shipments"))


def transit_trend(fct_shipments: DataFrame) -> DataFrame:
    return fct_shipments.groupBy(month_of("date_id").alias("month")).agg(
        F.avg("transit_days").alias("avg_transit_days")
    )


def at_risk_products(fct_inventory: DataFrame, stg_products: DataFrame, raw_inventory: DataFrame) -> DataFrame:
    at_risk = fct_inventory.where(F.col("stock_status").isin("out_of_stock", "low_stock"))
    names = stg_products.select("product_id", "product_name")
    return (
        lookup(at_risk, names, "product_id", "left", row_id="inventory_id", profile=raw_inventory)
        .select("inventory_id", "product_name", "closing_qty", "days_of_supply", "stock_status")
        .orderBy(F.asc_nulls_last("days_of_supply"), "inventory_id")
    )


# -- finance page -------------------------------------------------------------------------------------------


def reconciliation_waterfall(warehouse) -> DataFrame:
    def run(fct_orders: DataFrame, stg_payments: DataFrame, stg_payouts: DataFrame) -> DataFrame:
        # Three one-row sums; payouts are summed from their own rows, not from the repeated company totals.
        sold = fct_orders.agg(F.sum("net_revenue").alias("net"), F.sum("total_refunds").alias("refunds"))
        paid = stg_payments.where(F.col("status") == "completed").agg(F.sum("amount").alias("paid"))
        sent = stg_payouts.agg(F.sum("fees").alias("fees"), F.sum("net_payout").alias("payout"))
        row = sold.withColumns(
            {c: one.select(c).scalar() for one, cs in ((paid, ("paid",)), (sent, ("fees", "payout"))) for c in cs}
        )
        return _steps(row, net_revenue="net", payments="paid", refunds="-refunds", fees="-fees", net_payout="payout")

    return warehouse.run(run)


def finance_kpis(warehouse) -> DataFrame:
    return metrics.evaluate(warehouse, ("payment_exceptions", "payment_warnings", "total_payout_variance"))


def exception_trend(fct_payouts: DataFrame) -> DataFrame:
    return fct_payouts.groupBy(month_of("date_id").alias("month")).agg(
        F.count_if(F.col("reconciliation_status") == "EXCEPTION").alias("recon_exceptions")
    )


def status_by_platform(fct_payouts: DataFrame) -> DataFrame:
    return fct_payouts.groupBy("platform", "reconciliation_status").agg(F.count("*").alias("payouts"))


def payout_table(mart_finance: DataFrame) -> DataFrame:
    return mart_finance.select(
        "year_month", "platform", "gross_revenue", "net_payout", "payout_variance", "reconciliation_status"
    ).orderBy("year_month", "platform")


def refund_anomalies(fct_refunds: DataFrame) -> DataFrame:
    return fct_refunds.where("is_over_refund").select(
        "refund_id",
        "order_id",
        F.col("amount").alias("refund_amount"),
        F.col("order_paid_amount").alias("payment_amount"),
        "is_over_refund",
    )


# The slice the registered drill-through shows.
CATEGORY = "PROMO"
YEARS = {"date_from": date(1997, 1, 1), "date_to": date(1998, 12, 31)}
SAMPLE_SLICE = Slice(channel_name="email", customer_segment="BUILDING", **YEARS)

QUERIES = {
    "rpt_executive_kpis": over(rolled, executive_kpis),
    "rpt_revenue_trend": over(rolled, revenue_trend),
    "rpt_revenue_by_channel": over(rolled, revenue_by_channel),
    "rpt_top_categories": top_categories,
    "rpt_revenue_waterfall": over(rolled, revenue_waterfall),
    "rpt_monthly_trend": over(rolled, monthly_trend),
    "rpt_category_margin_matrix": category_margin_matrix,
    "rpt_channel_by_category": channel_by_category,
    "rpt_top_products": top_products,
    "rpt_new_and_repeat": over(rolled, new_and_repeat),
    "rpt_cac_trend": over(rolled, cac_trend),
    "rpt_ltv_histogram": ltv_histogram,
    "rpt_roas_by_channel": roas_by_channel,
    "rpt_campaign_table": campaign_table,
    "rpt_cohort_matrix": cohort_matrix,
    "rpt_stock_kpis": over(rolled, stock_kpis),
    "rpt_stock_by_category": stock_by_category,
    "rpt_on_time_gauge": on_time_gauge,
    "rpt_value_by_warehouse": value_by_warehouse,
    "rpt_late_by_carrier": late_by_carrier,
    "rpt_transit_trend": transit_trend,
    "rpt_at_risk_products": at_risk_products,
    "rpt_reconciliation_waterfall": reconciliation_waterfall,
    "rpt_finance_kpis": over(rolled, finance_kpis),
    "rpt_exception_trend": exception_trend,
    "rpt_status_by_platform": status_by_platform,
    "rpt_payout_table": payout_table,
    "rpt_refund_anomalies": refund_anomalies,
    # One slice for each page.
    "rpt_sliced_revenue_by_channel": on_slice(revenue_by_channel, **YEARS),
    "rpt_sliced_channel_by_category": on_slice(channel_by_category, channel_name="email", category=CATEGORY, **YEARS),
    "rpt_sliced_campaigns": on_slice(campaign_table, campaign_name="Campaign 3", channel_name="paid_search", **YEARS),
    "rpt_sliced_late_by_carrier": on_slice(late_by_carrier, warehouse_code="WH-WEST", carrier="UPS", **YEARS),
    "rpt_sliced_status_by_platform": on_slice(
        status_by_platform, platform="direct", reconciliation_status="EXCEPTION", **YEARS
    ),
    "rpt_order_detail": lambda fct_orders, dim_channel, stg_customers, raw_orders: order_detail(
        fct_orders, dim_channel, stg_customers, raw_orders, SAMPLE_SLICE
    ),
}
