"""Metric layer: a registry of definitions over additive base sums, and time intelligence on top.

Every metric is an expression over base sums. Base sums are taken from the facts at the wanted grain, one
aggregation per fact, and the metric expressions run on that small result. Running totals and period comparisons
therefore never touch fact rows: their windows work on days or months, whose number the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import month_index
from ledgerline.functions.literals import values_table
from ledgerline.plans.rollups import over, rolled


def _less(first: str, *rest: str) -> str:
    """first - rest with blanks as zero, blank only when everything is."""
    names = (first, *rest)
    parts = " - ".join(f"coalesce({n}, 0)" for n in names)
    return f"case when coalesce({', '.join(names)}) is not null then {parts} end"


def _over(numerator: str, denominator: str) -> str:
    return f"try_divide(cast({numerator} as double), cast({denominator} as double))"


@dataclass(frozen=True)
class Metric:
    name: str
    display_name: str
    expression: str
    description: str = ""
    formula: str = ""
    grain: str = ""
    unit: str | None = None
    format: str | None = None
    filters: str | None = None
    limitations: str | None = None


NET = _less("gross_revenue", "total_discounts", "total_refunds")
PROFIT = _less("gross_revenue", "total_discounts", "total_refunds", "cogs")
AVERAGE_STOCK = _over("inventory_value", "inventory_months")

# The metric catalog. Names, formulas, grains, units, formats and filters are fixed values.
CATALOG = (
    Metric("gross_revenue", "Gross Revenue", "gross_revenue", "Item revenue of orders that were not cancelled", "SUM(fct_order_items.revenue)", "order_item", "USD", "$#,##0", "order_status NOT IN ('cancelled')", "Open and disputed items count as well"),
    Metric("net_revenue", "Net Revenue", NET, "What is left of gross revenue without discounts and refunds", "gross_revenue - total_discounts - total_refunds", "order_item", "USD", "$#,##0"),
    Metric("cogs", "COGS", "cogs", "Cost of the items sold", "SUM(fct_order_items.cost)", "order_item", "USD", "$#,##0"),
    Metric("gross_profit", "Gross Profit", PROFIT, "Net revenue after cost of goods", "net_revenue - cogs", "order_item", "USD", "$#,##0"),
    Metric("gross_margin_pct", "Gross Margin %", _over(PROFIT, NET), "Share of net revenue that is gross profit", "gross_profit / net_revenue", "order_item", "percent", "0.0%", None, "Null when there is no net revenue"),
    Metric("order_count", "Orders", "order_count", "Distinct orders that were not cancelled", "COUNT(DISTINCT fct_orders.order_id)", "order", None, None, "order_status NOT IN ('cancelled')"),
    Metric("aov", "AOV", _over(NET, "order_count"), "Net revenue per order", "net_revenue / order_count", "order", "USD", "$#,##0.00"),
    Metric("new_customers", "New Customers", "new_customers", "Customers whose first order falls in the period", "COUNT(DISTINCT customer_id) WHERE is_first_order = TRUE", "customer"),
    Metric("cac", "CAC", _over("total_ad_spend", "new_customers"), "Ad spend per customer won", "total_ad_spend / new_customers", "period", "USD", "$#,##0.00", None, "Last-touch attribution; only advertising cost is counted"),
    Metric("roas", "ROAS", _over("attributed_revenue", "total_ad_spend"), "Attributed revenue per unit of ad spend", "attributed_revenue / ad_spend", "campaign × date", None, "0.00x", None, "Last-touch attribution; flatters campaigns early in the journey"),
    Metric("refund_rate", "Refund Rate", _over("total_refunds", "gross_revenue"), "Refunds as a share of gross revenue", "total_refunds / gross_revenue", "order", "percent", "0.0%"),
    Metric("inventory_turnover", "Inventory Turnover", _over("cogs", AVERAGE_STOCK), "Cost of goods against the average monthly stock value", "cogs / AVG(inventory_value)", "product × warehouse × date", None, "0.0x"),
    Metric("ltv", "Customer LTV", _over("lifetime_revenue", "total_customers"), "Net revenue of a customer to date, averaged over customers", "SUM(net_revenue) grouped by customer_id", "customer", "USD", "$#,##0"),
)
CATALOG_NAMES = tuple(m.name for m in CATALOG)

# Further measures of the report model.
MEASURES = CATALOG + (
    Metric("total_discounts", "Total Discounts", "total_discounts"),
    Metric("total_refunds", "Total Refunds", "total_refunds"),
    Metric("units_sold", "Units Sold", "units_sold"),
    Metric("total_customers", "Total Customers", "total_customers"),
    Metric("repeat_customers", "Repeat Customers", "repeat_customers"),
    Metric("total_ad_spend", "Total Ad Spend", "total_ad_spend"),
    Metric("attributed_revenue", "Attributed Revenue", "attributed_revenue"),
    Metric("total_conversions", "Total Conversions", "conversions"),
    Metric("ctr", "CTR", _over("clicks", "impressions")),
    Metric("cvr", "CVR", _over("conversions", "clicks")),
    Metric("refund_count", "Refund Count", "refund_count"),
    Metric("over_refund_count", "Over-Refund Count", "over_refund_count"),
    Metric("payment_exceptions", "Payment Exceptions", "payment_exceptions"),
    Metric("payment_warnings", "Payment Warnings", "payment_warnings"),
    Metric("total_inventory_value", "Total Inventory Value", "inventory_value"),
    Metric("out_of_stock_skus", "Out of Stock SKUs", "out_of_stock_skus"),
    Metric("low_stock_skus", "Low Stock SKUs", "low_stock_skus"),
    Metric("shipment_count", "Shipment Count", "shipment_count"),
    Metric("on_time_rate", "On-Time Delivery Rate", _over("on_time", "shipment_count")),
    Metric("avg_transit_days", "Avg Transit Days", _over("transit_days", "delivered")),
    Metric("late_shipments", "Late Shipments", "late_shipments"),
    Metric("total_net_payout", "Total Net Payout", "net_payout"),
    Metric("total_payout_variance", "Total Payout Variance", "payout_variance"),
    Metric("recon_exceptions", "Recon Exception Count", "recon_exceptions"),
    Metric("payout_delta", "Expected vs Actual Payout", _less(f"({NET})", "net_payout")),
)
BY_NAME = {m.name: m for m in MEASURES}


@dataclass(frozen=True)
class Facts:
    """Base sums one table contributes, its date column and the other columns it can be grouped by."""

    table: str
    date: str | None
    sums: dict[str, str]
    dims: tuple[str, ...] = ()
    additive: bool = True


FACTS = (
    Facts(
        "fct_orders",
        "date_id",
        {
            "gross_revenue": "sum(case when order_status <> 'cancelled' then gross_revenue end)",
            "total_discounts": "sum(total_discount)",
            "cogs": "sum(total_cost)",
            "units_sold": "sum(unit_count)",
            "order_count": "count_if(order_status <> 'cancelled')",
            "order_refunds": "sum(total_refunds)",
        },
        ("channel_id",),
    ),
    Facts(
        "fct_refunds",
        "date_id",
        {
            "total_refunds": "sum(amount)",
            "refund_count": "count(*)",
            "over_refund_count": "count_if(is_over_refund)",
        },
    ),
    Facts(
        "fct_payments",
        "date_id",
        {
            "payment_exceptions": "count_if(reconciliation_status = 'EXCEPTION')",
            "payment_warnings": "count_if(reconciliation_status = 'WARNING')",
        },
    ),
    Facts("first_orders", "first_date", {"new_customers": "count(*)"}),
    Facts(
        "fct_ad_spend",
        "date_id",
        {
            "total_ad_spend": "sum(spend)",
            "attributed_revenue": "sum(attributed_revenue)",
            "conversions": "sum(conversions)",
            "clicks": "sum(clicks)",
            "impressions": "sum(impressions)",
        },
        ("channel_id",),
    ),
    Facts("fct_inventory", "date_id", {"inventory_value": "sum(inventory_value)"}, ("warehouse_id",)),
    Facts(
        "fct_inventory",
        "date_id",
        {
            # A month counts once per group; over several years months of the same number fall together.
            "inventory_months": "count(distinct month(date_id))",
            "out_of_stock_skus": "count(distinct case when stock_status = 'out_of_stock' then product_id end)",
            "low_stock_skus": "count(distinct case when stock_status = 'low_stock' then product_id end)",
        },
        ("warehouse_id",),
        additive=False,
    ),
    Facts(
        "fct_shipments",
        "date_id",
        {
            "shipment_count": "count(*)",
            "on_time": "count_if(is_on_time)",
            "transit_days": "sum(transit_days)",
            "delivered": "count(transit_days)",
            "late_shipments": "count_if(days_late > 0)",
        },
        ("warehouse_id",),
    ),
    Facts(
        "fct_payouts",
        "date_id",
        {
            "net_payout": "sum(net_payout)",
            "payout_variance": "sum(payout_variance)",
            "recon_exceptions": "count_if(reconciliation_status = 'EXCEPTION')",
        },
    ),
    # Customers have no date in the model, so these stay the same whatever the period.
    Facts(
        "dim_customer",
        None,
        {
            "total_customers": "count(*)",
            "repeat_customers": "count_if(is_repeat_customer)",
            "lifetime_revenue": "sum(lifetime_revenue)",
        },
    ),
)
GRAINS = {"date": "DAY", "month": "MM", "quarter": "QUARTER", "year": "YEAR"}


def first_orders(fct_orders: DataFrame) -> DataFrame:
    """The date of each customer's first order: a minimum per customer, with no window over their orders."""
    return fct_orders.groupBy("customer_id").agg(F.min("date_id").alias("first_date"))


def _table(warehouse, name: str) -> DataFrame:
    return warehouse.run(first_orders) if name == "first_orders" else warehouse[name]


def daily_sums(warehouse) -> DataFrame:
    """Additive base sums per fact, day, channel and warehouse: what metrics need to know of the facts. Its rows go with
    the days, not with the data."""
    whole = None
    for facts in FACTS:
        if facts.date is None or not facts.additive:
            continue
        sums = [F.expr(e).alias(n) for n, e in facts.sums.items()]
        # The days of stock hold the value as well, so that the inventory is read once for both.
        table = "stock_days" if facts.table == "fct_inventory" else facts.table
        part = _table(warehouse, table).groupBy(F.col(facts.date).alias("date"), *facts.dims).agg(*sums)
        part = part.withColumn("fact", F.lit(facts.table))
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def stock_days(fct_inventory: DataFrame) -> DataFrame:
    """Days with stock per warehouse and state, with the products that are low or out of stock, and the value of the stock."""
    short = F.col("stock_status").isin("out_of_stock", "low_stock")
    product = F.when(short, F.col("product_id")).alias("product_id")
    return fct_inventory.groupBy("date_id", "warehouse_id", "stock_status", product).agg(
        F.sum("inventory_value").alias("inventory_value")
    )


def _source(warehouse, facts: Facts) -> tuple[DataFrame, str, dict[str, str]]:
    """Where the sums of a fact are taken from, its date column and the sums: the fact itself or the given rollups."""
    daily = warehouse.given("daily_sums")
    if daily is None:
        return _table(warehouse, facts.table), facts.date, facts.sums
    if not facts.additive:
        return warehouse["stock_days"], facts.date, facts.sums
    # A count over no rows is 0, a sum is null.
    again = {n: f"coalesce(sum({n}), 0)" if e.startswith("count") else f"sum({n})" for n, e in facts.sums.items()}
    return daily.where(F.col("fact") == facts.table), "date", again


def _words(expression: str) -> set[str]:
    return set("".join(c if c.isalnum() or c == "_" else " " for c in expression).split())


def base_sums(warehouse, wanted: set[str], by: Sequence[str] = (), additive_only: bool = False) -> DataFrame:
    """Base sums per group: each fact is aggregated on its own, the small results are stacked and merged."""
    parts = []
    # Facts of one table are summed in one pass over it; rollups keep those apart that do not add up.
    rollups = warehouse.given("daily_sums") is not None
    tables: dict[tuple[str, bool], Facts] = {}
    for facts in FACTS:
        sums = {n: e for n, e in facts.sums.items() if n in wanted}
        if not sums or facts.date is None or (additive_only and not facts.additive):
            continue
        source = facts.table, facts.additive or not rollups
        known = tables.get(source)
        tables[source] = replace(facts, sums=(known.sums if known else {}) | sums)
    for facts in tables.values():
        table, date, sums = _source(warehouse, facts)
        aggregates = [F.expr(e).alias(n) for n, e in sums.items()]
        keys = []
        for dim in by:
            if dim in GRAINS:
                day = F.col(date)
                keys.append((day if dim == "date" else F.trunc(day, GRAINS[dim])).alias(dim))
            elif dim in facts.dims:
                keys.append(F.col(dim))
            else:
                raise ValueError(f"{facts.table} cannot be grouped by {dim}")
        parts.append(table.groupBy(*keys).agg(*aggregates) if keys else table.agg(*aggregates))
    if not parts:
        if by:
            raise ValueError(f"customers have no date or channel to be grouped by: {sorted(wanted)}")
        return _customer_sums(warehouse, wanted)
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    # One row per group and fact here, all but one of them null in any column.
    merged = [F.max(c).alias(c) for c in stacked.columns if c not in by]
    result = stacked.groupBy(*by).agg(*merged) if by else stacked.agg(*merged)
    return with_constants(warehouse, result, wanted)


def _customer_sums(warehouse, wanted: set[str]) -> DataFrame:
    facts = next(f for f in FACTS if f.date is None)
    sums = [F.expr(e).alias(n) for n, e in facts.sums.items() if n in wanted]
    return warehouse[facts.table].agg(*sums)


def with_constants(warehouse, df: DataFrame, wanted: set[str]) -> DataFrame:
    """Add the base sums that have no date, each the same on every row."""
    names = [n for f in FACTS if f.date is None for n in f.sums if n in wanted]
    if not names:
        return df
    one_row = _customer_sums(warehouse, wanted)
    return df.withColumns({n: one_row.select(n).scalar() for n in names})


def evaluate(warehouse, names: Sequence[str] = CATALOG_NAMES, by: Sequence[str] = ()) -> DataFrame:
    """Metrics per group. ``by`` may hold one time grain (date, month, quarter, year) and dimension keys.

    Grouped by channel, refunds are those booked on the orders of the channel, because refunds themselves carry
    no channel in the model; otherwise they are taken at their own date.
    """
    expressions = {n: BY_NAME[n].expression for n in names}
    if "channel_id" in by:
        swap = lambda e: e.replace("total_refunds", "order_refunds")
        expressions = {n: swap(e) for n, e in expressions.items()}
    wanted = set().union(*(_words(e) for e in expressions.values()))
    sums = base_sums(warehouse, wanted, by)
    return sums.select(*by, *[F.expr(e).alias(n) for n, e in expressions.items()])


# -- time intelligence --------------------------------------------------------------------------------------

TO_DATE = {"mtd": ("year", "month_number"), "qtd": ("year", "quarter_number"), "ytd": ("year",)}


def daily_base(warehouse, wanted: set[str], by: Sequence[str] = ()) -> DataFrame:
    """Additive base sums on every day of the calendar; a day without facts has nulls."""
    undated = {n for f in FACTS if f.date is None for n in f.sums}
    sums = base_sums(warehouse, wanted - {"inventory_months"} - undated, ("date", *by), additive_only=True)
    calendar = warehouse["dim_date"].select("date_id", "year", "quarter_number", "month_number")
    daily = calendar.join(sums.withColumnRenamed("date", "date_id"), "date_id", "left")
    if "inventory_months" in wanted:
        # The first day with stock in a month stands for the month, so that months add up like sums.
        days = Window.partitionBy("year", "month_number").orderBy("date_id")
        stocked = F.col("inventory_value").isNotNull()
        daily = daily.withColumn(
            "inventory_months", F.when(stocked & (F.count_if(stocked).over(days) == 1), F.lit(1))
        )
    return daily


def to_date(warehouse, names: Sequence[str] = CATALOG_NAMES) -> DataFrame:
    """Metrics per day and horizon (day, mtd, qtd, ytd). Ratios are taken of the running sums."""
    expressions = {n: BY_NAME[n].expression for n in names}
    wanted = set().union(*(_words(e) for e in expressions.values()))
    daily = daily_base(warehouse, wanted)
    bases = [c for c in daily.columns if c not in ("date_id", "year", "quarter_number", "month_number")]
    sums = {}
    for horizon, period in TO_DATE.items():
        running = Window.partitionBy(*period).orderBy("date_id").rowsBetween(Window.unboundedPreceding, 0)
        sums.update({f"{horizon}_{b}": F.sum(b).over(running) for b in bases})
    daily = daily.withColumns(sums)
    types = {f.name: f.dataType for f in daily.schema}
    # Sums are wider than the daily values they add up; the day rows are brought to the same types.
    rows = [F.struct(F.lit("day").alias("horizon"), *[F.col(b).cast(types[f"mtd_{b}"]).alias(b) for b in bases])]
    rows += [F.struct(F.lit(h).alias("horizon"), *[F.col(f"{h}_{b}").alias(b) for b in bases]) for h in TO_DATE]
    unfolded = with_constants(warehouse, daily.select("date_id", F.inline(F.array(*rows))), wanted)
    return unfolded.select("date_id", "horizon", *[F.expr(e).alias(n) for n, e in expressions.items()])


def compare_months(warehouse, names: Sequence[str] = CATALOG_NAMES, by: Sequence[str] = ()) -> DataFrame:
    """Metrics per month with previous month, same month last year and the changes, one row per metric.

    The neighbours are found by month number, so a month without data yields blanks instead of an older month.
    """
    monthly = evaluate(warehouse, names, ("month", *by))
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    long = monthly.select("month", *by, F.inline(F.array(*pairs)))
    months = Window.partitionBy("metric", *by).orderBy(month_index("month"))
    pm = F.max("value").over(months.rangeBetween(-1, -1))
    py = F.max("value").over(months.rangeBetween(-12, -12))
    change = lambda base: F.try_divide(F.coalesce("value", F.lit(0.0)) - F.col(base), F.col(base))
    return long.withColumns({"pm": pm, "py": py}).withColumns({"mom_pct": change("pm"), "yoy_pct": change("py")})


def margin_change(warehouse) -> DataFrame:
    """Gross margin against the previous month in points; a blank previous margin counts as zero."""
    compared = compare_months(warehouse, ("gross_margin_pct",))
    points = F.when(
        F.coalesce("value", "pm").isNotNull(), F.coalesce("value", F.lit(0.0)) - F.coalesce("pm", F.lit(0.0))
    )
    return compared.select("month", F.col("value").alias("gross_margin_pct"), points.alias("mom_pp"))


# -- the catalog as a table ---------------------------------------------------------------------------------


def catalog_table(spark: SparkSession) -> DataFrame:
    fields = ("name", "display_name", "description", "formula", "grain", "unit", "format", "filters", "limitations")
    rows = [tuple(getattr(m, f) for f in fields) for m in CATALOG]
    return values_table(spark, rows, dict.fromkeys(fields, "string"))


def describe(name: str) -> Metric | None:
    return next((m for m in CATALOG if m.name == name), None)


def catalog_values(warehouse) -> DataFrame:
    """The catalog with each metric's value over all data."""
    totals = evaluate(warehouse)
    pairs = [F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in CATALOG_NAMES]
    values = totals.select(F.inline(F.array(*pairs)))
    return catalog_table(warehouse.spark).join(values, "name")


MONTHLY = tuple(m.name for m in MEASURES)
UNDATED = ("total_customers", "repeat_customers")


def _of(names: Sequence[str], *by: str):
    return over(rolled, lambda warehouse: evaluate(warehouse, names, by))


def _one(name: str):
    """A single measure: per month, or in all where it has no date."""
    return _of((name,), *(() if name in UNDATED else ("month",)))


CHANNEL = (
    "gross_revenue", "net_revenue", "cogs", "gross_profit", "gross_margin_pct", "order_count", "aov", "roas",
    "total_discounts", "total_refunds", "units_sold", "total_ad_spend", "attributed_revenue",
)

QUERIES = {
    "met_catalog": over(rolled, catalog_values),
    "met_monthly": _of(MONTHLY, "month"),
    "met_quarterly": _of(MONTHLY, "quarter"),
    "met_yearly": _of(MONTHLY, "year"),
    "met_by_channel": _of(CHANNEL, "channel_id"),
    "met_by_month_and_channel": _of(CHANNEL, "month", "channel_id"),
    "ti_to_date": over(rolled, lambda warehouse: to_date(warehouse)),
    "ti_compare_months": over(rolled, lambda warehouse: compare_months(warehouse)),
    "ti_compare_months_by_channel": over(rolled, lambda warehouse: compare_months(warehouse, CHANNEL, ("channel_id",))),
    "ti_margin_change": over(rolled, margin_change),
    **{f"met_{n}": _one(n) for n in MONTHLY if n != "ltv"},
    "met_ltv": lambda dim_customer: dim_customer.select(
        "customer_id", F.col("lifetime_revenue").alias("ltv")
    ),
}
