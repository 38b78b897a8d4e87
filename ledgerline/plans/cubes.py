"""Written tables from which many reports are read without another pass over the facts.

``active_customers`` holds who ordered on each day in each channel, as bitmaps; ``sales_cube`` the item sums for every
combination of month, channel and category, each of them kept or summed over.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import divide, is_sale, month_of
from ledgerline.operators.distinct import counted, merged, numbered, presence, shared
from ledgerline.operators.joins import lookup
from ledgerline.session import shared_folder

# -- customers ----------------------------------------------------------------------------------------------


def active_customers(fct_orders: DataFrame) -> DataFrame:
    """The customers with a sale, per day and channel: date_id, channel_id, word and bitmap.

    A customer counts once per day and channel before the join with the numbers, however many orders there are.
    """
    sales = fct_orders.where(is_sale()).select("date_id", "channel_id", "customer_id").distinct()
    numbers = numbered(sales, "customer_id")
    return presence(lookup(sales, numbers, "customer_id", "inner", row_id="date_id"), "number", ("date_id", "channel_id"))


def distinct_customers(present: DataFrame) -> DataFrame:
    """Different customers per day, month, quarter and year, per channel, per month and channel, and in all."""

    def cut(grain: str, period, channel) -> Column:
        none = F.lit(None)
        return F.struct(
            F.lit(grain).alias("grain"),
            (none if period is None else period).cast("date").alias("period"),
            (none if channel is None else channel).cast("int").alias("channel_id"),
        )

    day, channel = F.col("date_id"), F.col("channel_id")
    cuts = F.array(
        cut("day", day, None),
        cut("month", month_of(day), None),
        cut("quarter", F.trunc(day, "QUARTER"), None),
        cut("year", F.trunc(day, "YEAR"), None),
        cut("channel", None, channel),
        cut("month and channel", month_of(day), channel),
        cut("all", None, None),
    )
    spread = present.select(F.inline(cuts), "word", "bitmap")
    return counted(spread, ("grain", "period", "channel_id"), "customers")


def retained_customers(present: DataFrame) -> DataFrame:
    """Customers of each month and how many of them had ordered in the month before."""
    months = merged(present, (month_of("date_id").alias("month"),))
    before = months.withColumn("month", F.add_months("month", 1))
    return (
        counted(months, ("month",), "customers")
        .join(shared(months, before, ("month",), "retained"), "month", "left")
        .withColumn("retained", F.coalesce("retained", F.lit(0)))
    )


# -- sales --------------------------------------------------------------------------------------------------

DIMENSIONS = ("month", "channel_id", "category")


def sales_cube(sold_lines: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Item sums for all combinations of the dimensions; ``level`` says which are summed over (bits 4, 2 and 1).

    Lines are summed per product, month and channel first, so that the eight combinations are made from a table of that
    size and the facts are read once.
    """
    lines = sold_lines.groupBy("product_id", "channel_id", month_of("date_id").alias("month")).agg(
        F.sum("quantity").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.sum("discount").alias("discount"),
        F.sum("gross_profit").alias("profit"),
    )
    named = lines.join(stg_products.select("product_id", "category"), "product_id", "left")
    return named.cube(*DIMENSIONS).agg(
        F.grouping_id().alias("level"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").alias("revenue"),
        (F.sum("revenue") - F.sum("discount")).alias("net_revenue"),
        F.sum("profit").alias("gross_profit"),
    )


def level_of(by: Sequence[str]) -> int:
    """The level of the cube's rows that keep the given dimensions."""
    unknown = set(by) - set(DIMENSIONS)
    if unknown:
        raise ValueError(f"the cube has no {sorted(unknown)}")
    return sum(1 << i for i, name in enumerate(reversed(DIMENSIONS)) if name not in by)


def cube_slice(cube: DataFrame, by: Sequence[str] = (), **where) -> DataFrame:
    """Sums by some dimensions, for chosen values of these or of others, with the margin: rows of the cube as they stand.

    The dimensions that values are chosen of are among those kept.
    """
    rows = cube.where(F.col("level") == level_of({*by, *where}))
    for name, value in where.items():
        rows = rows.where(F.col(name).eqNullSafe(F.lit(value)))
    return rows.select(*by, "units_sold", "revenue", "net_revenue", "gross_profit", divide("gross_profit", "revenue").alias("margin"))


# -- registered ---------------------------------------------------------------------------------------------


@cache
def _written(warehouse, name: str) -> DataFrame:
    path = shared_folder(warehouse.spark, name)
    warehouse.run({"active_customers": active_customers, "sales_cube": sales_cube}[name]).write.parquet(path)
    return warehouse.spark.read.parquet(path)


# A way down from all sales: to a channel, a month of it, and its categories.
CHANNEL, MONTH = 4, date(1998, 5, 1)


def drill_path(warehouse) -> DataFrame:
    """Five slices of one written cube, stacked: all, channels, one channel's months, that month's categories, and
    channels by category."""
    cube = _written(warehouse, "sales_cube")
    steps = {
        "all": cube_slice(cube),
        "channels": cube_slice(cube, ("channel_id",)),
        "months of a channel": cube_slice(cube, ("month",), channel_id=CHANNEL),
        "categories of the month": cube_slice(cube, ("category",), channel_id=CHANNEL, month=MONTH),
        "channels and categories": cube_slice(cube, ("channel_id", "category")),
    }
    stacked = None
    for step, rows in steps.items():
        part = rows.withColumn("step", F.lit(step))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked.select("step", "month", "channel_id", "category", "units_sold", "net_revenue", "margin")


QUERIES = {
    "met_distinct_customers": lambda warehouse: distinct_customers(_written(warehouse, "active_customers")),
    "met_retained_customers": lambda warehouse: retained_customers(_written(warehouse, "active_customers")),
    "rpt_sales_cube": lambda warehouse: _written(warehouse, "sales_cube"),
    "rpt_drill_path": drill_path,
}
