"""Data-quality checks, their result table, summary, gate and the schema tests.

Each table is scanned once: all checks on it are aggregates of one row, which is then unfolded into one row per
check. Only the result table, one row per check, ever reaches the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.literals import values_table
from ledgerline.session import freed, shared_folder, slices
from ledgerline.settings import Settings


log = logging.getLogger(__name__)


class QualityGateError(RuntimeError):
    """Raised when a critical check failed."""


@dataclass(frozen=True)
class Check:
    check_id: str
    check_name: str
    dataset: str
    severity: str
    text: str


# Ids, names, datasets, severities and message texts of the checks.
CHECKS = (
    Check("uniq_001", "Unique Order IDs in staging", "main_staging.stg_orders", "CRITICAL", "duplicate order_ids detected"),
    Check("uniq_002", "Unique Customer IDs in staging", "main_staging.stg_customers", "CRITICAL", "duplicate customer_ids detected"),
    Check("uniq_003", "Unique Payment IDs (duplicate payment detection)", "main_staging.stg_payments", "CRITICAL", "duplicate payment_ids detected"),
    Check("uniq_004", "Unique Product IDs in staging", "main_staging.stg_products", "CRITICAL", "duplicate product_ids detected"),
    Check("ref_001", "Order items reference valid orders", "main_staging.stg_order_items", "CRITICAL", "order items with no matching order"),
    Check("ref_002", "Payments reference valid orders", "main_staging.stg_payments", "WARNING", "payments with no matching order"),
    Check("ref_003", "Refunds reference valid orders", "main_staging.stg_refunds", "WARNING", "refunds with no matching order"),
    Check("ref_004", "Shipments reference valid orders", "main_staging.stg_shipments", "WARNING", "shipments with no matching order"),
    Check("fin_001", "No negative inventory closing_qty in raw", "raw.raw_inventory", "WARNING", "records with closing_qty < 0"),
    Check("fin_002", "Refunds do not exceed payments per order", "main_marts.fct_refunds", "CRITICAL", "refunds exceed total payment for that order"),
    Check("fin_003", "Payment reconciliation exceptions (|variance| > $100)", "main_marts.fct_payments", "CRITICAL", "payments with reconciliation EXCEPTION (|variance| > $100)"),
    Check("fin_004", "Payment reconciliation warnings (|variance| $1-$100)", "main_marts.fct_payments", "WARNING", "payments with reconciliation WARNING ($1–$100 variance)"),
    Check("fin_005", "Orders with more than one completed payment", "main_staging.stg_payments", "CRITICAL", "orders have duplicate completed payments"),
    Check("fin_006", "Payout reconciliation exceptions", "main_marts.fct_payouts", "CRITICAL", "payouts with EXCEPTION status"),
    Check("comp_001", "Customer emails present (staging — after null removal)", "main_staging.stg_customers", "WARNING", "customers still have null email after staging"),
    Check("comp_002", "Product SKUs are present", "main_staging.stg_products", "WARNING", "products missing SKU"),
    Check("comp_003", "Orders with invalid status absorbed as 'unknown'", "main_staging.stg_orders", "INFO", "orders have status='unknown' (normalised from invalid raw values)"),
    Check("comp_004", "Minimum daily order volume (anomaly detection)", "main_staging.stg_orders", "WARNING", "days >30% below average daily orders"),
)
BY_ID = {c.check_id: c for c in CHECKS}


def _unfold(row: DataFrame, **checks: tuple[str | Column, str | Column] | tuple) -> DataFrame:
    """One aggregate row to one row per check: id, checked, failed, detail."""
    entries = []
    for check_id, (checked, failed, *detail) in checks.items():
        entries.append(
            F.struct(
                F.lit(check_id).alias("check_id"),
                F.coalesce(checked, F.lit(0)).cast("long").alias("checked"),
                F.coalesce(failed, F.lit(0)).cast("long").alias("failed"),
                (detail[0] if detail else F.lit("")).alias("detail"),
            )
        )
    return row.select(F.inline(F.array(*entries)))


def _references(child: DataFrame, parent: DataFrame, key: str, check_id: str) -> DataFrame:
    """Rows without a parent; a null key is no orphan. Counted per key first, so shared ghost ids cost nothing."""
    counted = child.groupBy(key).agg(F.count("*").alias("_rows"))
    known = parent.select(key).distinct().withColumn("_known", F.lit(True))
    row = counted.join(known, key, "left").agg(
        F.sum("_rows").alias("n"),
        F.sum(F.when(F.col("_known").isNull() & F.col(key).isNotNull(), F.col("_rows"))).alias("bad"),
    )
    return _unfold(row, **{check_id: (F.col("n"), F.col("bad"))})


def orders_profile(stg_orders: DataFrame) -> DataFrame:
    row = stg_orders.agg(
        F.count("*").alias("n"),
        F.countDistinct("order_id").alias("ids"),
        F.count_if(F.col("order_status") == "unknown").alias("unknown"),
    )
    return _unfold(row, uniq_001=(F.col("n"), F.col("n") - F.col("ids")), comp_003=(F.col("n"), F.col("unknown")))


def customers_profile(stg_customers: DataFrame) -> DataFrame:
    row = stg_customers.agg(
        F.count("*").alias("n"),
        F.countDistinct("customer_id").alias("ids"),
        F.count_if(F.col("email").isNull()).alias("no_email"),
    )
    return _unfold(row, uniq_002=(F.col("n"), F.col("n") - F.col("ids")), comp_001=(F.col("n"), F.col("no_email")))


def payments_profile(stg_payments: DataFrame) -> DataFrame:
    row = stg_payments.agg(F.count("*").alias("n"), F.countDistinct("payment_id").alias("ids"))
    return _unfold(row, uniq_003=(F.col("n"), F.col("n") - F.col("ids")))


def repeated_payments_profile(stg_payments: DataFrame) -> DataFrame:
    per_order = (
        stg_payments.where((F.col("status") == "completed") & F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count("*").alias("n"))
    )
    row = per_order.agg(F.count("*").alias("orders"), F.count_if(F.col("n") > 1).alias("repeated"))
    return _unfold(row, fin_005=(F.col("orders"), F.col("repeated")))


def products_profile(stg_products: DataFrame) -> DataFrame:
    row = stg_products.agg(
        F.count("*").alias("n"),
        F.countDistinct("product_id").alias("ids"),
        F.count_if(F.col("sku").isNull() | (F.trim("sku") == "")).alias("no_sku"),
    )
    return _unfold(row, uniq_004=(F.col("n"), F.col("n") - F.col("ids")), comp_002=(F.col("n"), F.col("no_sku")))


def item_references(stg_order_items: DataFrame, stg_orders: DataFrame) -> DataFrame:
    return _references(stg_order_items, stg_orders, "order_id", "ref_001")


def payment_references(stg_payments: DataFrame, stg_orders: DataFrame) -> DataFrame:
    return _references(stg_payments, stg_orders, "order_id", "ref_002")


def refund_references(stg_refunds: DataFrame, stg_orders: DataFrame) -> DataFrame:
    return _references(stg_refunds, stg_orders, "order_id", "ref_003")


def shipment_references(stg_shipments: DataFrame, stg_orders: DataFrame) -> DataFrame:
    return _references(stg_shipments, stg_orders, "order_id", "ref_004")


def raw_inventory_profile(raw_inventory: DataFrame) -> DataFrame:
    row = raw_inventory.agg(F.count("*").alias("n"), F.count_if(F.col("closing_qty") < 0).alias("negative"))
    return _unfold(row, fin_001=(F.col("n"), F.col("negative")))


def refunds_profile(fct_refunds: DataFrame) -> DataFrame:
    row = fct_refunds.agg(F.count("*").alias("n"), F.count_if("is_over_refund").alias("over"))
    return _unfold(row, fin_002=(F.col("n"), F.col("over")))


def reconciliation_profile(fct_payments: DataFrame) -> DataFrame:
    verdict = F.col("reconciliation_status")
    row = fct_payments.agg(
        F.count("*").alias("n"),
        F.count_if(verdict == "EXCEPTION").alias("exceptions"),
        F.count_if(verdict == "WARNING").alias("warnings"),
    )
    return _unfold(row, fin_003=(F.col("n"), F.col("exceptions")), fin_004=(F.col("n"), F.col("warnings")))


def payouts_profile(fct_payouts: DataFrame) -> DataFrame:
    row = fct_payouts.agg(
        F.count("*").alias("n"), F.count_if(F.col("reconciliation_status") == "EXCEPTION").alias("exceptions")
    )
    return _unfold(row, fin_006=(F.col("n"), F.col("exceptions")))


def daily_volume_profile(stg_orders: DataFrame, settings: Settings) -> DataFrame:
    # Two aggregates over the daily counts, whatever dates a feed may bring: the mean first, then the days below it.
    days = stg_orders.groupBy("order_date").agg(F.count("*").alias("n"))
    limit = days.agg(F.avg("n") * F.lit(float(settings.low_volume_share))).scalar()
    row = days.agg(F.count("*").alias("days"), F.count_if(F.col("n") < limit).alias("low"), F.avg("n").alias("mean"))
    detail = F.format_string(" (%s)", F.format_string("%.0f", F.coalesce("mean", F.lit(0.0))))
    return _unfold(row, comp_004=(F.col("days"), F.col("low"), detail))


# Which checks each profile answers, in the order of the result table.
PROFILES: dict[Callable[..., DataFrame], tuple[str, ...]] = {
    orders_profile: ("uniq_001", "comp_003"),
    customers_profile: ("uniq_002", "comp_001"),
    payments_profile: ("uniq_003",),
    products_profile: ("uniq_004", "comp_002"),
    item_references: ("ref_001",),
    payment_references: ("ref_002",),
    refund_references: ("ref_003",),
    shipment_references: ("ref_004",),
    raw_inventory_profile: ("fin_001",),
    refunds_profile: ("fin_002",),
    reconciliation_profile: ("fin_003", "fin_004"),
    repeated_payments_profile: ("fin_005",),
    payouts_profile: ("fin_006",),
    daily_volume_profile: ("comp_004",),
}
# The profiles that read the order items, and what they need of them.
ITEM_PROFILES = (item_references, payouts_profile)
ITEM_COLUMNS = ("order_item_id", "order_id", "quantity", "discount", "cost", "revenue")
# Tables more than one profile reads; worth writing once before a full run.
JOBS_AT_A_TIME = 4
SHARED_TABLES = ("stg_orders", "stg_payments", "stg_refunds", "clean_order_items")

COUNTS = {"check_id": "string", "checked": "long", "failed": "long", "detail": "string", "error": "string"}


def _definitions(spark: SparkSession) -> DataFrame:
    rows = [(i, c.check_id, c.check_name, c.dataset, c.severity, c.text) for i, c in enumerate(CHECKS)]
    names = ("check_id", "check_name", "dataset", "severity", "text")
    return values_table(spark, rows, {"position": "int", **dict.fromkeys(names, "string")})


def verdicts(counts: DataFrame) -> DataFrame:
    """Counts per check to the result table. An INFO check that finds something is a FAIL, as defined."""
    checked, failed, error = F.col("checked"), F.col("failed"), F.col("error")
    status = (
        F.when(error.isNotNull(), "ERROR")
        .when(checked == 0, "SKIPPED")
        .when(failed == 0, "PASS")
        .when(F.col("severity") == "WARNING", "WARN")
        .otherwise("FAIL")
    )
    message = F.when(error.isNotNull(), F.concat(F.lit("Check raised exception: "), error)).otherwise(
        F.concat(F.format_number("failed", 0), F.lit(" "), "text", "detail")
    )
    pass_rate = F.when(checked == 0, 1.0).otherwise(1.0 - failed.cast("double") / checked)
    return (
        F.broadcast(_definitions(counts.sparkSession))
        .join(counts, "check_id")
        .select(
            "position",
            "check_id",
            "check_name",
            "dataset",
            "severity",
            status.alias("status"),
            checked.alias("records_checked"),
            failed.alias("records_failed"),
            F.round(pass_rate, 4).alias("pass_rate"),
            message.alias("message"),
        )
    )


def error_rows(spark: SparkSession, ids: tuple[str, ...], error: Exception) -> DataFrame:
    text = str(error).splitlines()[0] if str(error) else type(error).__name__
    return values_table(spark, [(i, 0, 0, "", text) for i in ids], COUNTS)


def _counted(warehouse, profile: Callable[..., DataFrame], wanted: tuple[str, ...], collect: bool) -> DataFrame:
    """The wanted counts of one profile; one that can't be planned, or run where it is collected, turns into ERROR rows."""
    try:
        part = warehouse.run(profile).where(F.col("check_id").isin(*wanted))
        part = part.withColumn("error", F.lit(None).cast("string"))
        return values_table(warehouse.spark, part.collect(), COUNTS) if collect else part
    except Exception as error:  # any failure of a check is a result, not the end of the run
        return error_rows(warehouse.spark, wanted, error)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


Asked = dict[Callable[..., DataFrame], tuple[str, ...]]


def _steps(warehouse, asked: Asked) -> Iterator[tuple]:
    """The profiles that run as one plan, and the warehouse they read.

    Small tables are one step. The shuffles of a plan stay on disk until its end, so profiles of large order items run
    after the others, one by one and on items that are written before.
    """
    heavy = {p: asked[p] for p in ITEM_PROFILES if p in asked}
    try:
        given = warehouse.given("clean_order_items") is not None
        cuts = 1 if given or len(heavy) < 2 else slices(warehouse["raw_order_items"])
    except Exception:  # the checks that read this table report it
        cuts = 1
    if cuts == 1:
        yield warehouse, asked
        return
    yield warehouse, {p: wanted for p, wanted in asked.items() if p not in heavy}
    made = warehouse.copy()
    try:
        folder = shared_folder(warehouse.spark, "checked-items")
        made.materialise_sliced("clean_order_items", "order_item_id", cuts, folder, ITEM_COLUMNS)
    except Exception:  # as above
        log.warning("order items could not be written for their checks", exc_info=True)
    for profile, wanted in heavy.items():
        yield made, {profile: wanted}


def check_counts(warehouse, ids: tuple[str, ...] | None = None, isolate: bool = True) -> DataFrame:
    """Counts of the wanted checks.

    All profiles are one plan, which reads each table as seldom as it can; with ``isolate`` those of large order items
    are plans of their own. A profile that cannot be planned, for instance because its table is missing, turns into ERROR
    rows. With ``isolate`` plans are run here, and if one fails each of its profiles is run as a job of its own, some at
    a time, so that only those that fail turn into ERROR rows. Two rows for each profile at most reach the driver.
    """
    spark = warehouse.spark
    wanted = {p: tuple(i for i in answers if ids is None or i in ids) for p, answers in PROFILES.items()}
    asked = {p: some for p, some in wanted.items() if some}
    if not isolate:
        return _union([_counted(warehouse, *item, False) for item in asked.items()])
    rows: list = []
    for source, some in _steps(warehouse, asked):
        with freed(spark):
            try:
                rows += _union([_counted(source, *item, False) for item in some.items()]).collect()
                continue
            except Exception:  # some profile failed at run time; below each runs alone
                log.warning("the checks failed as a whole and run one by one", exc_info=True)
            with ThreadPoolExecutor(JOBS_AT_A_TIME) as pool:
                parts = list(pool.map(lambda item: _counted(source, *item, True), some.items()))
            rows += _union(parts).collect()
    return values_table(spark, rows, COUNTS)


def run(warehouse, folder: str | None = None, isolate: bool = True) -> DataFrame:
    """All checks. With ``folder`` the tables several checks share are written there once and read back."""
    for name in SHARED_TABLES if folder is not None else ():
        try:
            warehouse.materialise((name,), folder)
        except Exception as error:  # the checks that read this table report it
            if not isolate:
                raise error
    return verdicts(check_counts(warehouse, isolate=isolate))


def run_one(check_id: str) -> Callable[..., DataFrame]:
    return lambda warehouse: verdicts(check_counts(warehouse, (check_id,))).drop("position")


def broken_table(warehouse) -> DataFrame:
    """The verdicts while the customers can be planned but not read."""
    broken = warehouse.copy()
    customers = warehouse["stg_customers"]
    gone = F.raise_error(F.lit("customers are gone")).cast("string")
    broken.replace("stg_customers", customers.withColumn("email", F.coalesce(gone, "email")))
    return run(broken, shared_folder(warehouse.spark, "staged")).select("check_id", "status")


@cache
def checked(warehouse) -> DataFrame:
    """All checks; failures at run time are contained. One run serves the results, the summary, the gate and the report."""
    return run(warehouse)


def results(warehouse) -> DataFrame:
    return checked(warehouse).drop("position")


def _figures() -> list[Column]:
    def having(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    critical = F.col("status").isin("FAIL", "ERROR") & (F.col("severity") == "CRITICAL")
    return [
        F.count("*").alias("total_checks"),
        having("PASS").alias("passed"),
        having("WARN").alias("warned"),
        having("FAIL").alias("failed"),
        having("ERROR").alias("errored"),
        F.count_if(critical).alias("critical_issues"),
    ]


def summary(table: DataFrame) -> DataFrame:
    return table.agg(*_figures())


def gate(table: DataFrame) -> DataFrame:
    return summary(table).select("critical_issues", (F.col("critical_issues") > 0).alias("blocked"))


def enforce(table: DataFrame) -> None:
    row = gate(table).first()
    if row.blocked:
        raise QualityGateError(f"{row.critical_issues} critical checks failed")


def report(table: DataFrame, run_at: str) -> DataFrame:
    """The run as one nested row: the summary figures and the list of checks in order."""
    fields = [c for c in table.columns if c != "position"]
    in_order = F.array_sort(F.collect_list(F.struct("position", F.struct(*fields).alias("check"))))
    whole = table.agg(F.lit(run_at).alias("run_at"), *_figures(), in_order.alias("_checks"))
    return whole.withColumn("checks", F.col("_checks.check")).drop("_checks")


# -- schema tests -------------------------------------------------------------------------------------------

# Columns that must not be null in the raw tables, and the one that must be unique.
NOT_NULL = {
    "raw_customers": ("customer_id", "email"),
    "raw_products": ("product_id", "list_price"),
    "raw_orders": ("order_id", "customer_id", "order_date"),
    "raw_order_items": ("order_item_id", "order_id", "product_id"),
    "raw_payments": ("payment_id", "order_id"),
    "raw_refunds": ("refund_id",),
    "raw_inventory": ("inventory_id",),
    "raw_shipments": ("shipment_id", "order_id"),
    "raw_ad_spend": ("ad_record_id",),
    "raw_payouts": ("payout_id",),
}
WARN_ONLY = {("raw_customers", "email")}
UNIQUE = {"raw_products": "product_id"}


def _test_row(table: str, column: str, kind: str, failures: Column) -> Column:
    bad = "warn" if (table, column) in WARN_ONLY else "fail"
    return F.struct(
        F.lit(f"{kind}_{table}_{column}").alias("test_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        failures.cast("long").alias("failures"),
        F.when(failures == 0, "pass").otherwise(bad).alias("status"),
    )


def not_null(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[_test_row(table, c, "not_null", F.col(c)) for c in columns])))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return repeated.agg(F.count("*").alias("n")).select(F.inline(F.array(_test_row(table, column, "unique", F.col("n")))))


def not_null_tests(warehouse) -> DataFrame:
    whole = None
    for table, columns in NOT_NULL.items():
        part = not_null(warehouse[table], table, columns)
        whole = part if whole is None else whole.unionByName(part)
    return whole


def unique_tests(warehouse) -> DataFrame:
    (table, column), = UNIQUE.items()
    return unique(warehouse[table], table, column)


def written_report(warehouse) -> DataFrame:
    """Write the report as JSON and read it back, one row per check with the figures of the run beside it."""
    folder = shared_folder(warehouse.spark, "dq-report")
    made = report(checked(warehouse), "run")
    made.write.json(folder)
    return warehouse.spark.read.schema(made.schema).json(folder).select("*", F.inline("checks")).drop("checks")


QUERIES = {
    "dq_results": results,
    "dq_summary": lambda warehouse: summary(checked(warehouse)),
    "dq_broken_table": broken_table,
    "dq_gate": lambda warehouse: gate(checked(warehouse)),
    "dq_report": written_report,
    "dq_not_null_tests": not_null_tests,
    "dq_unique_products": unique_tests,
    **{f"dq_{c.check_id}": run_one(c.check_id) for c in CHECKS},
}
