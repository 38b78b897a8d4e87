"""Staged and fact tables written with the quality checks' figures observed on the way.

Every check is answered by the job that writes its table, so that the gate opens or closes without reading anything
again. Only the daily volumes, one row per day, are looked at twice, since their limit is their own mean.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerline.functions.literals import values_table
from ledgerline.functions.observed import figures
from ledgerline.operators.joins import lookup
from ledgerline.plans import quality
from ledgerline.plans.quality import COUNTS, error_rows, verdicts
from ledgerline.session import CODEC, freed, shared_folder

log = logging.getLogger(__name__)

Figures = dict[str, int]
Answer = tuple[int, int, str]  # checked, failed, detail


def _again(df: DataFrame, key: str) -> DataFrame:
    """``_again`` marks rows whose key an earlier row has; after a dedup by that key this moves nothing."""
    order = Window.partitionBy(key).orderBy(key)
    return df.withColumn("_again", F.row_number().over(order) > 1)


def _with_known(warehouse, df: DataFrame, row_id: str, raw: str) -> DataFrame:
    """``_known`` is null where the order a row names does not exist."""
    orders = warehouse["stg_orders"].select("order_id", F.lit(True).alias("_known"))
    return lookup(df, orders, "order_id", "left", row_id=row_id, profile=warehouse[raw]).select(*df.columns, "_known")


def _orphans() -> Column:
    return F.count_if(F.col("_known").isNull() & F.col("order_id").isNotNull())


class CheckedLoad:
    """Writes the tables of a warehouse below ``folder`` and keeps what the checks need to know of them.

    A table that can't be written turns its checks into ERROR rows; the tables that depend on it are then worked out from
    what it would have held, and so fail or not by themselves.
    """

    def __init__(self, warehouse, folder: str) -> None:
        self.warehouse, self.folder = warehouse.copy(), folder.rstrip("/")
        self.answers: dict[str, Answer] = {}
        self.errors: list[DataFrame] = []

    def run(self) -> DataFrame:
        """Write all tables and return the result table of the checks, which holds no reference to them."""
        for step, checks in STEPS.items():
            try:
                found = step(self)
                self.answers |= {check: (*found[check][:2], found[check][2] if len(found[check]) > 2 else "") for check in checks}
            except Exception as error:  # any failure of a table is a result, not the end of the run
                log.warning("%s failed", step.__name__, exc_info=True)
                self.errors.append(error_rows(self.warehouse.spark, checks, error))
        spark = self.warehouse.spark
        rows = [(check, n or 0, bad or 0, detail, None) for check, (n, bad, detail) in self.answers.items()]
        counts = values_table(spark, rows, COUNTS)
        for part in self.errors:
            counts = counts.unionByName(part)
        return verdicts(counts)

    def write(self, name: str, df: DataFrame, **wanted: Column) -> Figures:
        """Write ``df`` without its helper columns and return its rows and the ``wanted`` figures."""
        seen = Observation(f"load_{name}")
        aggregates = [F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in wanted.items()]]
        kept = [c for c in df.columns if not c.startswith("_") or c in ("_ingested_at", "_source", "_batch_id")]
        path = f"{self.folder}/{name}"
        with freed(self.warehouse.spark):
            df.observe(seen, *aggregates).select(*kept).write.mode("overwrite").parquet(path, compression=CODEC)
        written = self.warehouse.spark.read.schema(df.select(*kept).schema).parquet(path)
        self.warehouse.replace(name, written)
        return {"n": 0, **dict.fromkeys(wanted, 0)} | figures(seen, lambda: written)


def orders(load: CheckedLoad) -> dict:
    table = _again(load.warehouse["stg_orders"], "order_id")
    seen = load.write("stg_orders", table, again=F.count_if("_again"), unknown=F.count_if(F.col("order_status") == "unknown"))
    return {"uniq_001": (seen["n"], seen["again"]), "comp_003": (seen["n"], seen["unknown"])}


def customers(load: CheckedLoad) -> dict:
    table = _again(load.warehouse["stg_customers"], "customer_id")
    seen = load.write("stg_customers", table, again=F.count_if("_again"), bare=F.count_if(F.col("email").isNull()))
    return {"uniq_002": (seen["n"], seen["again"]), "comp_001": (seen["n"], seen["bare"])}


def products(load: CheckedLoad) -> dict:
    table = _again(load.warehouse["stg_products"], "product_id")
    bare = F.col("sku").isNull() | (F.trim("sku") == "")
    seen = load.write("stg_products", table, again=F.count_if("_again"), bare=F.count_if(bare))
    return {"uniq_004": (seen["n"], seen["again"]), "comp_002": (seen["n"], seen["bare"])}


def payments(load: CheckedLoad) -> dict:
    # Repeats are marked first, while the rows are still where the dedup left them.
    table = _with_known(load.warehouse, _again(load.warehouse["stg_payments"], "payment_id"), "payment_id", "raw_payments")
    seen = load.write("stg_payments", table, again=F.count_if("_again"), orphans=_orphans())
    return {"uniq_003": (seen["n"], seen["again"]), "ref_002": (seen["n"], seen["orphans"])}


def order_items(load: CheckedLoad) -> dict:
    # One join removes the orphans and would show any that is left.
    items = _with_known(load.warehouse, load.warehouse["clean_order_items"], "order_item_id", "raw_order_items")
    seen = load.write("stg_order_items", items.where("_known"), orphans=_orphans())
    load.warehouse.replace("clean_order_items", load.warehouse["stg_order_items"])
    return {"ref_001": (seen["n"], seen["orphans"])}


def refunds(load: CheckedLoad) -> dict:
    table = _with_known(load.warehouse, load.warehouse["stg_refunds"], "refund_id", "raw_refunds")
    seen = load.write("stg_refunds", table, orphans=_orphans())
    return {"ref_003": (seen["n"], seen["orphans"])}


def shipments(load: CheckedLoad) -> dict:
    table = _with_known(load.warehouse, load.warehouse["stg_shipments"], "shipment_id", "raw_shipments")
    seen = load.write("stg_shipments", table, orphans=_orphans())
    return {"ref_004": (seen["n"], seen["orphans"])}


def inventory(load: CheckedLoad) -> dict:
    # The quantities are observed as delivered, before staging lifts them to zero.
    seen = Observation("load_raw_inventory")
    raw = load.warehouse["raw_inventory"]
    negative = F.count_if(F.col("closing_qty") < 0).alias("negative")
    watched = load.warehouse.copy()
    watched.replace("raw_inventory", raw.observe(seen, F.count(F.lit(1)).alias("n"), negative))
    load.write("stg_inventory", watched["stg_inventory"])
    found = {"n": 0, "negative": 0} | figures(seen, lambda: raw)
    return {"fin_001": (found["n"], found["negative"])}


def payments_per_order(load: CheckedLoad) -> dict:
    table, paid = load.warehouse["completed_payments"], F.col("order_id").isNotNull()
    completed = F.col("completed_count")
    seen = load.write(
        "completed_payments", table, orders=F.count_if(paid & (completed > 0)), repeated=F.count_if(paid & (completed > 1))
    )
    return {"fin_005": (seen["orders"], seen["repeated"])}


def refund_facts(load: CheckedLoad) -> dict:
    seen = load.write("fct_refunds", load.warehouse["fct_refunds"], over=F.count_if("is_over_refund"))
    return {"fin_002": (seen["n"], seen["over"])}


def payment_facts(load: CheckedLoad) -> dict:
    verdict = F.col("reconciliation_status")
    seen = load.write(
        "fct_payments",
        load.warehouse["fct_payments"],
        exceptions=F.count_if(verdict == "EXCEPTION"),
        warnings=F.count_if(verdict == "WARNING"),
    )
    return {"fin_003": (seen["n"], seen["exceptions"]), "fin_004": (seen["n"], seen["warnings"])}


def payout_facts(load: CheckedLoad) -> dict:
    verdict = F.col("reconciliation_status")
    seen = load.write("fct_payouts", load.warehouse["fct_payouts"], exceptions=F.count_if(verdict == "EXCEPTION"))
    return {"fin_006": (seen["n"], seen["exceptions"])}


def daily_volumes(load: CheckedLoad) -> dict:
    """The orders of each day, as a table; the days below the mean are counted in it."""
    days = load.warehouse["stg_orders"].groupBy("order_date").agg(F.count("*").alias("orders"))
    seen = load.write("daily_orders", days, mean=F.avg("orders"))
    mean = seen["mean"] or 0.0
    limit = mean * float(load.warehouse.settings.low_volume_share)
    written = load.warehouse["daily_orders"]
    return {"comp_004": (seen["n"], written.where(F.col("orders") < F.lit(limit)).count(), f" ({mean:.0f})")}


# In the order in which tables feed each other, with the checks each answers.
STEPS: dict[Callable[[CheckedLoad], dict], tuple[str, ...]] = {
    orders: ("uniq_001", "comp_003"),
    customers: ("uniq_002", "comp_001"),
    products: ("uniq_004", "comp_002"),
    payments: ("uniq_003", "ref_002"),
    order_items: ("ref_001",),
    refunds: ("ref_003",),
    shipments: ("ref_004",),
    inventory: ("fin_001",),
    payments_per_order: ("fin_005",),
    refund_facts: ("fin_002",),
    payment_facts: ("fin_003", "fin_004"),
    payout_facts: ("fin_006",),
    daily_volumes: ("comp_004",),
}


def checked_load(warehouse) -> DataFrame:
    return CheckedLoad(warehouse, shared_folder(warehouse.spark, "checked")).run().drop("position")


QUERIES = {"dq_at_load": checked_load, "dq_gate_at_load": lambda warehouse: quality.gate(checked_load(warehouse))}
