"""Checks whose figures are observed while the tables are written."""

from __future__ import annotations

import re
from datetime import date

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from ledgerline.plans import analysis, catalog, loading, quality
from ledgerline.plans.loading import CheckedLoad
from ledgerline.plans.warehouse import LAYERS


def rows(table):
    return {r["check_id"]: tuple(r) for r in table.drop("position").collect()}


def test_figures_are_those_of_the_checks(spark, tmp_path):
    warehouse = catalog.open_warehouse(spark, TESTDATA)
    load = CheckedLoad(warehouse, str(tmp_path))
    found = load.run()
    assert rows(found) == rows(quality.run(warehouse))
    assert set(loading.STEPS.values()) and sorted(c for checks in loading.STEPS.values() for c in checks) == sorted(quality.BY_ID)
    # The gate reads nothing, and every table is what its model says, without helper columns.
    plan = quality.gate(found)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan
    for name in ("stg_orders", "stg_order_items", "stg_payments", "stg_inventory", "completed_payments", "fct_payments", "fct_payouts"):
        written = spark.read.parquet(f"{tmp_path}/{name}")
        assert written.columns == warehouse[name].columns
        assert written.exceptAll(warehouse[name]).count() == 0 == warehouse[name].exceptAll(written).count()


def test_what_each_check_finds(small, tmp_path):
    """One feed with a finding for nearly every check."""
    orders = [dict(order_id=f"O{i}", order_date=date(2024, 1, 1 + i % 3)) for i in range(8)] + [
        dict(order_id="O9", order_status="weird", order_date=date(2024, 1, 9))
    ]
    warehouse = small(
        orders=orders,
        customers=[{}, {}],
        products=[dict(product_id="P1"), dict(product_id="P1"), dict(sku=" ")],
        order_items=[dict(order_id="O1"), dict(order_id="none")],
        payments=[dict(order_id="O1"), dict(order_id="O1"), dict(order_id="gone"), dict(order_id=None), dict(order_id="O2", amount=50.0)],
        refunds=[dict(order_id="O1", amount=500.0), dict(order_id="gone")],
        shipments=[dict(order_id="O1"), dict(order_id="gone")],
        inventory=[dict(closing_qty=-3), dict(closing_qty=5)],
        payouts=[{}],
    )
    found = rows(CheckedLoad(warehouse, str(tmp_path)).run())
    assert found == rows(quality.run(warehouse))
    failed = {check: row[6] for check, row in found.items()}
    assert {c: failed[c] for c in ("uniq_004", "comp_002", "ref_001", "ref_002", "ref_003", "ref_004", "fin_001", "fin_002", "fin_005", "comp_003")} == {
        "uniq_004": 1, "comp_002": 1, "ref_001": 0, "ref_002": 1, "ref_003": 1, "ref_004": 1, "fin_001": 1, "fin_002": 1, "fin_005": 1, "comp_003": 1,
    }


def test_empty_feeds(small, tmp_path):
    warehouse = small()
    found = rows(CheckedLoad(warehouse, str(tmp_path)).run())
    assert found == rows(quality.run(warehouse)) and {r[4] for r in found.values()} == {"SKIPPED"}


@pytest.mark.parametrize("broken, errors", [("stg_customers", {"uniq_002", "comp_001"}), ("raw_inventory", {"fin_001"})])
def test_a_table_that_cannot_be_written(spark, tmp_path, broken, errors):
    warehouse = catalog.open_warehouse(spark, TESTDATA).copy()
    table = warehouse[broken]
    column = table.columns[0]
    gone = F.raise_error(F.lit("gone")).cast(table.schema[column].dataType)
    warehouse.replace(broken, table.withColumn(column, F.coalesce(gone, column)))
    found = rows(CheckedLoad(warehouse, str(tmp_path)).run())
    assert {check for check, row in found.items() if row[4] == "ERROR"} == errors
    assert len(found) == 18


def test_counts_of_written_tables_read_no_column(spark):
    counts = analysis.written_counts(catalog.open_warehouse(spark, TESTDATA))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (\S+)", plan)
    assert len(schemas) == len(LAYERS["marts"]) and set(schemas) == {"struct<>"}
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in catalog.queries()["val_row_counts"](spark, TESTDATA).collect()}
