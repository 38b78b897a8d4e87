"""Registered queries against DuckDB on the smallest test set, and the shape of their plans."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import TESTDATA

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import compare  # noqa: E402

import __spark_entry__ as registered  # noqa: E402
from ledgerline.plans import catalog  # noqa: E402

QUERIES = catalog.queries()
# One or two queries per area by default; LEDGERLINE_ALL_QUERIES=1 takes every one.
SOME = (
    "stg_order_items int_order_revenue int_product_sales fct_order_items fct_refunds mart_customer mart_finance "
    "an_refund_analysis val_orphan_records ask_top_products_by_margin dq_results met_by_month_and_channel "
    "ti_compare_months rpt_category_margin_matrix rpt_order_detail ai_screened_sql src_incremental_counts "
    "src_csv_products inj_payments wh_accepted"
).split()
CHOSEN = sorted(QUERIES) if os.environ.get("LEDGERLINE_ALL_QUERIES") else SOME
# Planning these runs jobs.
EAGER = ("wh_accepted", "wh_rejected", "wh_ids", "src_pipeline", "src_loaded", "src_materialised", "src_csv", "src_reload", "dq_")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in compare.TABLES:
        con.execute(f"create view {name} as select * from '{TESTDATA}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(registered.queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_duckdb(spark, duck, name):
    verdict, _, _ = compare.compare(spark, duck, name, TESTDATA)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in CHOSEN if not n.startswith(EAGER)])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "ExistingRDD"):
        assert node not in plan


def test_scans_read_only_what_the_mart_needs(spark):
    plan = QUERIES["mart_sales"](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    items = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    for unused in ("l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in items
    assert "WindowGroupLimit" in plan  # dedup thins out repeated keys before the exchange


def test_every_line_item_is_used(spark):
    """No line is taken for another; only planned orphans and lines of orders that staging drops are missing."""
    warehouse = catalog.open_warehouse(spark, TESTDATA)
    parts = warehouse.source.table("part").selectExpr("p_partkey as l_partkey")
    same_line = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = warehouse.source.table("lineitem").join(parts, "l_partkey").dropDuplicates(same_line)
    sent = warehouse.source.raw("order_items").dropDuplicates(["order_item_id", "_batch_id"])
    assert sent.where("_batch_id = 1").count() == lines.count() > 5900
    assert sent.where("_batch_id = 2").count() == lines.where("l_orderkey % 90 = 4").count() > 0
    orphans = lines.where("(l_orderkey * 7 + l_partkey) % 300 = 5").count()
    invalid = sent.where("_batch_id = 1 and (quantity <= 0 or unit_price <= 0)").count()
    staged = warehouse["stg_orders"].select("order_id")
    homeless = sent.where("_batch_id = 1 and order_id <> -1").join(staged, "order_id", "left_anti").count()
    assert warehouse["stg_order_items"].count() == lines.count() - orphans - invalid - homeless


@pytest.mark.parametrize("name, column", [("mart_marketing", "approx_cac"), ("rpt_cac_trend", "cac"), ("met_cac", "cac"),
    ("int_payment_reconciliation", "has_duplicate_payment"), ("fct_payments", "is_duplicate"), ("fct_orders", "has_multiple_refunds"),
    ("fct_orders", "tax"), ("fct_orders", "order_discount"), ("ai_screened_questions", "is_blocked"), ("ai_screened_questions", "metrics")])
def test_columns_say_something(spark, name, column):
    found = QUERIES[name](spark, TESTDATA)
    assert column in found.columns, found.columns
    assert found.where(f"{column} is not null").select(column).distinct().count() > 1
