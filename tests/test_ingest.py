from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from conftest import TESTDATA, by_key
from pyspark.sql import functions as F

from ledgerline.plans import jobs
from ledgerline.plans.warehouse import Warehouse
from ledgerline.sources import ingest
from ledgerline.sources.fixtures import FixtureSource
from ledgerline.sources.ingest import RawLayer

NOW = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def source(spark):
    return FixtureSource(spark, TESTDATA)


def test_incremental_reads_filter_in_the_scan(source):
    start = date(1999, 1, 1)
    df = ingest.since(source.feed("orders"), "orders", start)
    assert df.agg(F.min("order_date")).first()[0] >= start
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in (
        df._jdf.queryExecution().executedPlan().toString()
    )


@pytest.mark.parametrize("entity", ["products", "order_items"])
def test_two_entities_are_always_read_whole(source, entity):
    assert ingest.since(source.feed(entity), entity, date(2030, 1, 1)).count() == source.feed(entity).count()


def test_metadata(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "x", "y")], "b int, a string, c string")
    first = ingest.with_metadata(df, "things", "B1", NOW).collect()
    later = ingest.with_metadata(df.select("c", "a", "b"), "things", "B2", datetime(2025, 1, 1)).collect()
    assert first[0]._source == "mock/things" and first[0]._batch_id == "B1"
    # The hash depends on the business columns by name and on nothing else.
    assert [r._record_hash for r in first] == [r._record_hash for r in later]
    assert first[0]._record_hash != first[1]._record_hash
    assert ingest.batch_id(NOW) == "20240501T000000Z"


def test_missing_file(spark, tmp_path):
    with pytest.raises(ingest.ConnectorError):
        ingest.FileFeed(spark, str(tmp_path)).feed("orders")


def test_append_reload_and_counts(spark, source, tmp_path):
    layer = RawLayer(spark, str(tmp_path))
    made = source.feed("payouts")
    n = made.count()
    assert layer.count("raw_payouts") == 0
    assert layer.load(made, "raw_payouts") == n
    assert layer.load(made, "raw_payouts") == n
    assert layer.count("raw_payouts") == 2 * n
    assert layer.load(made, "raw_payouts", replace=True) == n
    assert layer.count("raw_payouts") == n


class Flaky:
    def __init__(self, source):
        self.source = source

    def feed(self, entity):
        if entity == "refunds":
            raise ingest.ConnectorError("refunds are down")
        return self.source.feed(entity)


def test_pipeline(spark, source, tmp_path):
    layer = RawLayer(spark, str(tmp_path))
    connectors = (
        ("payments", ("payments", "refunds")),
        ("google_ads", ("advertising",)),
        ("meta_ads", ("advertising",)),
        ("inventory", ("inventory",)),
    )
    outcome = ingest.run_pipeline(Flaky(source), layer, connectors=connectors, disabled=("inventory",))
    assert [(r.entity, r.status) for r in outcome.collect()] == [
        ("payments", "loaded"), ("refunds", "failed"), ("advertising", "loaded"), ("advertising", "loaded"),
    ]
    totals = by_key(ingest.totals(outcome), "entity")
    ads = source.feed("advertising").count()
    assert totals["advertising"].rows_loaded == layer.count("raw_ad_spend") == 2 * ads
    # Staging removes the second copy of every ad row.
    staged = Warehouse(spark, layer)["stg_ad_spend"]
    assert staged.count() == staged.select("ad_record_id").distinct().count() <= ads
    # A second full run starts the tables anew.
    ingest.run_pipeline(source, layer, connectors=connectors[1:3])
    assert layer.count("raw_ad_spend") == 2 * ads


def test_datasets_are_written_unless_empty(spark, source, tmp_path):
    products = source.feed("products")
    for kind in ("parquet", "csv"):
        paths = ingest.write_datasets({"products": products, "none": products.limit(0)}, str(tmp_path), kind)
        assert list(paths) == ["products"]
    back = spark.read.schema(products.schema).option("header", True).csv(paths["products"])
    assert sorted(map(str, back.collect())) == sorted(map(str, products.collect()))


def test_failed_reload_leaves_the_table(spark, source, tmp_path):
    layer = RawLayer(spark, str(tmp_path))
    made = source.feed("payouts")
    n = layer.load(made, "raw_payouts")
    broken = made.withColumn("platform", F.raise_error(F.lit("feed broke off")).cast("string"))
    with pytest.raises(Exception, match="feed broke off"):
        layer.load(broken, "raw_payouts", replace=True)
    assert layer.count("raw_payouts") == n
    assert layer.load(made.limit(3), "raw_payouts", replace=True) == 3 == layer.count("raw_payouts")


def test_a_failed_entity_is_no_result(spark, source, tmp_path):
    """The others are loaded, and then the run fails unless its caller looks at the rows."""
    layer = RawLayer(spark, str(tmp_path))
    with pytest.raises(ingest.LoadFailed, match="payments.refunds") as failed:
        ingest.run_connector(Flaky(source), "payments", ("refunds", "payouts"), layer)
    assert isinstance(failed.value.__cause__, ingest.ConnectorError)
    assert layer.count("raw_payouts") == source.feed("payouts").count() and not layer.exists("raw_refunds")
    outcome = ingest.run_connector(Flaky(source), "payments", ("refunds",), layer, report_failures=True)
    assert outcome == [("payments", "refunds", "raw_refunds", 0, "failed")]
    whole = ingest.run_pipeline(source, layer, connectors=(("payments", ("payouts",)),))
    assert ingest.complete(whole) is whole
    part = ingest.run_pipeline(Flaky(source), layer, connectors=(("payments", ("payouts", "refunds")),))
    with pytest.raises(ingest.LoadFailed, match="payments.refunds"):
        ingest.complete(part)


class BreaksOff(FixtureSource):
    """Delivers a feed once; the second time some of its rows can't be read."""

    def __init__(self, spark, folder, entity):
        super().__init__(spark, folder)
        self.entity, self.given = entity, 0

    def feed(self, entity):
        rows = super().feed(entity)
        if entity == self.entity:
            self.given += 1
            if self.given > 1:
                column = rows.columns[-1]
                rows = rows.withColumn(column, F.raise_error(F.lit("feed broke off")).cast(rows.schema[column].dataType))
        return rows


@pytest.mark.parametrize("query, entity", [("inc_mart_finance", "payouts"), ("inc_mart_sales", "refunds")])
def test_marts_are_not_made_of_what_an_earlier_load_left(spark, query, entity):
    warehouse = Warehouse(spark, BreaksOff(spark, TESTDATA, entity))
    with pytest.raises(ingest.LoadFailed, match=f"all.{entity}"):
        jobs.QUERIES[query](warehouse)


def test_totals_are_of_a_whole_run(spark):
    feeds = BreaksOff(spark, TESTDATA, "advertising")
    with pytest.raises(ingest.LoadFailed, match="meta_ads.advertising"):
        jobs.pipeline_totals(Warehouse(spark, feeds))
