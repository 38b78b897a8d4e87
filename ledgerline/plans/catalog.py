"""All registered queries and the SQL they are compared with, collected from the feature modules."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerline.functions.columns import present
from ledgerline.oracle import analysis as analysis_sql
from ledgerline.oracle import cubes as cubes_sql
from ledgerline.oracle import jobs as jobs_sql
from ledgerline.oracle import metrics as metrics_sql
from ledgerline.oracle import quality as quality_sql
from ledgerline.oracle import reports as reports_sql
from ledgerline.oracle.build import table_query
from ledgerline.oracle.tables import OUTPUT
from ledgerline.plans import analysis, cubes, jobs, loading, metrics, quality, reports, screening
from ledgerline.plans.warehouse import LAYERS, Warehouse
from ledgerline.settings import Settings
from ledgerline.sources.fixtures import FixtureSource

# Orders in the test tables run from 1995 to August 2001, events are of January 2024.
TEST_SETTINGS = Settings().but(
    spine_start=date(1995, 1, 1),
    spine_end=date(2024, 12, 31),
    as_of=date(2001, 8, 31),
    active_since=date(2001, 6, 1),
    lapsing_since=date(2000, 9, 1),
)

Query = Callable[[SparkSession, str], DataFrame]
Model = Callable[..., DataFrame]
# The static tables hold no data of their own; the queries of that name show them with the facts they describe.
STATIC = ("dim_date", "dim_channel", "dim_warehouse")

_open: dict[tuple[str, str], Warehouse] = {}


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over a folder of test tables; plans are built once per application and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = Warehouse(spark, FixtureSource(spark, folder), TEST_SETTINGS)
    return _open[key]


def _table(name: str) -> Model:
    return lambda warehouse: warehouse[name]


def models() -> dict[str, Model]:
    return {
        **{n: _table(n) for layer in LAYERS.values() for n in layer if n not in STATIC},
        **analysis.QUERIES,
        **quality.QUERIES,
        **loading.QUERIES,
        **metrics.QUERIES,
        **reports.QUERIES,
        **cubes.QUERIES,
        **screening.QUERIES,
        **jobs.QUERIES,
    }


def queries() -> dict[str, Query]:
    def bind(model: Model) -> Query:
        return lambda spark, folder: present(open_warehouse(spark, folder).run(model))

    return {name: bind(model) for name, model in models().items()}


def oracle_sql() -> dict[str, str]:
    parts = (analysis_sql, quality_sql, metrics_sql, reports_sql, cubes_sql, jobs_sql)
    return {n: table_query(n) for n in OUTPUT} | {n: sql for part in parts for n, sql in part.SQL.items()}
