"""Ingestion: feeds to raw tables, with metadata, incremental reads and a status per entity."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerline.functions.columns import record_hash
from ledgerline.session import sized
from ledgerline.sources.layer import RawLayer
from ledgerline.sources.schemas import RAW_SCHEMAS

log = logging.getLogger(__name__)


class ConnectorError(Exception):
    """A source cannot deliver an entity."""


class LoadFailed(RuntimeError):
    """Entities of a run are not loaded; those not named are."""

    def __init__(self, failed: Sequence[str]) -> None:
        super().__init__(f"not loaded: {', '.join(failed)}")


@dataclass(frozen=True)
class Entity:
    name: str
    table: str
    since_column: str | None


# Target tables and the columns incremental reads filter on; two entities are always read whole.
ENTITIES = {
    e.name: e
    for e in (
        Entity("customers", "raw_customers", "signup_date"),
        Entity("products", "raw_products", None),
        Entity("orders", "raw_orders", "order_date"),
        Entity("order_items", "raw_order_items", None),
        Entity("payments", "raw_payments", "payment_date"),
        Entity("refunds", "raw_refunds", "refund_date"),
        Entity("inventory", "raw_inventory", "date"),
        Entity("shipments", "raw_shipments", "shipped_date"),
        Entity("advertising", "raw_ad_spend", "date"),
        Entity("payouts", "raw_payouts", "payout_date"),
    )
}
METADATA = ("_ingested_at", "_source", "_batch_id", "_record_hash")

# The connectors of a run and the entities each delivers. Both ad providers fill the same table.
CONNECTORS = (
    ("commerce", ("customers", "products", "orders", "order_items")),
    ("payments", ("payments", "refunds")),
    ("google_ads", ("advertising",)),
    ("meta_ads", ("advertising",)),
    ("inventory", ("inventory",)),
    ("fulfillment", ("shipments", "payouts")),
)


class FileFeed:
    """Entities as Parquet files ``<folder>/<entity>.parquet`` with a declared schema."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def feed(self, entity: str) -> DataFrame:
        return scan(self.spark, f"{self.folder}/{entity}.parquet", RAW_SCHEMAS[entity])


def scan(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet scan with a declared schema, without a job to infer one."""
    try:
        return sized(spark.read.schema(schema).parquet(path))
    except AnalysisException as error:
        raise ConnectorError(f"no data at {path}") from error


def since(df: DataFrame, entity: str, start: date | None) -> DataFrame:
    """Rows from ``start`` on, by the entity's own date; a plain filter that reaches the scan."""
    column = ENTITIES[entity].since_column
    if start is None or column is None or column not in df.columns:
        return df
    return df.where(F.col(column) >= F.lit(start))


def dated_by(entity: str, df: DataFrame) -> str | None:
    """The column an entity's raw table is cut by: the one that incremental reads filter on."""
    column = ENTITIES[entity].since_column
    return column if column in df.columns else None


def batch_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def with_metadata(df: DataFrame, entity: str, batch: str, ingested_at: datetime) -> DataFrame:
    """Append the ingestion columns. The hash covers the business columns only, so it detects real changes."""
    business = [c for c in df.columns if c not in METADATA]
    return df.withColumns(
        {
            "_ingested_at": F.lit(ingested_at),
            "_source": F.lit(f"mock/{entity}"),
            "_batch_id": F.lit(batch),
            "_record_hash": record_hash(business),
        }
    )


TOTALS = "connector string, entity string, table_name string, rows_loaded long, status string"


def run_connector(
    feed,
    connector: str,
    entities: Sequence[str],
    layer: RawLayer,
    start: date | None = None,
    replace: Sequence[str] = (),
    batch: str | None = None,
    resume: bool = False,
    overlap: int = 0,
    marks: dict[str, date | None] | None = None,
    report_failures: bool = False,
) -> list[tuple]:
    """Load a connector's entities. If one fails the others go on, and then :class:`LoadFailed` names it.

    With ``report_failures`` nothing is raised and its row has the status ``failed``: for callers that look at it.

    With ``resume`` an entity is read from the day after the latest date its table has, or ``overlap`` days earlier
    where feeds deliver late rows; what is read twice is one row in staging. Entities without a date are read whole.
    ``marks`` may give the latest dates of the tables instead.
    """
    now = datetime.now(timezone.utc)
    batch = batch or batch_id(now)
    outcome, errors = [], {}
    for name in entities:
        table = ENTITIES[name].table
        try:
            first = start
            if resume and (mark := layer.high_water(table) if marks is None else marks.get(table)):
                first = max(filter(None, (start, mark + timedelta(days=1 - overlap))))
            rows = since(feed.feed(name), name, first)
            stamp = partial(with_metadata, entity=name, batch=batch, ingested_at=now)
            loaded = layer.load(rows, table, table in replace, dated_by=dated_by(name, rows), batch=batch, finish=stamp)
            outcome.append((connector, name, table, loaded, "loaded"))
        except Exception as error:
            log.error("%s.%s failed: %s", connector, name, error)
            outcome.append((connector, name, table, 0, "failed"))
            errors[f"{connector}.{name}"] = error
    if errors and not report_failures:
        raise LoadFailed(tuple(errors)) from next(iter(errors.values()))
    return outcome


def run_pipeline(
    feed,
    layer: RawLayer,
    start: date | None = None,
    full_reload: bool = True,
    disabled: Sequence[str] = (),
    connectors=CONNECTORS,
    resume: bool = False,
) -> DataFrame:
    """Load all enabled connectors; returns one row per connector and entity, also for those that failed, which
    :func:`complete` turns into an error.

    A full reload replaces each table the first time the run writes it and appends after that. With ``resume`` each
    table is continued after its latest date (see :func:`run_connector`); that excludes a full reload. Where two
    connectors fill one table both are read from the mark it had before the run.
    """
    if resume and full_reload:
        raise ValueError("a run either resumes or reloads")
    outcome, written = [], set()
    marks = {e.table: layer.high_water(e.table) for e in ENTITIES.values()} if resume else None
    for connector, entities in connectors:
        if connector in disabled:
            continue
        tables = {ENTITIES[e].table for e in entities}
        replace = tables - written if full_reload else ()
        outcome += run_connector(
            feed, connector, entities, layer, start, tuple(replace), resume=resume, marks=marks, report_failures=True
        )
        written |= tables
    return layer.spark.createDataFrame(outcome, TOTALS)


def complete(outcome: DataFrame) -> DataFrame:
    """The outcome of a run, for callers that go on from its tables: an error unless every entity is loaded."""
    failed = outcome.where(F.col("status") != "loaded").select("connector", "entity").collect()
    if failed:
        raise LoadFailed([f"{row.connector}.{row.entity}" for row in failed])
    return outcome


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet files below a folder: path, modificationTime and length. Their contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    try:
        return found.load(folder).select("path", "modificationTime", "length")
    except AnalysisException as error:
        raise ConnectorError(f"no data at {folder}") from error


def load_new_files(layer: RawLayer, folder: str, entity: str, schema, now: datetime | None = None) -> int:
    """Append the files below ``folder`` that are not in the entity's raw table yet; returns the rows loaded.

    A file is known by path, time and size, and counts as loaded once its load is committed: a run that ends early reads
    it again, and no file is read twice. Late rows are no problem, since dates don't matter. The paths of the new files
    pass through the driver, as they do in any read.
    """
    now = now or datetime.now(timezone.utc)
    table, spark = ENTITIES[entity].table, layer.spark
    known = layer.files(table).select("path", "modificationTime", "length")
    new = listed(spark, folder).join(known, known.columns, "left_anti").collect()
    if not new:
        return 0
    rows = spark.read.schema(schema).parquet(*[row.path for row in new])
    stamp = partial(with_metadata, entity=entity, batch=batch_id(now), ingested_at=now)
    noted = spark.createDataFrame(new)
    return layer.load(rows, table, dated_by=dated_by(entity, rows), batch=batch_id(now), files=noted, finish=stamp)


def totals(outcome: DataFrame) -> DataFrame:
    """Rows per entity over all connectors that loaded it."""
    return (
        outcome.where(F.col("status") == "loaded")
        .groupBy("entity", "table_name")
        .agg(F.sum("rows_loaded").alias("rows_loaded"))
    )


def write_datasets(datasets: dict[str, DataFrame], folder: str, format: str = "parquet") -> dict[str, str]:
    """Write each dataset to ``<folder>/<name>.<format>`` and skip the empty ones."""
    paths = {}
    for name, df in datasets.items():
        if df.isEmpty():
            log.warning("%s is empty, not written", name)
            continue
        path = f"{folder.rstrip('/')}/{name}.{format}"
        writer = df.write.mode("overwrite")
        if format == "parquet":
            writer.parquet(path)
        else:
            # Spark's CSV writer trims text unless told not to.
            keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            writer.options(header=True, **keep).csv(path)
        paths[name] = path
    return paths
