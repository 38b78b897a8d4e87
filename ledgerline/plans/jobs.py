"""Registered runs of the ingestion, defect and event-intake operators on the test feeds."""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.signing import signature
from ledgerline.operators import defects
from ledgerline.operators.changes import changes
from ledgerline.plans.incremental import MonthlyMarts
from ledgerline.session import CODEC, shared_folder, sized
from ledgerline.sources import ingest
from ledgerline.sources.fixtures import FIXTURE_SECRET
from ledgerline.sources.ingest import ENTITIES, RawLayer
from ledgerline.sources.schemas import ORDERS_FILE
from ledgerline.streaming import intake

SINCE = date(1999, 1, 1)
RECENT = date(2001, 3, 15)
BATCH = "20240101T000000Z"
INGESTED = datetime(2024, 1, 1, tzinfo=timezone.utc)


# -- ingestion ----------------------------------------------------------------------------------------------


def scanned_orders(warehouse) -> DataFrame:
    return ingest.scan(warehouse.spark, f"{warehouse.source.folder}/orders.parquet", ORDERS_FILE)


def incremental_orders(warehouse) -> DataFrame:
    return ingest.since(warehouse.source.feed("orders"), "orders", SINCE)


def incremental_counts(warehouse) -> DataFrame:
    whole = None
    for name in ENTITIES:
        rows = ingest.since(warehouse.source.feed(name), name, SINCE)
        part = rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("entity"), "row_count")
        whole = part if whole is None else whole.unionByName(part)
    return whole


def stamped_customers(warehouse) -> DataFrame:
    return ingest.with_metadata(warehouse.source.feed("customers"), "customers", BATCH, INGESTED)


def pipeline_totals(warehouse) -> DataFrame:
    layer = RawLayer(warehouse.spark, shared_folder(warehouse.spark, "raw"))
    return ingest.totals(ingest.complete(ingest.run_pipeline(warehouse.source, layer)))


def loaded_counts(warehouse) -> DataFrame:
    """Rows found in the raw tables after a full load and one more incremental load of the orders connector."""
    layer = RawLayer(warehouse.spark, shared_folder(warehouse.spark, "raw"))
    commerce = (("commerce", ("customers", "products", "orders")),)
    ingest.complete(ingest.run_pipeline(warehouse.source, layer, connectors=commerce))
    ingest.complete(ingest.run_pipeline(warehouse.source, layer, start=SINCE, full_reload=False, connectors=commerce))
    whole = None
    for table in ("raw_customers", "raw_products", "raw_orders"):
        part = layer.table(table).agg(F.count("*").alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")
        whole = part if whole is None else whole.unionByName(part)
    return whole


class _WithoutRefunds:
    """The feeds while the refunds are down."""

    def __init__(self, source) -> None:
        self.source = source

    def feed(self, entity: str) -> DataFrame:
        if entity == "refunds":
            raise ingest.ConnectorError("refunds are down")
        return self.source.feed(entity)


def reload_counts(warehouse) -> DataFrame:
    """Rows per raw table, and those with a batch id made at the time, after a load, a reload of the customers alone
    beside an append of the products, and a load in which one entity fails and leaves no table."""
    layer = RawLayer(warehouse.spark, shared_folder(warehouse.spark, "raw"))
    commerce = ("customers", "products")
    ingest.run_connector(warehouse.source, "commerce", commerce, layer)
    ingest.run_connector(warehouse.source, "commerce", commerce, layer, replace=("raw_customers",))
    payments = ("payments", "refunds")
    outcome = ingest.run_connector(_WithoutRefunds(warehouse.source), "payments", payments, layer, report_failures=True)
    if [row[-1] for row in outcome] != ["loaded", "failed"]:
        raise ingest.LoadFailed([f"{row[0]}.{row[1]}" for row in outcome if row[-1] == "failed"])
    made = F.count_if(F.col("_batch_id").rlike("^[0-9]{8}T[0-9]{6}Z$"))
    rows = None
    for table in ("raw_customers", "raw_products", "raw_payments", "raw_refunds"):
        number = F.lit(layer.count(table)).cast("long").alias("row_count")
        if layer.exists(table):
            part = layer.table(table).agg(made.alias("stamped")).select(F.lit(table).alias("table_name"), number, "stamped")
        else:
            part = warehouse.spark.range(1).select(
                F.lit(table).alias("table_name"), number, F.lit(0).cast("long").alias("stamped")
            )
        rows = part if rows is None else rows.unionByName(part)
    return rows


class _Until:
    """The feeds as they were before a day, by the dates incremental reads filter on."""

    def __init__(self, source, end: date) -> None:
        self.source, self.end = source, end

    def feed(self, entity: str) -> DataFrame:
        rows = self.source.feed(entity)
        column = ENTITIES[entity].since_column
        return rows.where(F.col(column) < F.lit(self.end)) if column else rows


@cache
def _resumed(warehouse) -> RawLayer:
    """Orders loaded up to a day, then resumed twice; the last run finds nothing new."""
    layer = RawLayer(warehouse.spark, shared_folder(warehouse.spark, "raw"))
    for feed in (_Until(warehouse.source, SINCE), warehouse.source, warehouse.source):
        ingest.run_connector(feed, "commerce", ("orders",), layer, resume=True, batch=BATCH)
    return layer


def resumed_commits(warehouse) -> DataFrame:
    return _resumed(warehouse).commits("raw_orders").select("version", "mode", "rows", "low", "high")


def resumed_months(warehouse) -> DataFrame:
    """Rows per month of the last year and a half, read with a partition filter."""
    rows = _resumed(warehouse).table("raw_orders", since=RECENT)
    return rows.groupBy(F.trunc("order_date", "MM").alias("month")).agg(F.count("*").alias("row_count"))


def new_files(warehouse) -> DataFrame:
    """Rows of each load when files arrive one after the other and every run takes only those it does not know."""
    spark = warehouse.spark
    layer, inbox = RawLayer(spark, shared_folder(spark, "raw")), shared_folder(spark, "inbox")
    orders = warehouse.source.feed("orders")
    for number in range(3):
        orders.where(F.col("order_id") % 3 == number).write.mode("append").parquet(inbox)
        ingest.load_new_files(layer, inbox, "orders", orders.schema)
        ingest.load_new_files(layer, inbox, "orders", orders.schema)
    return layer.commits("raw_orders").select("version", "rows")


class _Earlier:
    """The feeds as they were before the present ones: recent orders and payments are not there yet, some rows are
    different, some are missing and some are there that will be withdrawn."""

    def __init__(self, source) -> None:
        self.source = source

    def feed(self, entity: str) -> DataFrame:
        rows = self.source.feed(entity)
        if entity == "orders":
            known = rows.where(F.col("order_date") < F.lit(RECENT))
            changed = (F.year("order_date") == 1998) & (F.col("order_id") % 50 == 3)
            old = known.withColumn("order_status", F.when(changed, F.lit("processing")).otherwise(F.col("order_status")))
            old = old.withColumn("channel_id", F.when(changed, F.lit(1)).otherwise(F.col("channel_id")))
            old = old.withColumn("shipping", F.when(changed, F.col("shipping") + 1).otherwise(F.col("shipping")).cast("decimal(18,2)"))
            gone = known.where("order_id % 4000 = 9").withColumn("order_id", -F.col("order_id"))
            return old.unionByName(gone)
        if entity == "order_items":
            wrong = (F.col("order_id") % 3000 == 7) & (F.col("quantity") > 10)
            return rows.withColumn("quantity", F.when(wrong, 1).otherwise(F.col("quantity"))).where("order_id % 3000 <> 8")
        if entity == "refunds":
            return rows.where("refund_id % 1000 <> 0")
        if entity == "payments":
            doubled = F.when(F.col("payment_id") % 3000 == 1, F.col("amount") * 2).otherwise(F.col("amount"))
            return rows.where(F.col("payment_date") < F.lit(RECENT)).withColumn("amount", doubled.cast("decimal(18,2)"))
        if entity == "payouts":
            return rows.where((F.col("platform") != "direct") | (F.year("period_start") != 1997))
        return rows


MONTHLY = ("orders", "order_items", "refunds", "payments", "payouts")


def order_changes(warehouse) -> DataFrame:
    """What a reload of the orders changed."""
    layer = RawLayer(warehouse.spark, shared_folder(warehouse.spark, "raw"))
    for feed in (_Earlier(warehouse.source), warehouse.source):
        ingest.run_connector(feed, "commerce", ("orders",), layer, replace=("raw_orders",))
    return changes(layer.table("raw_orders", 1), layer.table("raw_orders"), "order_id", ("order_status",))


def version_counts(warehouse) -> DataFrame:
    """Rows of the orders in each version, of which the first was reloaded and the second added to."""
    layer = RawLayer(warehouse.spark, shared_folder(warehouse.spark, "raw"))
    earlier = _Earlier(warehouse.source)
    for feed, replace in ((earlier, ()), (warehouse.source, ("raw_orders",)), (earlier, ())):
        ingest.run_connector(feed, "commerce", ("orders",), layer, replace=replace)
    whole = None
    for version in (1, 2, 3):
        part = layer.table("raw_orders", version).agg(F.count("*").alias("row_count"))
        part = part.select(F.lit(version).alias("version"), "row_count")
        whole = part if whole is None else whole.unionByName(part)
    return whole


@cache
def _followed(warehouse) -> MonthlyMarts:
    """Tables kept by month, after the raw tables under them were reloaded."""
    spark = warehouse.spark
    layer = RawLayer(spark, shared_folder(spark, "raw"))
    marts = MonthlyMarts(layer, shared_folder(spark, "marts"), warehouse.settings)
    tables = tuple(ENTITIES[entity].table for entity in MONTHLY)
    for feed in (_Earlier(warehouse.source), warehouse.source):
        ingest.run_connector(feed, "all", MONTHLY, layer, replace=tables)
        marts.refresh()
    return marts


def csv_products(warehouse) -> DataFrame:
    folder = shared_folder(warehouse.spark, "csv")
    made = warehouse.source.feed("products")
    paths = ingest.write_datasets({"products": made}, folder, "csv")
    return warehouse.spark.read.schema(made.schema).option("header", True).csv(paths["products"])


def sql_over_layers(warehouse) -> DataFrame:
    warehouse.register_views(("stg_refunds", "fct_refunds"))
    return warehouse.sql(
        "select f.reason, count(*) as refunds, count_if(f.is_over_refund) as over_refunds, sum(s.amount) as amount "
        "from fct_refunds f join stg_refunds s on s.refund_id = f.refund_id group by f.reason"
    )


def materialised_sales(warehouse) -> DataFrame:
    """The sales mart built from written staging tables instead of one long plan."""
    layered = warehouse.copy()
    layered.materialise(
        ("stg_orders", "clean_order_items", "stg_refunds", "int_order_revenue", "mart_sales"),
        shared_folder(warehouse.spark, "layers"),
    )
    return layered["mart_sales"]


# -- defects ------------------------------------------------------------------------------------------------


def _injected(entity: str, *columns: str):
    return lambda warehouse: defects.inject(warehouse.source.clean())[entity].select(*columns)


def defect_report(warehouse) -> DataFrame:
    return defects.defect_report(warehouse.source.clean())


@cache
def _exact(warehouse) -> tuple[dict[str, DataFrame], dict[str, DataFrame], dict]:
    """The entities, the same for counting, and the picks."""
    clean = warehouse.source.clean()
    # Lines that repeat an id are told apart by nothing.
    clean["order_items"] = clean["order_items"].dropDuplicates(["order_item_id"])
    # These two are worked out from all lines, and counted several times by nothing but their keys.
    counted, folder = dict(clean), shared_folder(warehouse.spark, "keys")
    for name in ("order_items", "inventory"):
        keys = clean[name].select(defects.KEYS[name])
        keys.write.parquet(f"{folder}/{name}", compression=CODEC)
        counted[name] = sized(warehouse.spark.read.schema(keys.schema).parquet(f"{folder}/{name}"))
    return clean, counted, defects.exact_picks(counted)


def exact_orders(warehouse) -> DataFrame:
    """Orders with exactly the wanted numbers of copies and bad states."""
    clean, _, picks = _exact(warehouse)
    return defects.inject(clean, picks)["orders"].select("order_id", "order_status")


def exact_counts(warehouse) -> DataFrame:
    _, counted, picks = _exact(warehouse)
    return defects.affected(counted, picks)


# -- event intake -------------------------------------------------------------------------------------------


def signatures(warehouse) -> DataFrame:
    requests = warehouse.source.webhooks()
    return requests.select(
        "event_id", "received_at", signature(F.col("body"), FIXTURE_SECRET).alias("expected"), "signature"
    )


def routed(warehouse) -> DataFrame:
    return intake.route(warehouse.source.webhooks(), FIXTURE_SECRET).drop("signature")


def _streamed(warehouse, repeats: str) -> tuple[DataFrame, DataFrame]:
    spark = warehouse.spark
    return intake.run(
        spark,
        warehouse.source.webhooks(stream=True),
        shared_folder(spark, "events"),
        shared_folder(spark, "events-checkpoint"),
        secret=FIXTURE_SECRET,
        repeats=repeats,
    )


def _comparable(events: DataFrame) -> DataFrame:
    # Ids made up for requests without one are random.
    sent = F.col("event_id").rlike("^[0-9]+$")
    return events.withColumns(
        {
            "webhook_event_id": F.when(sent, F.col("webhook_event_id")),
            "event_id": F.when(sent, F.col("event_id")),
        }
    )


def stream_accepted(warehouse) -> DataFrame:
    return _comparable(_streamed(warehouse, "ledger")[0])


def stream_rejected(warehouse) -> DataFrame:
    return _streamed(warehouse, "ledger")[1]


def _ids(repeats: str):
    # Which of two requests with one id survives in the state store depends on their order; the ids do not.
    return lambda warehouse: _comparable(_streamed(warehouse, repeats)[0]).select("event_id")


def late_ids(warehouse) -> DataFrame:
    """Ids taken in by two runs, of which the second brings the earlier half of the events."""
    spark = warehouse.spark
    inbox, out, checkpoint = (shared_folder(spark, f"events-{name}") for name in ("inbox", "late", "late-checkpoint"))
    requests = warehouse.source.webhooks()
    middle = F.lit("2024-01-15").cast("timestamp")
    for half in (F.col("received_at") >= middle, F.col("received_at") < middle):
        requests.where(half).write.mode("append").parquet(inbox)
        feed = spark.readStream.schema(requests.schema).parquet(inbox)
        kept, _ = intake.run(spark, feed, out, checkpoint, secret=FIXTURE_SECRET, repeats="watermark", delay="2 days")
    return _comparable(kept).select("event_id")


QUERIES = {
    "src_scan_orders": scanned_orders,
    "src_incremental_orders": incremental_orders,
    "src_incremental_counts": incremental_counts,
    "src_metadata_customers": stamped_customers,
    "src_pipeline_totals": pipeline_totals,
    "src_loaded_counts": loaded_counts,
    "src_reload_counts": reload_counts,
    "src_resumed_commits": resumed_commits,
    "src_resumed_months": resumed_months,
    "src_new_files": new_files,
    "src_changes": order_changes,
    "src_versions": version_counts,
    "inc_order_revenue": lambda warehouse: _followed(warehouse).table("int_order_revenue"),
    "inc_mart_sales": lambda warehouse: _followed(warehouse).table("mart_sales"),
    "inc_mart_finance": lambda warehouse: _followed(warehouse).table("mart_finance"),
    "src_csv_products": csv_products,
    "src_sql_read": sql_over_layers,
    "src_materialised_sales": materialised_sales,
    "inj_orders": _injected("orders", "order_id", "order_status"),
    "inj_order_items": _injected("order_items", "order_item_id", "order_id"),
    "inj_payments": _injected("payments", "payment_id", "order_id", "amount"),
    "inj_refunds": _injected("refunds", "refund_id", "amount"),
    "inj_customers": _injected("customers", "customer_id", "email"),
    "inj_products": _injected("products", "product_id", "sku"),
    "inj_inventory": _injected("inventory", "inventory_id", "closing_qty"),
    "inj_shipments": _injected("shipments", "shipment_id", "shipped_date", "delivered_date"),
    "inj_report": defect_report,
    "inj_exact_orders": exact_orders,
    "inj_exact_counts": exact_counts,
    "wh_signatures": signatures,
    "wh_routed": routed,
    "wh_accepted": stream_accepted,
    "wh_rejected": stream_rejected,
    "wh_ids_state": _ids("state"),
    "wh_ids_watermark": _ids("watermark"),
    "wh_ids_late": late_ids,
}
