"""Intake of signed events: check, route, remove repeats, append.

The per-row steps are the same for a batch and a stream. Repeats can be removed in three ways:

``ledger``     every id ever accepted counts; ids are looked up in a ledger bucketed by hash, of which a trigger reads
               the Bloom filters and the buckets that may hold its ids. Exact for ever, keeps no state. The
               earliest request of a trigger wins.
``state``      every id ever accepted counts; ids live in the state store, and a trigger costs only its own rows.
``watermark``  ids are forgotten after a delay: requests are looked up in what was received since the watermark, the
               latest time accepted so far less the delay. Requests that are older than that are few; they are
               looked up in the whole ledger, so that a late event is neither lost nor taken twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.signing import signed_by
from ledgerline.streaming.ledger import Ledger

# Accepted event types and the secret that switches the signature check off.
ACCEPTED_EVENTS = (
    "order.created",
    "order.updated",
    "order.cancelled",
    "payment.completed",
    "payment.failed",
    "payment.refunded",
    "inventory.updated",
    "shipment.created",
    "shipment.updated",
    "shipment.delivered",
)
DEVELOPMENT_SECRET = "dev-secret-not-for-prod"
REPEAT_SALTS = 32

EVENT_COLUMNS = {
    "webhook_event_id": "string",
    "event_id": "string",
    "event_type": "string",
    "received_at": "timestamp",
    "source": "string",
    "payload": "string",
    "processing_status": "string",
    "processed_at": "timestamp",
    "error_message": "string",
}
REJECTED_COLUMNS = {
    "event_id": "string",
    "received_at": "timestamp",
    "body": "string",
    "event_type": "string",
    "status_code": "int",
    "reason": "string",
}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def _shaped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])


# -- row-wise steps -----------------------------------------------------------------------------------------


def _field(parsed: Column, name: str) -> Column:
    return F.try_variant_get(parsed, f"$.{name}", "string")


def parse(requests: DataFrame) -> DataFrame:
    """Add event type and source; an empty type falls through to the second name, a missing source is 'unknown'."""
    parsed = F.col("_json")
    named = [F.nullif(_field(parsed, n), F.lit("")) for n in ("event_type", "type")]
    explicit_null = F.is_variant_null(F.try_variant_get(parsed, "$.source", "variant"))
    return (
        requests.withColumn("_json", F.try_parse_json("body"))
        .withColumns(
            {
                "event_type": F.coalesce(*named),
                "source": F.when(~F.coalesce(explicit_null, F.lit(False)), F.coalesce(_field(parsed, "source"), F.lit("unknown"))),
                "_is_json": F.col("_json").isNotNull(),
            }
        )
        .drop("_json")
    )


def route(requests: DataFrame, secret: str = DEVELOPMENT_SECRET) -> DataFrame:
    """Add ``reason`` and ``status_code``; accepted requests have no reason."""
    signed = F.lit(True) if secret == DEVELOPMENT_SECRET else signed_by(F.col("body"), F.col("signature"), secret)
    reason = (
        F.when(~signed, "bad_signature")
        .when(~F.col("_is_json"), "invalid_json")
        .when(F.col("event_type").isNull(), "missing_event_type")
        .when(~F.col("event_type").isin(*ACCEPTED_EVENTS), "unknown_event_type")
    )
    code = F.when(reason.isNull(), 202).when(~signed, 401).when(~F.col("_is_json"), 400).otherwise(422)
    return parse(requests).withColumns({"reason": reason, "status_code": code}).drop("_is_json")


def accepted(routed: DataFrame) -> DataFrame:
    """Accepted requests; an empty id counts as none."""
    taken = routed.where(F.col("reason").isNull()).drop("reason", "status_code", "signature")
    return taken.withColumn("event_id", F.nullif("event_id", F.lit("")))


def rejected(routed: DataFrame) -> DataFrame:
    return _shaped(routed.where(F.col("reason").isNotNull()), REJECTED_COLUMNS)


def event_rows(requests: DataFrame) -> DataFrame:
    """Accepted requests as rows of the event table. A request without an id gets one nobody else has."""
    identified = requests.withColumn("event_id", F.coalesce("event_id", F.uuid()))
    made = identified.withColumns(
        {
            "webhook_event_id": F.md5(F.concat_ws("|", "event_id", F.col("received_at").cast("string"))),
            "payload": F.col("body"),
            "processing_status": F.lit("pending"),
            "processed_at": F.lit(None),
            "error_message": F.lit(None),
        }
    )
    return _shaped(made, EVENT_COLUMNS)


# -- removing repeats ---------------------------------------------------------------------------------------


def first_per_id(requests: DataFrame) -> DataFrame:
    """The earliest request of each id.

    A minimum per id is combined on the map side, so an id sent very often is one row per task in the shuffle.
    """
    others = [c for c in requests.columns if c not in ("event_id", "received_at")]
    return (
        requests.groupBy("event_id")
        .agg(F.min(F.struct("received_at", *others)).alias("_first"))
        .select("event_id", "_first.*")
        .select(*requests.columns)
    )


def unseen(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests, one per id, whose id the ledger does not hold.

    The ledger is first cut down to the ids of this trigger, so what meets the requests is no larger than they.
    """
    repeated = ledger.select("event_id").join(requests.select("event_id"), "event_id", "left_semi").distinct()
    return requests.join(repeated, "event_id", "left_anti")


def fresh(requests: DataFrame, ledger: Ledger, number: int) -> DataFrame:
    """What a trigger adds. Requests without an id are never repeats and take no part in any shuffle."""
    named = first_per_id(requests.where(F.col("event_id").isNotNull()))
    added = named.join(ledger.repeated(named.select("event_id"), number), "event_id", "left_anti")
    return added.unionByName(requests.where(F.col("event_id").isNull()))


# -- running ------------------------------------------------------------------------------------------------


def _read(spark: SparkSession, path: str, columns: dict[str, str], extra: str = "") -> DataFrame:
    return spark.read.schema(_ddl(columns) + extra).parquet(path)


def fresh_within(requests: DataFrame, ledger: DataFrame, delay: str) -> DataFrame:
    """What a trigger adds if ids are forgotten ``delay`` after they were received.

    The watermark is a single time. Only requests before it, and those without a time, meet the older part of the
    ledger; for the others a filter on the time keeps that part from being read.
    """
    named = first_per_id(requests.where(F.col("event_id").isNotNull()))
    latest = ledger.agg((F.max("received_at") - F.expr(f"interval {delay}")).alias("t")).first()["t"]
    anonymous = requests.where(F.col("event_id").isNull())
    if latest is None:  # nothing was accepted so far, or nothing with a time
        return unseen(named, ledger).unionByName(anonymous)
    in_time = F.coalesce(F.col("received_at") >= F.lit(latest), F.lit(False))
    recent = unseen(named.where(in_time), ledger.where(in_time))
    return recent.unionByName(unseen(named.where(~in_time), ledger)).unionByName(anonymous)


def _ledger_writer(
    spark: SparkSession, folder: str, secret: str, delay: str | None = None, **sizes: int
) -> Callable[[DataFrame, int], None]:
    """Per trigger: one folder of accepted and one of rejected rows, named by the trigger. With a ``delay`` ids are
    forgotten after it; without one they are also noted in a :class:`Ledger`, of which a trigger reads no more than the
    buckets that may hold its ids.

    A replayed trigger overwrites its own folders and does not see itself in the ledger, so it writes the same
    rows again.
    """
    noted = Ledger(spark, f"{folder}/ledger", **sizes)

    def write(batch: DataFrame, number: int) -> None:
        routed = route(batch, secret).persist()
        try:
            ledger = _read(spark, f"{folder}/accepted", EVENT_COLUMNS, ", batch long").where(F.col("batch") < number)
            requests = accepted(routed)
            if delay:
                added = fresh_within(requests, ledger, delay)
            else:
                if noted.empty() and not ledger.isEmpty():  # accepted before there was one
                    noted.add(ledger.select("event_id"), number - 1)
                added = fresh(requests, noted, number)
            event_rows(added).write.mode("overwrite").parquet(f"{folder}/accepted/batch={number}")
            if not delay:
                noted.add(_read(spark, f"{folder}/accepted/batch={number}", EVENT_COLUMNS), number)
            rejected(routed).write.mode("overwrite").parquet(f"{folder}/rejected/batch={number}")
        finally:
            routed.unpersist()

    return write


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started in here keep their state in RocksDB: ids pile up, and the heap must not hold them."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def without_repeats(rows: DataFrame) -> DataFrame:
    """Streaming removal of repeated ids in two steps.

    The first step works on id and a salt taken from the rest of the row, so the requests of an id that is sent
    very often are spread over several tasks; the second has at most one request per id and salt left.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("received_at", "payload"), F.lit(REPEAT_SALTS)))
    return salted.dropDuplicates(["event_id", "_salt"]).dropDuplicates(["event_id"]).drop("_salt")


def start(
    spark: SparkSession,
    requests: DataFrame,
    folder: str,
    checkpoint: str,
    secret: str = DEVELOPMENT_SECRET,
    repeats: str = "ledger",
    delay: str = "7 days",
    **sizes: int,
) -> list[StreamingQuery]:
    """Take in everything that is available, then stop. Call again with the same folders to go on.

    ``sizes`` are those of the :class:`Ledger`. In ``state`` mode any of the requests of an id may be the one that is
    kept; the other two keep the earliest.
    """
    if repeats not in ("ledger", "state", "watermark"):
        raise ValueError(f"repeats must be ledger, state or watermark, not {repeats}")
    if repeats != "state":
        # An empty first folder gives the ledger a schema before anything was accepted.
        schema_only = spark.createDataFrame([], _ddl(EVENT_COLUMNS))
        schema_only.write.mode("ignore").parquet(f"{folder}/accepted/batch=-1")
        write = _ledger_writer(spark, folder, secret, delay if repeats == "watermark" else None, **sizes)
        writer = requests.writeStream.foreachBatch(write)
        return [writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()]
    routed = route(requests, secret)
    taken = accepted(routed)
    # Requests without an id are never repeats, so they leave nothing in the state.
    named, anonymous = (event_rows(taken.where(c)) for c in ("event_id is not null", "event_id is null"))
    outputs = {"accepted": without_repeats(named).unionByName(anonymous), "rejected": rejected(routed)}
    with _state_on_disk(spark):
        return [
            df.writeStream.format("parquet")
            .option("path", f"{folder}/{name}")
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
            for name, df in outputs.items()
        ]


def run(spark: SparkSession, requests: DataFrame, folder: str, checkpoint: str, **options) -> tuple[DataFrame, DataFrame]:
    """Run to the end and return the accepted and the rejected rows the folder holds now."""
    for query in start(spark, requests, folder, checkpoint, **options):
        query.awaitTermination()
    return tuple(
        _shaped(_read(spark, f"{folder}/{name}", columns), columns)
        for name, columns in (("accepted", EVENT_COLUMNS), ("rejected", REJECTED_COLUMNS))
    )
