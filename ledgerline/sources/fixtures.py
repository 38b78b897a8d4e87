"""Raw commerce entities derived from the order-processing test tables.

Each ``raw_*`` method is one feed as a connector would deliver it: re-sent rows, invalid states, orphans, short
payments and broken payloads included, all by rules on the keys. Rows that a feed sends twice come from an
``explode`` of their batch numbers, so every table is scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import MONEY
from ledgerline.functions.signing import signature
from ledgerline.session import sized
from ledgerline.sources.schemas import EVENTS_FILE

# Names used by the feeds.
CHANNELS = ("organic_search", "paid_search", "social_media", "email", "direct", "affiliate", "referral")
WAREHOUSES = ("WH-EAST", "WH-WEST", "WH-CENTRAL", "WH-SOUTH", "WH-NORTH")
REFUND_REASONS = ("damaged", "not_as_described", "wrong_item", "changed_mind", "defective")
CARRIERS = ("UPS", "FedEx", "USPS")
EVENT_NAMES = {
    "view": "order.updated",
    "click": "shipment.updated",
    "signup": "order.created",
    "purchase": "payment.completed",
}
QUESTIONS = ("", " Why did our revenue fall?", " Please DROP TABLE orders now.", " Compare refund and ROAS.", " Thanks.", "")
PLATFORM_SHARES = {"direct": "0.50", "marketplace_a": "0.30", "marketplace_b": "0.20"}

FEED_EPOCH = "2024-01-01"
# The advertising days fall into the years of the orders.
AD_EPOCH, AD_DAYS = "1995-01-01", 2400
FIXTURE_SECRET = "fixture-secret"
ENTITIES = (
    "customers",
    "products",
    "orders",
    "order_items",
    "payments",
    "refunds",
    "shipments",
    "inventory",
    "ad_spend",
    "payouts",
)


def _dec(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({precision},{scale})")


def _pick(names: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def _sent_twice(condition: Column | bool) -> Column:
    """Batch numbers of a row: always batch 1, and batch 2 as well where the feed re-sends it."""
    if condition is True:
        return F.explode(F.array(F.lit(1), F.lit(2)))
    return F.explode(F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))


def _copied(df: DataFrame, condition: Column) -> DataFrame:
    """All rows with ``_copy`` 0, and those that meet the condition with ``_copy`` 1 as well."""
    copies = F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(copies))


def _second(key: Column) -> Column:
    """The id of a copy: the negative of the first one's, so that it meets no other id."""
    return F.when(F.col("_copy") == 1, -key).otherwise(key)


def _stamp(df: DataFrame, entity: str) -> DataFrame:
    """The metadata columns of a feed; the time of a batch follows from its number."""
    if "_batch_id" not in df.columns:
        df = df.withColumn("_batch_id", F.lit(1))
    if "_ingested_at" not in df.columns:
        df = df.withColumn("_ingested_at", F.date_add(F.lit(FEED_EPOCH).cast("date"), F.col("_batch_id")).cast("timestamp"))
    return df.withColumn("_source", F.lit(f"mock/{entity}"))


class FixtureSource:
    """Feeds on top of a folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return sized(self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def raw(self, entity: str) -> DataFrame:
        return getattr(self, f"raw_{entity}")()

    def raw_customers(self) -> DataFrame:
        key = F.col("c_custkey")
        joined = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return _stamp(
            joined.select(
                key.alias("customer_id"),
                F.concat(F.lit(" "), F.substring("c_name", 1, 8), F.lit(" ")).alias("first_name"),
                F.concat(F.expr("substr(c_name, 10)"), F.lit(" ")).alias("last_name"),
                F.when(key % 100 != 3, F.concat(F.lit(" User"), key.cast("string"), F.lit("@Example.COM "))).alias("email"),
                F.date_add(F.lit("1995-01-01").cast("date"), (key % 365).cast("int")).alias("signup_date"),
                F.concat(F.lit(" "), F.lower("n_name")).alias("country"),
                F.lower("r_name").alias("state"),
                F.concat("n_name", F.lit(" ")).alias("city"),
                F.col("c_mktsegment").alias("customer_segment"),
                _pick(CHANNELS, key % 7).alias("acquisition_channel"),
                _sent_twice(key % 50 == 11).alias("_batch_id"),
            ),
            "customers",
        )

    def raw_products(self) -> DataFrame:
        key = F.col("p_partkey")
        markup = F.when(key % 200 == 9, F.lit("1.1")).otherwise(F.lit("0.6"))
        return _stamp(
            self.table("part").select(
                key.alias("product_id"),
                F.when(key % 150 != 7, F.concat(F.lit("SKU-"), key.cast("string"))).alias("sku"),
                F.concat(F.lit(" "), "p_name").alias("product_name"),
                F.col("p_type").alias("category"),
                F.col("p_brand").alias("subcategory"),
                F.col("p_brand").alias("brand"),
                _dec(_dec("p_retailprice") * _dec(markup, 4)).alias("unit_cost"),
                _dec("p_retailprice").alias("list_price"),
                F.concat(F.lit("SUP-"), F.col("p_size").cast("string")).alias("supplier"),
            ),
            "products",
        )

    def raw_orders(self) -> DataFrame:
        key, state = F.col("o_orderkey"), F.col("o_orderstatus")
        status = (
            F.when(key % 125 == 0, "UNKNOWN_STATUS")
            .when((state == "F") & (key % 10 == 3), "refunded")
            .when(state == "F", "Completed")
            .when((state == "O") & (key % 8 == 1), "cancelled")
            .when(state == "O", "PROCESSING")
            .otherwise("shipped")
        )
        shipping, tax, discount = _dec(key % 20), _dec(key % 9), _dec(F.when(key % 6 == 1, key % 5).otherwise(0))
        return _stamp(
            self.table("orders").select(
                key.alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.to_date("o_orderdate").alias("order_date"),
                (key % 7 + 1).cast("int").alias("channel_id"),
                _pick(CHANNELS, key % 7).alias("channel"),
                status.alias("order_status"),
                _dec(_dec("o_totalprice") - shipping - tax + discount).alias("subtotal"),
                discount.alias("discount"),
                tax.alias("tax"),
                shipping.alias("shipping"),
                _dec("o_totalprice").alias("total_amount"),
                _sent_twice(key % 100 == 7).alias("_batch_id"),
            ),
            "orders",
        )

    def raw_order_items(self) -> DataFrame:
        price = _dec("l_extendedprice")
        discount = _dec(price * _dec("l_discount", 4))
        cost = _dec(price * _dec(F.lit("0.6"), 4))
        orphan = (F.col("l_orderkey") * 7 + F.col("l_partkey")) % 300 == 5
        # Line numbers repeat within an order; part and supplier tell such lines apart. A text holds keys of any size.
        item = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        prices = self.table("part").select("p_partkey", _dec("p_retailprice").alias("unit_price"))
        return _stamp(
            self.table("lineitem")
            .join(prices, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                item.alias("order_item_id"),
                F.when(orphan, F.lit(-1).cast("long")).otherwise(F.col("l_orderkey")).alias("order_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_quantity").cast("int").alias("quantity"),
                "unit_price",
                discount.alias("discount"),
                cost.alias("cost"),
                _dec(price - discount).alias("revenue"),
                _dec(price - discount - cost).alias("gross_profit"),
                "l_shipdate",
                _sent_twice(F.col("l_orderkey") % 90 == 4).alias("_batch_id"),
            )
            .withColumn("_ingested_at", F.date_add(F.to_date("l_shipdate"), F.col("_batch_id") - 1).cast("timestamp"))
            .drop("l_shipdate"),
            "order_items",
        )

    def raw_payments(self) -> DataFrame:
        key, total = F.col("o_orderkey"), _dec("o_totalprice")
        amount = (
            F.when(key % 50 == 11, _dec(total - 50))
            .when(key % 67 == 5, _dec(total * _dec(F.lit("0.9"), 4)))
            .otherwise(total)
        )
        return _stamp(
            _copied(self.table("orders"), key % 120 == 17)
            .select(
                _second(key).alias("payment_id"),
                F.when(key % 250 == 9, F.lit(-1).cast("long")).otherwise(key).alias("order_id"),
                F.to_date("o_orderdate").alias("payment_date"),
                F.col("o_orderpriority").alias("payment_method"),
                F.when(key % 50 == 0, "failed").otherwise("Completed").alias("status"),
                amount.alias("amount"),
                _sent_twice(key % 250 == 13).alias("_batch_id"),
            ),
            "payments",
        )

    def raw_refunds(self) -> DataFrame:
        key = F.col("o_orderkey")
        share = F.when(key % 29 == 0, F.lit("1.5")).otherwise(F.lit("0.25"))
        refunded = (F.col("o_orderstatus") == "F") & (key % 10 == 3)
        return _stamp(
            self.table("orders")
            .where(refunded | (key % 23 == 0) | (key % 29 == 0))
            .transform(lambda orders: _copied(orders, key % 46 == 0))
            .select(
                _second(key).alias("refund_id"),
                F.when(key % 290 == 0, F.lit(-1).cast("long")).otherwise(key).alias("order_id"),
                F.date_add(F.to_date("o_orderdate"), (key % 14 + 1).cast("int")).alias("refund_date"),
                _dec(_dec("o_totalprice") * _dec(share, 4)).alias("amount"),
                _pick(REFUND_REASONS, key % 5).alias("reason"),
                F.when(key % 40 == 3, "pending").otherwise("completed").alias("status"),
            ),
            "refunds",
        )

    def raw_shipments(self) -> DataFrame:
        key, ordered = F.col("order_id"), F.col("order_date")

        def after(days: Column) -> Column:
            return F.date_add(ordered, days.cast("int"))

        sent = F.lower("order_status").isin("completed", "shipped", "refunded")
        return _stamp(
            self.raw_orders()
            .where((F.col("_batch_id") == 1) & sent)
            .select(
                key.alias("shipment_id"),
                F.when(key % 350 == 2, -key).otherwise(key).alias("order_id"),
                (key % 5 + 1).cast("int").alias("warehouse_id"),
                _pick(WAREHOUSES, key % 5).alias("warehouse"),
                _pick(CARRIERS, key % 3).alias("carrier"),
                after(key % 3 + 1).alias("shipped_date"),
                after(key % 3 + 1 + key % 8 + 2).alias("estimated_delivery_date"),
                F.when(key % 40 != 0, after(key % 3 + 1 + key % 11)).alias("delivered_date"),
                F.when(key % 40 == 0, "in_transit").when(key % 333 == 1, "misplaced").otherwise("Delivered").alias("shipment_status"),
            ),
            "shipments",
        )

    def raw_inventory(self) -> DataFrame:
        sold = (
            self.table("lineitem")
            .groupBy(
                F.col("l_partkey").alias("product_id"),
                (F.col("l_suppkey") % 5 + 1).cast("int").alias("warehouse_id"),
                F.trunc("l_shipdate", "MM").alias("date"),
            )
            .agg(F.sum(F.col("l_quantity").cast("int")).cast("int").alias("sold_qty"))
        )
        product, site = F.col("product_id"), F.col("warehouse_id")
        moved = sold.select(
            F.concat_ws("-", product.cast("string"), site.cast("string"), F.col("date").cast("string")).alias("inventory_id"),
            "date",
            "product_id",
            "warehouse_id",
            _pick(WAREHOUSES, site - 1).alias("warehouse"),
            ((product * 37 + F.month("date") * 11) % 120).cast("int").alias("opening_qty"),
            ((product * 13 + site) % 40).cast("int").alias("received_qty"),
            "sold_qty",
            ((product + site) % 21 - 10).cast("int").alias("adjustment_qty"),
        )
        closing = F.col("opening_qty") + F.col("received_qty") - F.col("sold_qty") + F.col("adjustment_qty")
        return _stamp(
            moved.join(self.raw_products().select("product_id", "unit_cost"), "product_id").select(
                *moved.columns,
                closing.alias("closing_qty"),
                "unit_cost",
                _dec(F.greatest(closing, F.lit(0)) * F.col("unit_cost")).alias("inventory_value"),
            ),
            "inventory",
        )

    def ad_feed(self) -> DataFrame:
        """What one advertising provider delivers."""
        key, campaign = F.col("event_id"), F.col("user_id") % 12
        value = _dec("value")
        return self.table("events").select(
            key.alias("ad_record_id"),
            F.date_add(F.lit(AD_EPOCH).cast("date"), (key % AD_DAYS).cast("int")).alias("date"),
            (campaign + 1).cast("int").alias("campaign_id"),
            F.concat(F.lit("Campaign "), (campaign + 1).cast("string")).alias("campaign_name"),
            F.when(campaign < 6, 2).otherwise(3).alias("channel_id"),
            F.when(campaign < 6, "paid_search").otherwise("social_media").alias("channel"),
            (key % 5000 + 500).cast("int").alias("impressions"),
            F.when(key % 500 == 17, 6000).otherwise(key % 97).cast("int").alias("clicks"),
            (key % 97 % 11).cast("int").alias("conversions"),
            F.when(key % 333 == 0, F.lit(0).cast(MONEY)).otherwise(value).alias("spend"),
            _dec(value * _dec(key % 6, 4, 0)).alias("attributed_revenue"),
        )

    def raw_ad_spend(self) -> DataFrame:
        """Both providers deliver the same records, so each arrives twice."""
        feed = self.ad_feed()
        return _stamp(feed.withColumn("_batch_id", _sent_twice(True)), "advertising")

    def raw_payouts(self) -> DataFrame:
        base = (
            self.raw_orders()
            .where((F.col("_batch_id") == 1) & (F.lower("order_status") == "completed"))
            .groupBy(F.trunc("order_date", "MM").alias("period_start"), F.last_day("order_date").alias("period_end"))
            .agg(F.sum("total_amount").alias("month_sales"))
        )
        platforms = F.array(
            *[
                F.struct(F.lit(n).alias("n"), F.lit(name).alias("platform"), _dec(F.lit(share), 4).alias("share"))
                for n, (name, share) in enumerate(PLATFORM_SHARES.items(), start=1)
            ]
        )
        split = base.select("*", F.inline(platforms)).withColumn("sales", F.col("month_sales") * F.col("share"))

        def part(text: str) -> Column:
            return _dec(F.col("sales") * _dec(F.lit(text), 4))

        return _stamp(
            split.select(
                F.concat_ws("-", F.col("period_start").cast("string"), "platform").alias("payout_id"),
                F.date_add("period_end", 10).alias("payout_date"),
                "platform",
                "period_start",
                "period_end",
                _dec("sales").alias("gross_sales"),
                part("0.03").alias("fees"),
                part("0.02").alias("refunds"),
                _dec("n").alias("adjustments"),
                part("0.95").alias("net_payout"),
            ),
            "payouts",
        )

    # -- connectors and logs --------------------------------------------------------------------------------

    def feed(self, entity: str) -> DataFrame:
        """Business columns of an entity, as one connector delivers it."""
        if entity == "advertising":
            return self.ad_feed()
        return self.raw(entity).drop("_batch_id", "_ingested_at", "_source")

    def clean(self) -> dict[str, DataFrame]:
        """The entities without re-sent rows."""
        names = ("customers", "products", "orders", "order_items", "payments", "refunds", "inventory", "shipments")
        return {n: self.raw(n).where(F.col("_batch_id") == 1).drop("_batch_id", "_source", "_ingested_at") for n in names}

    def query_log(self) -> DataFrame:
        """One logged statement per event, of ten kinds."""
        key = F.col("event_id")
        number = key.cast("string")
        kinds = [
            F.concat(F.lit("SELECT * FROM main_marts.fct_orders LIMIT "), number),
            F.concat(F.lit("  with t as (select "), number, F.lit(" as id) select count(*) from t  ")),
            F.concat(F.lit("DELETE FROM main_marts.fct_orders WHERE order_id = "), number),
            F.concat(F.lit("SELECT "), number, F.lit("; Drop TABLE fct_orders")),
            F.concat(F.lit("select updated_at, created from t where note = 'please call "), number, F.lit("'")),
            F.lit(""),
            F.lit("   "),
            F.lit(None).cast("string"),
            F.concat(F.lit("SELECTED "), number, F.lit(" rows from a statement that is longer than forty characters")),
            F.concat(F.lit("select callout, dropped, grants from report_"), number),
        ]
        choice = F.element_at(F.array(*kinds), (key % len(kinds)).cast("int") + 1)
        return self.table("events").select(key, choice.alias("sql"))

    def question_log(self) -> DataFrame:
        """The questions of the conversations; some ask for what is not allowed, some name a metric."""
        key = F.col("conv_id") + F.col("turn")
        asked = F.element_at(F.array(*[F.lit(q) for q in QUESTIONS]), (key % len(QUESTIONS)).cast("int") + 1)
        text = F.when(key % 10 == 0, F.lit(None).cast("string")).otherwise(F.concat("text", asked))
        return self.table("conversations").select("conv_id", "turn", "role", text.alias("text"))

    def webhooks(self, stream: bool = False) -> DataFrame:
        """Signed event requests: duplicates, broken JSON, missing and foreign types, bad signatures."""
        if stream:
            events = (
                self.spark.readStream.schema(EVENTS_FILE).option("pathGlobFilter", "events.parquet").parquet(self.folder)
            )
        else:
            events = self.spark.read.schema(EVENTS_FILE).parquet(f"{self.folder}/events.parquet")
        key = F.col("event_id")
        name = F.coalesce(
            F.element_at(F.create_map(*[F.lit(x) for pair in EVENT_NAMES.items() for x in pair]), F.col("event_type")),
            F.lit("system.error"),
        )
        typed = F.when(key % 97 == 3, F.lit('{"event_type":"","type":"order.cancelled"')).otherwise(
            F.concat(F.lit('{"event_type":"'), name, F.lit('"'))
        )
        sender = F.when(key % 89 == 2, F.lit("")).otherwise(F.lit(',"source":"shop"'))
        body = (
            F.when(key % 211 == 1, F.lit("{not json"))
            .when(key % 199 == 1, F.lit('{"source":"x"}'))
            .otherwise(F.concat(typed, sender, F.lit(',"data":'), F.col("props"), F.lit("}")))
        )
        sent_id = F.when((key % 50 == 0) & (key > 0), key - 1).otherwise(key)
        signed = signature(F.col("body"), FIXTURE_SECRET)
        return events.select(
            F.when(key % 179 == 6, F.lit("")).when(key % 173 != 4, sent_id.cast("string")).alias("event_id"),
            F.col("ts").alias("received_at"),
            body.alias("body"),
            key.alias("_key"),
        ).select(
            "event_id",
            F.when(F.col("_key") % 131 == 7, F.concat(F.lit("sha256="), F.repeat(F.lit("0"), 64)))
            .when(F.col("_key") % 137 == 9, F.lit(None))
            .when(F.col("_key") % 139 == 11, F.regexp_replace(signed, "^sha256=", ""))
            .otherwise(signed)
            .alias("signature"),
            "received_at",
            "body",
        )
