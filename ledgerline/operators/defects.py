"""Deliberate defects for exercising the quality checks.

Rows are picked by a hash of their key, so the choice does not depend on partitioning and repeats on a re-run. By default
the hash has to be below the wanted rate, which needs no counts up front and comes near it. With :func:`exact_picks` as
many rows as wanted are picked: those with the least hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key of the orphans, status of broken orders, share of defects and the seed.
NO_ORDER_ITEM = "ORD-INVALID-9999"
NO_ORDER_PAYMENT = "ORD-GHOST-0000"
BAD_STATUS = "UNKNOWN_STATUS"
DEFECT_SHARE = 0.02
SEED = 42
# Rate of each defect relative to the defect share.
RATES = {
    "duplicate_orders": 0.5,
    "orphan_order_items": 0.3,
    "orphan_payments": 0.2,
    "refund_exceeds_payment": 1.0,
    "null_customer_email": 0.5,
    "null_product_sku": 0.3,
    "invalid_order_status": 0.4,
    "negative_inventory": 0.5,
    "payment_amount_mismatch": 0.3,
    "duplicate_payments": 0.2,
    "late_shipment_date": 0.5,
}
DATASETS = {
    "duplicate_orders": ("orders", "Whole rows sent twice"),
    "orphan_order_items": ("order_items", "Order id of no order"),
    "orphan_payments": ("payments", "Payment of no order"),
    "refund_exceeds_payment": ("refunds", "Refund amount raised"),
    "null_customer_email": ("customers", "Email missing"),
    "null_product_sku": ("products", "SKU missing"),
    "invalid_order_status": ("orders", "Status outside the accepted ones"),
    "negative_inventory": ("inventory", "Closing quantity below zero"),
    "payment_amount_mismatch": ("payments", "Amount differs from the order total"),
    "duplicate_payments": ("payments", "Whole rows sent twice"),
    "late_shipment_date": ("shipments", "Shipped on the day of delivery"),
}

KEYS = {
    "orders": "order_id",
    "order_items": "order_item_id",
    "payments": "payment_id",
    "refunds": "refund_id",
    "customers": "customer_id",
    "products": "product_id",
    "inventory": "inventory_id",
    "shipments": "shipment_id",
}


def draw(key: Column, name: str, seed: int = SEED) -> Column:
    """A number from 0 to 2^32 - 1 that depends on the key, the defect and the seed only."""
    text = F.concat(key.cast("string"), F.lit(f"|{name}|{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def picked(key: Column, name: str, share: float = DEFECT_SHARE, seed: int = SEED) -> Column:
    return draw(key, name, seed) < F.lit(int(RATES[name] * share * 2**32))


def key_of(name: str) -> Column:
    """What the draw of a defect depends on."""
    # Drawn per copy, after the copies were made, so the copies of one order can differ.
    copies = F.concat_ws("#", F.col("order_id").cast("string"), F.col("_copy").cast("string"))
    return copies if name == "invalid_order_status" else F.col(KEYS[DATASETS[name][0]])


def _or_rate(pick: Column | None, name: str) -> Column:
    return picked(key_of(name), name) if pick is None else pick


def draw_sizes(rows: DataFrame, name: str, seed: int = SEED) -> dict[int | None, int]:
    """How many rows have each value of the upper 16 bits of their draw, and, under None, how many have no key."""
    bits = F.shiftright(draw(key_of(name), name, seed), 16)
    # At most 65 537 rows.
    return {r["bits"]: r["n"] for r in rows.groupBy(bits.alias("bits")).agg(F.count("*").alias("n")).collect()}


def _reached(sizes: dict[int, int], number: int) -> tuple[int, int]:
    """The bits at which the number is reached in ascending order, and how many of their rows are still needed."""
    for bits in sorted(sizes):
        if number <= sizes[bits]:
            return bits, number
        number -= sizes[bits]
    raise ValueError("fewer rows than wanted")


def least_draws(rows: DataFrame, name: str, number: int, seed: int = SEED, sizes: dict[int | None, int] | None = None) -> Column:
    """A condition that ``number`` of the rows meet, or all if there are fewer: those with the least draws, of equal ones
    those with the least keys as text. Keys have to be unique.

    The draws are counted by their upper 16 bits (``sizes``, if that was done before) and, where the wanted number is
    reached, by the lower 16. So two histograms of at most 65 536 rows find the last draw, and only where several rows have
    just that draw, about one in four billion, and not all are wanted, are these put in order. Rows without a key are never
    picked.
    """
    if number <= 0:
        return F.lit(False)
    sizes = {bits: n for bits, n in (sizes or draw_sizes(rows, name, seed)).items() if bits is not None}
    if number > sum(sizes.values()):
        return key_of(name).isNotNull()
    high, left = _reached(sizes, number)
    drawn = rows.select(draw(key_of(name), name, seed).alias("d"), key_of(name).cast("string").alias("k"))
    found = drawn.where(F.shiftright("d", 16) == high).groupBy("d").agg(F.count("*").alias("n"), F.min("k"), F.max("k")).collect()
    last, left = _reached({r["d"]: r["n"] for r in found}, left)
    _, n, least, greatest = next(r for r in found if r["d"] == last)
    if left in (1, n):
        key = least if left == 1 else greatest
    else:
        key = drawn.where(F.col("d") == last).orderBy("k").limit(left).agg(F.max("k")).first()[0]
    mine = draw(key_of(name), name, seed)
    return (mine < last) | ((mine == last) & (key_of(name).cast("string") <= key))


def wanted(rows: int, name: str, share: float = DEFECT_SHARE) -> int:
    """How many rows get a defect: the share, rounded down, but at least one."""
    return max(1, int(rows * share * RATES[name]))


def exact_picks(clean: dict[str, DataFrame], share: float = DEFECT_SHARE, seed: int = SEED) -> dict[str, Column]:
    """For each defect a condition that exactly :func:`wanted` rows of its clean dataset meet; for the status those of the
    orders with their copies, and for the late shipments those of the delivered ones."""
    picks: dict[str, Column] = {}
    for name, (dataset, _) in DATASETS.items():
        rows = clean[dataset]
        if name == "invalid_order_status":
            rows = duplicate_orders(rows, picks["duplicate_orders"])
        if name == "late_shipment_date":
            rows = rows.where(F.col("delivered_date").isNotNull())
        sizes = draw_sizes(rows, name, seed)
        picks[name] = least_draws(rows, name, wanted(sum(sizes.values()), name, share), seed, sizes)
    return picks


def _scaled(amount: str, tenths_of_permille: Column) -> Column:
    factor = (tenths_of_permille.cast("decimal(6,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(6,4)")
    return (F.col(amount) * factor).cast("decimal(18,2)")


def _twice(df: DataFrame, pick: Column) -> DataFrame:
    copies = F.when(pick, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(copies))


def _replace(df: DataFrame, column: str, pick: Column, value: Column) -> DataFrame:
    kept = F.col(column)
    if isinstance(value, str):
        value = F.lit(value)
    return df.withColumn(column, F.when(pick, value.cast(df.schema[column].dataType)).otherwise(kept))


def duplicate_orders(orders: DataFrame, pick: Column | None = None) -> DataFrame:
    return _twice(orders, _or_rate(pick, "duplicate_orders"))


def invalid_order_status(orders_with_copies: DataFrame, pick: Column | None = None) -> DataFrame:
    # Drawn per copy, after the copies were made, so the copies of one order can differ.
    return _replace(orders_with_copies, "order_status", _or_rate(pick, "invalid_order_status"), F.lit(BAD_STATUS))


def orphan_order_items(items: DataFrame, pick: Column | None = None) -> DataFrame:
    keyed = items.withColumn("order_id", F.col("order_id").cast("string"))
    return _replace(keyed, "order_id", _or_rate(pick, "orphan_order_items"), F.lit(NO_ORDER_ITEM))


def orphan_payments(payments: DataFrame, pick: Column | None = None) -> DataFrame:
    keyed = payments.withColumn("order_id", F.col("order_id").cast("string"))
    return _replace(keyed, "order_id", _or_rate(pick, "orphan_payments"), F.lit(NO_ORDER_PAYMENT))


def payment_amount_mismatch(payments: DataFrame, pick: Column | None = None) -> DataFrame:
    factor = F.lit(8000) + draw(F.col("payment_id"), "payment_factor") % 1500  # 0.80 up to 0.95
    return _replace(payments, "amount", _or_rate(pick, "payment_amount_mismatch"), _scaled("amount", factor))


def duplicate_payments(payments: DataFrame, pick: Column | None = None) -> DataFrame:
    return _twice(payments, _or_rate(pick, "duplicate_payments"))


def refund_exceeds_payment(refunds: DataFrame, pick: Column | None = None) -> DataFrame:
    factor = F.lit(11000) + draw(F.lit("all"), "refund_factor") % 9000  # one factor from 1.1 up to 2.0
    return _replace(refunds, "amount", _or_rate(pick, "refund_exceeds_payment"), _scaled("amount", factor))


def null_customer_email(customers: DataFrame, pick: Column | None = None) -> DataFrame:
    return _replace(customers, "email", _or_rate(pick, "null_customer_email"), F.lit(None))


def null_product_sku(products: DataFrame, pick: Column | None = None) -> DataFrame:
    return _replace(products, "sku", _or_rate(pick, "null_product_sku"), F.lit(None))


def negative_inventory(inventory: DataFrame, pick: Column | None = None) -> DataFrame:
    return _replace(inventory, "closing_qty", _or_rate(pick, "negative_inventory"), -F.abs("closing_qty"))


def late_shipment_date(shipments: DataFrame, pick: Column | None = None) -> DataFrame:
    chosen = _or_rate(pick, "late_shipment_date") & F.col("delivered_date").isNotNull()
    return _replace(shipments, "shipped_date", chosen, F.col("delivered_date"))


def inject(clean: dict[str, DataFrame], picks: dict[str, Column] | None = None) -> dict[str, DataFrame]:
    """All defects on a set of clean entities, keyed by entity name; entities without defects pass through. ``picks`` may
    say which rows get them, else it is the rate."""
    made, pick = dict(clean), (picks or {}).get
    for name, defect in DEFECTS.items():
        dataset = DATASETS[name][0]
        made[dataset] = defect(made[dataset], pick(name))
    return {name: frame.drop("_copy") for name, frame in made.items()}


# In the order in which they are made: copies last for payments, before the states for orders.
DEFECTS = {
    "duplicate_orders": duplicate_orders,
    "invalid_order_status": invalid_order_status,
    "orphan_order_items": orphan_order_items,
    "orphan_payments": orphan_payments,
    "payment_amount_mismatch": payment_amount_mismatch,
    "duplicate_payments": duplicate_payments,
    "refund_exceeds_payment": refund_exceeds_payment,
    "null_customer_email": null_customer_email,
    "null_product_sku": null_product_sku,
    "negative_inventory": negative_inventory,
    "late_shipment_date": late_shipment_date,
}


def affected(clean: dict[str, DataFrame], picks: dict[str, Column]) -> DataFrame:
    """How many rows each defect was wanted for and how many it gets."""
    parts = []
    for name in DEFECTS:
        rows = clean[DATASETS[name][0]]
        if name == "invalid_order_status":
            rows = duplicate_orders(rows, picks["duplicate_orders"])
        if name == "late_shipment_date":
            rows = rows.where(F.col("delivered_date").isNotNull())
        share = F.floor(F.count("*") * F.lit(DEFECT_SHARE) * F.lit(RATES[name]))
        wish = F.greatest(share, F.lit(1)).cast("long").alias("wanted")
        parts.append(rows.agg(wish, F.count_if(picks[name]).alias("affected")).select(F.lit(name).alias("defect_type"), "*"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def defect_report(clean: dict[str, DataFrame]) -> DataFrame:
    """How many records each defect touches, counted in one pass per dataset."""
    orders = duplicate_orders(clean["orders"])
    copy_key = F.concat_ws("#", F.col("order_id").cast("string"), F.col("_copy").cast("string"))
    counts = {
        "orders": (
            orders,
            {
                "duplicate_orders": F.col("_copy") == 1,
                "invalid_order_status": picked(copy_key, "invalid_order_status"),
            },
        ),
        "order_items": (clean["order_items"], {"orphan_order_items": picked(F.col("order_item_id"), "orphan_order_items")}),
        "payments": (
            duplicate_payments(clean["payments"]),
            {
                "orphan_payments": picked(F.col("payment_id"), "orphan_payments") & (F.col("_copy") == 0),
                "payment_amount_mismatch": picked(F.col("payment_id"), "payment_amount_mismatch") & (F.col("_copy") == 0),
                "duplicate_payments": F.col("_copy") == 1,
            },
        ),
        "refunds": (clean["refunds"], {"refund_exceeds_payment": picked(F.col("refund_id"), "refund_exceeds_payment")}),
        "customers": (clean["customers"], {"null_customer_email": picked(F.col("customer_id"), "null_customer_email")}),
        "products": (clean["products"], {"null_product_sku": picked(F.col("product_id"), "null_product_sku")}),
        "inventory": (clean["inventory"], {"negative_inventory": picked(F.col("inventory_id"), "negative_inventory")}),
        "shipments": (
            clean["shipments"],
            {
                "late_shipment_date": picked(F.col("shipment_id"), "late_shipment_date")
                & F.col("delivered_date").isNotNull()
            },
        ),
    }
    whole = None
    for dataset, (df, conditions) in counts.items():
        row = df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
        entries = [
            F.struct(
                F.lit(n).alias("defect_type"),
                F.lit(dataset).alias("dataset"),
                F.col(n).alias("affected"),
                F.lit(DATASETS[n][1]).alias("description"),
            )
            for n in conditions
        ]
        part = row.select(F.inline(F.array(*entries)))
        whole = part if whole is None else whole.unionByName(part)
    return whole
