"""The model graph: names resolve to DataFrames, lazily and once per session."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.dedup import slice_of
from ledgerline.plans import intermediate, marts, metrics, staging
from ledgerline.session import CODEC, freed, prepare, sized
from ledgerline.settings import Settings

LAYERS = {
    "staging": (
        "stg_customers",
        "stg_products",
        "stg_orders",
        "stg_order_items",
        "stg_payments",
        "stg_refunds",
        "stg_shipments",
        "stg_inventory",
        "stg_ad_spend",
        "stg_payouts",
    ),
    "intermediate": (
        "int_order_revenue",
        "int_customer_orders",
        "int_product_sales",
        "int_payment_reconciliation",
        "int_campaign_performance",
        "int_inventory_movements",
    ),
    "marts": (
        "dim_date",
        "dim_customer",
        "dim_product",
        "dim_channel",
        "dim_warehouse",
        "fct_orders",
        "fct_order_items",
        "fct_payments",
        "fct_refunds",
        "fct_inventory",
        "fct_shipments",
        "fct_ad_spend",
        "fct_payouts",
        "mart_sales",
        "mart_customer",
        "mart_marketing",
        "mart_inventory",
        "mart_finance",
    ),
}
# Shared sub-results that are not tables of their own.
HELPERS = ("customer_history", "clean_order_items", "completed_refunds", "completed_payments", "sold_lines")
# Sums over facts; metrics are read from them where they are given as tables.
ROLLUPS = ("daily_sums", "stock_days")


def _functions() -> dict[str, Callable[..., DataFrame]]:
    names = {n for layer in LAYERS.values() for n in layer} | set(HELPERS) | set(ROLLUPS)
    return {n: getattr(m, n) for m in (staging, intermediate, marts, metrics) for n in names if hasattr(m, n)}


MODELS = _functions()


class Warehouse:
    """Resolves ``raw_*`` names against a source and every other name against the model functions.

    A model's parameter names are its inputs. Nothing runs until a caller acts on a frame, so Catalyst sees the
    whole chain from the scan to the output as one plan; :meth:`materialise` cuts it at written tables.
    """

    def __init__(self, spark: SparkSession, source, settings: Settings | None = None) -> None:
        self.spark = prepare(spark)
        self.source = source
        self.settings = settings or Settings()
        self._frames: dict[str, DataFrame] = {}
        self._given: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._given:
            return self._given[name]
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.source.raw(name.removeprefix("raw_"))
        if name not in MODELS:
            raise KeyError(f"no model named {name}")
        return self.run(MODELS[name])

    def run(self, model: Callable[..., DataFrame]) -> DataFrame:
        """Call a model function with its inputs filled in by name."""
        given = {"spark": self.spark, "settings": self.settings, "warehouse": self}
        return model(**{p: given.get(p) if p in given else self[p] for p in inspect.signature(model).parameters})

    def replace(self, name: str, df: DataFrame) -> None:
        """Use ``df`` for ``name`` from now on (tests, written tables); models built on it are rebuilt.

        Rollups given before are of other rows, so they are given up unless it is a rollup that is replaced.
        """
        if name not in ROLLUPS:
            for rollup in ROLLUPS:
                self._given.pop(rollup, None)
        self._given[name] = df
        self._frames.clear()

    def given(self, name: str) -> DataFrame | None:
        """The table that was given for ``name``, if there is one."""
        return self._given.get(name)

    def copy(self) -> Warehouse:
        """A warehouse with the same inputs whose tables can be replaced without touching this one."""
        other = Warehouse(self.spark, self.source, self.settings)
        other._given = dict(self._given)
        return other

    def materialise(self, names: Iterable[str], folder: str) -> dict[str, str]:
        """Write models as Parquet below ``folder`` and read them from there afterwards.

        Models named first feed later ones from their files, so list upstream models first.
        """
        paths = {}
        for name in names:
            path = f"{folder.rstrip('/')}/{name}"
            with freed(self.spark):
                self[name].write.mode("overwrite").parquet(path, compression=CODEC)
            self.replace(name, sized(self.spark.read.parquet(path)))
            paths[name] = path
        return paths

    def materialise_sliced(self, name: str, key: str, slices: int, folder: str, columns: Iterable[str] | None = None) -> str:
        """The same for one model with a row per key, of which ``columns`` may be enough: one slice of the keys after the
        other, so that only a slice's shuffles are on disk at a time. Every slice reads what the model is made of."""
        path = f"{folder.rstrip('/')}/{name}"
        whole = self[name].select(*columns or self[name].columns)
        for number in range(slices):
            with freed(self.spark):
                slice_of(whole, key, number, slices).write.mode("append" if number else "overwrite").parquet(path, compression=CODEC)
        self.replace(name, sized(self.spark.read.schema(whole.schema).parquet(path)))
        return path

    def save_tables(
        self, names: Iterable[str], database: str, folder: str, buckets: dict[str, tuple[str, int]] | None = None
    ) -> None:
        """Write models as catalog tables and read them from there afterwards.

        ``buckets`` maps a table to its bucket column and count. Tables bucketed alike on a key, say orders, items,
        payments and refunds on ``order_id``, are later joined and summed on it without a shuffle.
        """
        self.spark.sql(f"create database if not exists {database}")
        for name in names:
            table = f"{database}.{name}"
            writer = self[name].write.mode("overwrite").format("parquet").option("path", f"{folder.rstrip('/')}/{name}")
            if buckets and name in buckets:
                column, count = buckets[name]
                writer = writer.bucketBy(count, column).sortBy(column)
            writer.saveAsTable(table)
            self.replace(name, self.spark.table(table))

    def register_views(self, names: Iterable[str] | None = None) -> None:
        """Temp views for SQL over any layer."""
        for name in names or [n for layer in LAYERS.values() for n in layer]:
            self[name].createOrReplaceTempView(name)

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text)
