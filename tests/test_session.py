from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import TESTDATA

from ledgerline.plans import catalog
from ledgerline.session import shared_folder, shared_root
from ledgerline.sources.fixtures import FixtureSource

CODE = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from pyspark.sql import SparkSession
from ledgerline.plans import catalog
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
print(catalog.queries()["src_csv_products"](spark, {TESTDATA!r}).count())
"""


def test_a_plain_local_session_can_write(spark, tmp_path):
    """Without any configuration, also none of the site's, written tables go to a temporary folder."""
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", CODE], capture_output=True, text=True, env=env)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) == catalog.queries()["src_csv_products"](spark, TESTDATA).count()


def test_folders_are_fresh_and_below_one_root(spark):
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and one.startswith(shared_root(spark)) and two.startswith(shared_root(spark))


class Elsewhere:
    """A cluster's session without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        applicationId = "app"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_folder(monkeypatch, master):
    monkeypatch.setattr(Elsewhere.sparkContext, "master", master, raising=False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere, "x")


def test_feeds_take_keys_of_any_size(spark, tmp_path):
    """Orders from 10^10 on, parts and suppliers beyond the old field widths: ids stay apart and nothing overflows."""
    for name, keys in (("lineitem", ("l_orderkey", "l_partkey", "l_suppkey")), ("part", ("p_partkey",)),
                       ("orders", ("o_orderkey",))):
        table = spark.read.parquet(f"{TESTDATA}/{name}.parquet")
        raised = {k: table[k] + (10**16 if "order" in k else 10**8) for k in keys}
        table.withColumns(raised).write.parquet(str(tmp_path / f"{name}.parquet"))
    plain, large = FixtureSource(spark, TESTDATA), FixtureSource(spark, str(tmp_path))
    first = lambda source, entity: source.raw(entity).where("_batch_id = 1")
    items = first(large, "order_items")
    assert items.select("order_item_id").distinct().count() == first(plain, "order_items").select("order_item_id").distinct().count()
    assert items.count() == first(plain, "order_items").count()
    for entity, key in (("payments", "payment_id"), ("refunds", "refund_id")):
        ids = first(large, entity).select(key)
        assert ids.distinct().count() == ids.count()


def test_referential_checks_find_something(spark):
    checks = {r["check_id"]: r for r in catalog.queries()["dq_results"](spark, TESTDATA).collect()}
    assert checks["ref_003"]["records_failed"] > 0 and checks["ref_004"]["records_failed"] > 0
