from __future__ import annotations

import re
import time
from pathlib import Path

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.plans import catalog, quality
from ledgerline.plans.loading import CheckedLoad
from ledgerline.sources.fixtures import FixtureSource
from ledgerline.sources.layer import Layer

CONF = (session.INITIAL, *session.TASK_SIZES)


@pytest.fixture
def unsized(spark):
    """A session without settings of its own; what it had is put back."""
    had = {key: spark.conf.get(key, None) for key in CONF}
    for key in CONF:
        spark.conf.unset(key)
    yield spark
    for key, value in had.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def partitions(df) -> set[int]:
    return set(map(int, re.findall(r"hashpartitioning\([^)]*, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())))


def test_shuffles_grow_with_the_files(unsized, monkeypatch):
    source = FixtureSource(unsized, TESTDATA)
    plain = int(unsized.conf.get("spark.sql.shuffle.partitions"))
    assert partitions(source.table("orders").groupBy("o_custkey").count()) == {plain}
    monkeypatch.setattr(session, "FILE_BYTES_PER_PARTITION", 1000)
    counted = source.table("orders").groupBy("o_custkey").count()
    (many,) = partitions(counted)
    assert many > plain and many == int(unsized.conf.get(session.INITIAL))
    # A smaller table does not take the partitions away again.
    assert partitions(source.table("region").groupBy("r_name").count()) == {many}
    assert counted.count() == source.table("orders").select("o_custkey").distinct().count()


def test_a_number_of_partitions_has_a_bound(unsized, monkeypatch):
    monkeypatch.setattr(session, "FILE_BYTES_PER_PARTITION", 1)
    monkeypatch.setattr(session, "MOST_PARTITIONS", 9)
    FixtureSource(unsized, TESTDATA).table("orders")
    assert unsized.conf.get(session.INITIAL) == "9"


def test_rows_outside_files_call_for_no_partitions(unsized):
    session.sized(unsized.createDataFrame([(1,)], "a long"))
    session.sized(unsized.createDataFrame(unsized.sparkContext.parallelize([(1,)]), "a long"))
    assert unsized.conf.get(session.INITIAL, None) is None


def test_sizes_of_the_session_stay(unsized):
    key = "spark.sql.files.maxPartitionBytes"
    unsized.conf.set(key, "7m")
    FixtureSource(unsized, TESTDATA).table("orders")
    assert unsized.conf.get(key) == "7m"
    assert unsized.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16MB"


def test_layer_tables_are_sized_too(unsized, tmp_path, monkeypatch):
    layer = Layer(unsized, str(tmp_path))
    layer.load(unsized.range(5000), "numbers")
    monkeypatch.setattr(session, "FILE_BYTES_PER_PARTITION", 100)
    assert layer.table("numbers").count() == 5000
    assert int(unsized.conf.get(session.INITIAL)) > int(unsized.conf.get("spark.sql.shuffle.partitions"))


def test_written_tables_are_small(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "layer"))
    layer.load(spark.range(10), "numbers")
    warehouse = catalog.open_warehouse(spark, TESTDATA).copy()
    warehouse.materialise(("stg_payouts",), str(tmp_path / "tables"))
    files = [p.name for p in tmp_path.rglob("*.parquet") if p.name.startswith("part-") and "log" not in p.parts]
    assert len(files) > 1 and all(".zstd." in name for name in files)


def test_checks_that_run_alone_share_staged_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    found = {r.check_id: r.status for r in quality.broken_table(catalog.open_warehouse(spark, TESTDATA)).collect()}
    assert found.pop("uniq_002") == found.pop("comp_001") == "ERROR" and "ERROR" not in found.values()
    assert {p.name for p in (tmp_path / "staged").iterdir()} == set(quality.SHARED_TABLES)


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*")}


def left_behind(spark, job) -> set[str]:
    """The shuffle files a job leaves; they are deleted in the background."""
    before = shuffle_files(spark)
    job()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_written_steps_leave_no_shuffle_files(spark, tmp_path):
    def counts():
        return spark.range(5000).groupBy((F.col("id") % 50).alias("k")).count()

    made = counts()
    assert left_behind(spark, made.collect)
    layer = Layer(spark, str(tmp_path / "layer"))
    assert not left_behind(spark, lambda: layer.load(counts(), "numbers"))
    dated = counts().withColumn("day", F.expr("date_add(date'2024-01-01', cast(k as int))"))
    assert not left_behind(spark, lambda: layer.load(dated, "dated", dated_by="day"))
    warehouse = catalog.open_warehouse(spark, TESTDATA).copy()
    assert not left_behind(spark, lambda: warehouse.materialise(("stg_orders",), str(tmp_path / "tables")))
    assert not left_behind(spark, lambda: CheckedLoad(warehouse, str(tmp_path / "checked")).write("made", counts()))
    # Frames made before or after keep theirs, and the setting is what it was.
    assert left_behind(spark, counts().collect) and spark.conf.get(session.FREED, None) is None
    assert made.count() == layer.count("numbers") == 50


def test_broadcasts_are_bounded_by_more_than_the_files(unsized, tmp_path, monkeypatch):
    """A table is broadcast by three times the size of its files, while shuffles are still sized by the files."""
    spark, limit = unsized, "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.unset(session.FACTOR)
    spark.range(100_000).selectExpr("id", "id as other").write.parquet(str(tmp_path / "rows"))
    plain = int(str(spark.read.parquet(str(tmp_path / "rows"))._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    had = spark.conf.get(limit)

    def plan(threshold):
        spark.conf.set(limit, str(threshold))
        rows = spark.read.parquet(str(tmp_path / "rows"))
        text = rows.join(rows.withColumnRenamed("other", "name"), "id")._jdf.queryExecution().executedPlan().toString()
        return "BroadcastHashJoin" in text

    try:
        assert plan(2 * plain)
        session.prepare(spark)
        assert not plan(2 * plain) and plan(4 * plain)
        assert session.file_bytes(spark.read.parquet(str(tmp_path / "rows"))) == plain
        spark.conf.set(session.FACTOR, "1.5")
        session.prepare(spark)
        assert plan(2 * plain)
    finally:
        spark.conf.set(limit, had)
        spark.conf.unset(session.FACTOR)
        session.prepare(spark)
