"""Versioned tables: commits, replacement of parts, what is left when a job ends early, and what reads open."""

from __future__ import annotations

import hashlib
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from ledgerline.functions.columns import hash_bytes
from ledgerline.operators.changes import changes
from ledgerline.operators.dedup import latest_by
from ledgerline.sources import ingest
from ledgerline.sources.fixtures import FixtureSource
from ledgerline.sources.layer import Layer, NoTable, RawLayer, SchemaChanged

ROWS = "id long, day date, note string"


def d(text: str) -> date:
    return date.fromisoformat(text)


@pytest.fixture
def layer(spark, tmp_path):
    return Layer(spark, str(tmp_path / "layer"))


@pytest.fixture
def rows(spark):
    def make(*given):
        return spark.createDataFrame([(i, d(day) if day else None, note) for i, day, note in given], ROWS)

    return make


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def files_of(frame) -> set[str]:
    return set(frame.inputFiles())


def test_versions(layer, rows):
    assert not layer.exists("t") and layer.count("t") == 0 and layer.version("t") == 0
    with pytest.raises(NoTable):
        layer.table("t")
    assert layer.load(rows((1, "2024-01-05", "a"), (2, "2024-02-01", "b")), "t", dated_by="day", batch="B1") == 2
    assert layer.load(rows((3, "2024-02-09", "c")), "t", dated_by="day") == 1
    assert layer.load(rows((9, "2025-01-01", "z")), "t", replace=True, dated_by="day") == 1
    assert [ids(layer.table("t", v)) for v in (1, 2, 3)] == [[1, 2], [1, 2, 3], [9]]
    assert layer.count("t") == 1 and layer.version("t") == 3 and layer.table("t").columns == ["id", "day", "note"]
    log = [(c.version, c.mode, c.rows, c.batch, c.low, c.high) for c in layer.commits("t").orderBy("version").collect()]
    assert log[0] == (1, "append", 2, "B1", "2024-01-05", "2024-02-01") and log[2][:3] == (3, "replace", 1)


def test_high_water(layer, rows):
    assert layer.high_water("t") is None
    layer.load(rows((1, "2024-03-05", "a")), "t", dated_by="day")
    layer.load(rows((2, "2024-01-05", "b"), (3, None, "c")), "t", dated_by="day")
    assert layer.high_water("t") == d("2024-03-05")
    layer.load(rows((4, None, "d")), "t", replace=True, dated_by="day")
    assert layer.high_water("t") is None and ids(layer.table("t")) == [4]


def test_reads_open_only_the_parts_they_need(layer, rows):
    layer.load(rows(*[(i, f"2024-{i:02d}-10", "x") for i in range(1, 13)]), "t", dated_by="day")
    late = layer.table("t", since=d("2024-11-20"))
    assert ids(late) == [12]
    assert "PartitionFilters: [isnotnull(_part" in plan(late) and "(_part" in plan(late).split("PartitionFilters")[1]
    some = layer.table("t", parts=[d("2024-03-01"), d("2024-05-01"), d("2030-01-01")])
    assert ids(some) == [3, 5] and len(files_of(some)) == 2
    assert layer.table("t", parts=[]).count() == 0


def test_parts_are_replaced_at_once(layer, rows):
    layer.load(rows((1, "2024-01-05", "a"), (2, "2024-02-01", "b"), (3, "2024-03-01", "c"), (4, None, "n")), "t", dated_by="day")
    untouched = files_of(layer.table("t", parts=[d("2024-01-01")]))
    layer.load(rows((5, "2024-02-03", "d")), "t", dated_by="day", parts=[d("2024-02-01"), d("2024-03-01")])
    assert ids(layer.table("t")) == [1, 4, 5] and layer.count("t") == 3
    assert ids(layer.table("t", 1)) == [1, 2, 3, 4]
    assert files_of(layer.table("t", parts=[d("2024-01-01")])) == untouched
    layer.load(rows((6, None, "m")), "t", dated_by="day", parts=["__HIVE_DEFAULT_PARTITION__"])
    assert ids(layer.table("t")) == [1, 5, 6]
    layer.load(rows(), "t", dated_by="day", parts=[d("2024-01-01")])
    assert ids(layer.table("t")) == [5, 6] and layer.count("t") == 2
    with pytest.raises(ValueError, match="outside the parts"):
        layer.load(rows((7, "2024-06-01", "x")), "t", dated_by="day", parts=[d("2024-01-01")])
    assert ids(layer.table("t")) == [5, 6]


@pytest.mark.parametrize("grain, since, left", [("day", "2024-05-05", [2, 3]), ("year", "2024-05-05", [2, 3]), ("month", "2025-01-01", [3])])
def test_grains(spark, tmp_path, rows, grain, since, left):
    layer = Layer(spark, str(tmp_path), grain)
    layer.load(rows((1, "2024-05-04", "a"), (2, "2024-05-05", "b"), (3, "2025-02-01", "c")), "t", dated_by="day")
    assert ids(layer.table("t", since=d(since))) == left


def test_a_load_that_ends_before_its_commit_leaves_the_table(layer, rows, monkeypatch):
    """Rows are written but not committed: the old version stays what is read, and the next load is as if nothing was."""
    layer.load(rows((1, "2024-01-05", "a")), "t", dated_by="day")
    with monkeypatch.context() as m:
        m.setattr(layer, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        for how in (dict(replace=True), dict(), dict(parts=[d("2024-01-01")])):
            with pytest.raises(RuntimeError):
                layer.load(rows((2, "2024-01-06", "b")), "t", dated_by="day", **how)
    assert ids(layer.table("t")) == [1] and layer.version("t") == 1
    layer.load(rows((3, "2024-01-07", "c")), "t", replace=True, dated_by="day")
    assert ids(layer.table("t")) == [3]
    # What was left behind goes, and with it the replaced version.
    assert len(layer.clear("t")) == 4 and layer.clear("t") == [] and ids(layer.table("t")) == [3]
    assert layer.clear("absent") == []


def test_declared_schema(layer, rows, spark):
    layer.load(rows((1, "2024-01-05", "a")), "t", dated_by="day")
    with pytest.raises(SchemaChanged, match="note int"):
        layer.load(rows((2, "2024-01-05", "b")).withColumn("note", F.lit(1)), "t", dated_by="day")
    with pytest.raises(SchemaChanged):
        layer.load(rows((2, "2024-01-05", "b")).select("note", "id", "day"), "t", dated_by="day")
    with pytest.raises(SchemaChanged, match="dated by day"):
        layer.load(rows((2, "2024-01-05", "b")), "t")
    assert layer.table("t").schema.simpleString() == "struct<id:bigint,day:date,note:string>"
    layer.load(rows((2, "2024-01-05", "b")).drop("note"), "t", replace=True, dated_by="day")
    assert layer.table("t").columns == ["id", "day"]


def test_ids_that_look_like_numbers_stay_texts(spark, layer):
    frame = spark.createDataFrame([("1e5", 1), ("007", 2)], "id string, n int")
    layer.load(frame, "t")
    layer.load(frame, "t")
    assert sorted(r["id"] for r in layer.table("t").collect()) == ["007", "007", "1e5", "1e5"]


def test_empty_loads(layer, rows):
    assert layer.load(rows(), "t", dated_by="day") == 0
    assert layer.table("t").count() == 0 and layer.count("t") == 0
    layer.load(rows((1, "2024-01-05", "a")), "t", dated_by="day")
    assert layer.load(rows((1, "2024-01-05", "a")).where("id > 5"), "t", dated_by="day") == 0
    assert ids(layer.table("t")) == [1]


# -- incremental runs ---------------------------------------------------------------------------------------


class DatedFiles:
    """A feed of orders in folders by date."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.seen = spark, folder, None

    def feed(self, entity):
        return self.spark.read.parquet(f"{self.folder}/{entity}")


def test_a_second_run_reads_and_writes_new_dates_only(spark, tmp_path, monkeypatch):
    source = FixtureSource(spark, TESTDATA)
    orders = source.feed("orders").withColumn("order_date", F.trunc("order_date", "MM"))
    early = orders.where("order_date < '2000-05-01'")
    inbox = str(tmp_path / "inbox")
    feed, layer = DatedFiles(spark, inbox), RawLayer(spark, str(tmp_path / "raw"))
    early.write.partitionBy("order_date").parquet(f"{inbox}/orders")
    ingest.run_connector(feed, "c", ("orders",), layer, resume=True)
    assert layer.count("raw_orders") == early.count()
    orders.where("order_date >= '2000-05-01'").write.mode("append").partitionBy("order_date").parquet(f"{inbox}/orders")
    plans = []
    load = layer.load
    monkeypatch.setattr(layer, "load", lambda df, *a, **k: (plans.append(plan(df)), load(df, *a, **k))[1])
    assert ingest.run_connector(feed, "c", ("orders",), layer, resume=True)[0][-1] == "loaded"
    filters = plans[0].split("PartitionFilters: [")[1]
    assert "order_date" in filters.split("]")[0] and "2000-04-02" in plans[0] or ">= 11049" in plans[0]
    assert layer.count("raw_orders") == orders.count()
    second = layer.commits("raw_orders").where("version = 2").first()
    assert second.low == "2000-05-01" and all(part >= "2000-05-01" for part in second.held)
    assert ingest.run_connector(feed, "c", ("orders",), layer, resume=True)[0][3:] == (0, "loaded")


def test_overlap_reads_late_rows_again(spark, tmp_path):
    source, layer = FixtureSource(spark, TESTDATA), RawLayer(spark, str(tmp_path))
    n = source.feed("refunds").count()
    ingest.run_connector(source, "p", ("refunds",), layer, resume=True)
    last = ingest.run_connector(source, "p", ("refunds",), layer, resume=True, overlap=30)[0][3]
    assert 0 < last < n
    assert layer.count("raw_refunds") == n + last


def test_two_connectors_of_one_table_resume_from_the_same_mark(spark, tmp_path):
    source, layer = FixtureSource(spark, TESTDATA), RawLayer(spark, str(tmp_path))
    connectors = (("google_ads", ("advertising",)), ("meta_ads", ("advertising",)))
    ads = source.feed("advertising").count()
    outcome = ingest.run_pipeline(source, layer, full_reload=False, connectors=connectors, resume=True)
    assert [r.rows_loaded for r in outcome.collect()] == [ads, ads]
    with pytest.raises(ValueError):
        ingest.run_pipeline(source, layer, resume=True)


def test_files_are_loaded_once(spark, tmp_path, monkeypatch):
    orders = FixtureSource(spark, TESTDATA).feed("orders")
    layer, inbox = RawLayer(spark, str(tmp_path / "raw")), str(tmp_path / "inbox")
    with pytest.raises(ingest.ConnectorError):
        ingest.load_new_files(layer, inbox, "orders", orders.schema)
    first, late = orders.where("order_date >= '1999-01-01'"), orders.where("order_date < '1999-01-01'")
    first.write.parquet(f"{inbox}/a")
    with monkeypatch.context() as m:
        m.setattr(layer, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            ingest.load_new_files(layer, inbox, "orders", orders.schema)
    assert ingest.load_new_files(layer, inbox, "orders", orders.schema) == first.count()
    assert ingest.load_new_files(layer, inbox, "orders", orders.schema) == 0
    # Files with older dates are as new as any.
    late.write.parquet(f"{inbox}/b")
    assert ingest.load_new_files(layer, inbox, "orders", orders.schema) == late.count()
    assert layer.count("raw_orders") == orders.count()
    assert layer.files("raw_orders").count() == len(list(Path(inbox).rglob("*.parquet")))


# -- change sets --------------------------------------------------------------------------------------------


def stamped(spark, rows, when=1, batch="B1"):
    frame = spark.createDataFrame(rows, "id long, day date, note string")
    return ingest.with_metadata(frame, "t", batch, datetime(2024, 1, when, tzinfo=timezone.utc))


def test_changes(spark):
    before = stamped(spark, [(1, None, "same"), (2, None, "old"), (3, None, "gone"), (None, None, "no key"), (5, None, "x")])
    after = stamped(spark, [(1, None, "same"), (2, None, "new"), (4, None, "here"), (None, None, "other"), (5, None, None)], 2, "B2")
    found = {(r.id, r.change, r.note_before, r.note_after) for r in changes(before, after, "id", ("note",)).collect()}
    assert found == {(2, "update", "old", "new"), (3, "delete", "gone", None), (4, "insert", None, "here"), (5, "update", "x", None)}


def test_only_the_newest_row_of_a_key_counts(spark):
    before = stamped(spark, [(1, None, "first")]).unionByName(stamped(spark, [(1, None, "second")], 3))
    assert changes(before, stamped(spark, [(1, None, "second"), (1, None, "second")], 9), "id").count() == 0
    assert changes(before, stamped(spark, [(1, None, "first")], 9), "id").count() == 1


def test_a_reload_of_equal_rows_changes_nothing(spark, tmp_path):
    source, layer = FixtureSource(spark, TESTDATA), RawLayer(spark, str(tmp_path))
    for _ in range(2):
        ingest.run_connector(source, "c", ("orders",), layer, replace=("raw_orders",))
    assert changes(layer.table("raw_orders", 1), layer.table("raw_orders"), "order_id").count() == 0


def test_change_sets_are_one_join_of_narrow_columns(spark, tmp_path):
    source, layer = FixtureSource(spark, TESTDATA), RawLayer(spark, str(tmp_path))
    for _ in range(2):
        ingest.run_connector(source, "c", ("orders",), layer, replace=("raw_orders",))
    found = changes(layer.table("raw_orders", 1), layer.table("raw_orders"), "order_id")
    text = plan(found)
    assert text.count("Exchange") == 2 and text.count("FullOuter") == 1
    assert "order_status" not in text and "total_amount" not in text


def test_finishing_columns_are_added_after_rows_have_moved(layer, rows):
    """The table is that of rows finished before, and the rows' exchange doesn't carry the column."""
    made = rows((1, "2024-01-05", "a"), (2, "2024-02-01", "b"), (3, None, "c"))
    seen = []

    def finish(frame):
        seen.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return frame.withColumn("digest", F.md5("note"))

    assert layer.load(made, "t", dated_by="day", finish=finish) == 3
    assert "RebalancePartitions" in seen[-1] and "md5" not in seen[-1]
    assert layer.table("t").columns == ["id", "day", "note", "digest"]
    assert sorted(layer.table("t").collect()) == sorted(made.withColumn("digest", F.md5("note")).collect(), key=lambda r: r.id)
    assert ids(layer.table("t", since=d("2024-01-20"))) == [2]
    with pytest.raises(SchemaChanged):
        layer.load(made, "t", dated_by="day")
    assert layer.load(made, "u", finish=finish) == 3 and layer.table("u").columns[-1] == "digest"


def test_hashes_as_bytes_keep_their_order(spark):
    texts = [(hashlib.md5(str(i).encode()).hexdigest(),) for i in range(300)] + [("x",), ("",), (None,)]
    frame = spark.createDataFrame(texts, "h string").withColumn("b", hash_bytes("h"))
    digests = frame.where(F.length("h") == 32)
    assert [r.h for r in digests.orderBy("b").collect()] == sorted(r.h for r in digests.collect())
    assert {len(r.b) for r in digests.collect()} == {16}
    assert frame.select("b").distinct().count() == 303


def test_dedup_and_changes_move_hashes_as_bytes(spark):
    columns = "id long, _ingested_at timestamp, _batch_id string, _record_hash string"
    now = datetime(2024, 1, 1)
    low, high = sorted(hashlib.md5(c).hexdigest() for c in (b"1", b"2"))
    before = spark.createDataFrame([(1, now, "b", low), (1, now, "b", high), (2, now, "b", low), (3, now, "b", None)], columns)
    after = spark.createDataFrame([(1, now, "b", high), (1, now, "b", low), (2, now, "b", high), (3, now, "b", None)], columns)
    assert latest_by(before, "id").where("id = 1").collect()[0]["_record_hash"] == high
    found = changes(before, after, "id")
    assert [(r.id, r.change) for r in found.where("id < 3").collect()] == [(2, "update")]
    assert "unhex" in plan(found)
