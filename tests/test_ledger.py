"""The ledger of event ids: exact, and read only where its filters say so."""

from __future__ import annotations

import json

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from ledgerline.plans import catalog
from ledgerline.streaming import intake
from ledgerline.streaming.ledger import Ledger

REQUEST = "event_id string, signature string, received_at timestamp, body string"


def ids(spark, *ranges, prefix="id"):
    return spark.createDataFrame([(f"{prefix}{i}",) for r in ranges for i in r], "event_id string")


def found(frame):
    return {r["event_id"] for r in frame.collect()}


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "ledger"), buckets=16, bits=1 << 13)


def test_nothing_noted_yet(spark, ledger):
    assert ledger.empty() and found(ledger.repeated(ids(spark, range(5)), 3)) == set()
    ledger.compact(9)
    ledger.add(ids(spark), 0)
    assert found(ledger.repeated(ids(spark, range(5)), 3)) == set()


def test_repeats_are_found_exactly(spark, ledger):
    ledger.add(ids(spark, range(300)), 0)
    ledger.add(ids(spark, range(300, 500)), 1)
    ledger.add(ids(spark, range(500, 600)), 2)
    asked = ids(spark, range(250, 320), range(590, 700))
    assert found(ledger.repeated(asked, 3)) == {f"id{i}" for i in [*range(250, 320), *range(590, 600)]}
    # A trigger does not see itself or what came after it.
    assert found(ledger.repeated(asked, 1)) == {f"id{i}" for i in range(250, 300)}


def test_filters_never_miss_and_seldom_err(spark, ledger):
    ledger.add(ids(spark, range(3000)), 0)
    known = ids(spark, range(3000))
    assert ledger.perhaps(known, 1).count() == 3000
    # 3 000 ids in 16 filters of 8 192 bits: 44 bits each
    assert ledger.perhaps(ids(spark, range(10_000, 13_000)), 1).count() < 30


def test_a_filter_that_is_full_costs_reads_only(spark, tmp_path):
    small = Ledger(spark, str(tmp_path), buckets=2, bits=8)
    small.add(ids(spark, range(200)), 0)
    assert small.perhaps(ids(spark, range(1000, 1100)), 1).count() == 100
    assert found(small.repeated(ids(spark, range(150, 1100)), 1)) == {f"id{i}" for i in range(150, 200)}


@pytest.mark.parametrize("bits", [1 << 13, 1 << 17])
def test_only_buckets_that_may_hold_the_ids_are_read(spark, tmp_path, monkeypatch, bits):
    ledger = Ledger(spark, str(tmp_path), buckets=16, bits=bits)
    ledger.add(ids(spark, range(400)), 0)
    read = []
    look = ledger.ids
    monkeypatch.setattr(ledger, "ids", lambda *a: (read.append(look(*a)), read[-1])[1])
    assert found(ledger.repeated(ids(spark, [7], range(5000, 5040)), 1)) == {"id7"}
    wanted = read[-1]
    assert 0 < wanted.select("bucket").distinct().count() <= 2
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1]
    assert found(ledger.repeated(ids(spark, range(5000, 5005)), 1)) == set()
    assert read[-1].select("bucket").distinct().count() <= 1


def test_a_trigger_replaces_what_it_noted(spark, ledger):
    ledger.add(ids(spark, range(100)), 0)
    ledger.add(ids(spark, range(50)), 0)
    assert found(ledger.repeated(ids(spark, range(100)), 1)) == {f"id{i}" for i in range(50)}


def test_compaction(spark, ledger, monkeypatch):
    for batch in range(4):
        ledger.add(ids(spark, range(batch * 50, batch * 50 + 60)), batch)
    ledger.compact(3)
    batches = {r["batch"] for r in ledger.ids(99).select("batch").distinct().collect()}
    assert batches == {2, 3}
    assert found(ledger.repeated(ids(spark, range(400)), 3)) == {f"id{i}" for i in range(160)}
    assert found(ledger.repeated(ids(spark, range(400)), 4)) == {f"id{i}" for i in range(210)}
    ledger.compact(4)
    assert found(ledger.repeated(ids(spark, range(400)), 4)) == {f"id{i}" for i in range(210)}


def test_an_older_folder_gets_a_ledger(spark, tmp_path):
    """Events accepted before there was a ledger are noted before the first trigger is handled."""
    def request(event, minute):
        return (event, None, f"2024-01-01 00:{minute:02d}:00", json.dumps({"event_type": "order.created"}))

    schema = REQUEST.replace("received_at timestamp", "received_at string")
    make = lambda *rows: spark.createDataFrame(rows, schema).withColumn("received_at", F.to_timestamp("received_at"))
    folder = str(tmp_path)
    routed = intake.route(make(request("a", 1), request("b", 2)))
    intake.event_rows(intake.accepted(routed)).write.parquet(f"{folder}/accepted/batch=0")
    write = intake._ledger_writer(spark, folder, intake.DEVELOPMENT_SECRET, buckets=4, bits=1 << 12)
    write(make(request("b", 3), request("c", 4)), 1)
    kept = spark.read.parquet(f"{folder}/accepted")
    assert sorted(r["event_id"] for r in kept.collect()) == ["a", "b", "c"]


def test_registered_ids_agree(spark):
    """The ledger and the state store take in the same ids."""
    queries = catalog.queries()
    some = queries["wh_accepted"](spark, TESTDATA).select("event_id")
    state = queries["wh_ids_state"](spark, TESTDATA)
    assert some.exceptAll(state).count() == 0 and state.exceptAll(some).count() == 0
