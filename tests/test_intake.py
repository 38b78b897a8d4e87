from __future__ import annotations

import hashlib
import hmac
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.signing import signature, signed_by
from ledgerline.streaming import intake

REQUEST = "event_id string, signature string, received_at timestamp, body string"
START = datetime(2024, 1, 1)


def request(event_id, body, minute=0, given=None):
    text = body if isinstance(body, str) else json.dumps(body)
    return (event_id, given, START + timedelta(minutes=minute), text)


@pytest.mark.parametrize("secret", ["s", "fixture-secret", "x" * 64, "long" * 40])
def test_signature_is_hmac(spark, secret):
    bodies = ["", "{}", '{"a":"ü€"}', "x" * 500]
    got = spark.createDataFrame([(b,) for b in bodies], "body string").select(signature(F.col("body"), secret)).collect()
    want = ["sha256=" + hmac.new(secret.encode(), b.encode(), hashlib.sha256).hexdigest() for b in bodies]
    assert [r[0] for r in got] == want


def test_bad_signatures(spark):
    good = "sha256=" + hmac.new(b"k", b"{}", hashlib.sha256).hexdigest()
    df = spark.createDataFrame([(good,), (good[7:],), (None,), ("sha256=00",)], "given string").withColumn("body", F.lit("{}"))
    assert [r[0] for r in df.select(signed_by(F.col("body"), F.col("given"), "k")).collect()] == [True, False, False, False]


def test_routing(spark):
    rows = [
        request("1", {"event_type": "order.created", "source": "shop"}),
        request("2", {"event_type": "", "type": "order.updated"}),
        request("3", {"event_type": "refund.made"}),
        request("4", {"data": 1}),
        request("5", "{broken"),
        request("6", {"event_type": "order.created", "source": None}),
        request("7", {"type": "shipment.created", "source": ""}),
    ]
    routed = {r.event_id: r for r in intake.route(spark.createDataFrame(rows, REQUEST)).collect()}
    assert [routed[k].status_code for k in "1234567"] == [202, 202, 422, 422, 400, 202, 202]
    assert [routed[k].reason for k in "345"] == ["unknown_event_type", "missing_event_type", "invalid_json"]
    assert [routed[k].source for k in "1267"] == ["shop", "unknown", None, ""]
    signed = intake.route(spark.createDataFrame(rows, REQUEST), "secret").select("reason", "status_code").distinct().collect()
    assert [tuple(r) for r in signed] == [("bad_signature", 401)]


class Feed:
    """A folder of request files that a stream picks up."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)

    def add(self, *rows):
        self.spark.createDataFrame(rows, REQUEST).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(REQUEST).parquet(self.folder)


@pytest.mark.parametrize("repeats", ["ledger", "state", "watermark"])
def test_each_id_is_taken_once_over_several_runs(spark, tmp_path, repeats):
    feed = Feed(spark, tmp_path / "in")
    order = {"event_type": "order.created"}
    folders = (str(tmp_path / "out"), str(tmp_path / "checkpoint"))

    def run():
        return intake.run(spark, feed.stream(), *folders, repeats=repeats)[0]

    feed.add(request("a", order, 1), request("a", order, 2), request(None, order, 3), request(None, order, 3), request("b", "{"))
    first = run()
    assert sorted(r.event_id for r in first.collect() if len(r.event_id) == 1) == ["a"]
    assert first.count() == 3  # requests without an id are never repeats
    feed.add(request("a", order, 4), request("b", order, 5), request("c", {"event_type": "nope"}, 6))
    second = run()
    assert sorted(r.event_id for r in second.collect() if len(r.event_id) == 1) == ["a", "b"]
    assert run().count() == second.count() == 4  # nothing new, nothing added
    assert {r.processing_status for r in second.collect()} == {"pending"}


@pytest.mark.parametrize("repeats", ["ledger", "state", "watermark"])
def test_late_events_and_empty_ids_are_kept(spark, tmp_path, repeats):
    feed = Feed(spark, tmp_path / "in")
    order = {"event_type": "order.created"}
    day = 24 * 60
    folders = (str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    sent = 0
    for rows in (
        [request("a", order, 30 * day), request("", order, 1), request("", order, 1), request(None, order), request("x", "{")],
        # b is older than any watermark, a is an old repeat of what is still remembered, c comes twice
        [request("b", order, 0), request("c", order, 31 * day), request("c", order, 31 * day), request("a", order, 2), request("", order, 1)],
        [request("b", order, 1), request("d", order, 40 * day)],
    ):
        feed.add(*rows)
        sent += len(rows)
        kept, refused = intake.run(spark, feed.stream(), *folders, repeats=repeats, delay="7 days")
    ids = [r.event_id for r in kept.collect()]
    assert sorted(i for i in ids if len(i) == 1) == ["a", "b", "c", "d"]
    assert sum(len(i) > 1 for i in ids) == 4  # each request without an id has one of its own
    repeated = 3
    assert len(ids) + refused.count() + repeated == sent


def test_ids_are_forgotten_after_the_delay(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    order, day = {"event_type": "order.created"}, 24 * 60
    folders = (str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    for minute in (0, 30 * day):
        feed.add(request("a", order, minute), request(f"n{minute}", order, minute + 1))
        kept = intake.run(spark, feed.stream(), *folders, repeats="watermark", delay="7 days")[0]
    assert kept.where("event_id = 'a'").count() == 1  # the watermark only moves with what was accepted before
    feed.add(request("a", order, 31 * day), request("n0", order, 31 * day))
    kept = intake.run(spark, feed.stream(), *folders, repeats="watermark", delay="7 days")[0]
    assert sorted(r.event_id for r in kept.collect()) == ["a", "a", "n0", "n0", f"n{30 * day}"]


def test_earliest_request_wins_and_a_replayed_trigger_changes_nothing(spark, tmp_path):
    order = {"event_type": "order.created"}
    batch = spark.createDataFrame(
        [request("a", {**order, "n": 2}, 5), request("a", {**order, "n": 1}, 2), request("b", order, 9)], REQUEST
    )
    folder = str(tmp_path)
    spark.createDataFrame([], intake._ddl(intake.EVENT_COLUMNS)).write.parquet(f"{folder}/accepted/batch=-1")
    write = intake._ledger_writer(spark, folder, intake.DEVELOPMENT_SECRET)
    write(batch, 0)
    once = spark.read.parquet(f"{folder}/accepted").collect()
    write(batch, 0)
    assert sorted(spark.read.parquet(f"{folder}/accepted").collect()) == sorted(once)
    assert [json.loads(r.payload)["n"] for r in once if r.event_id == "a"] == [1]
    write(batch, 1)
    assert spark.read.parquet(f"{folder}/accepted").count() == 2


def test_unknown_way_of_removing_repeats(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    feed.add(request("a", {"event_type": "order.created"}))
    with pytest.raises(ValueError):
        intake.start(spark, feed.stream(), str(tmp_path / "o"), str(tmp_path / "c"), repeats="never")
