"""Monthly tables after changes equal a full rebuild, and only the months concerned are written."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from conftest import DEFAULTS

from ledgerline import session
from ledgerline.plans.incremental import TABLES, MonthlyMarts
from ledgerline.plans.warehouse import Warehouse
from ledgerline.sources import ingest
from ledgerline.sources.ingest import ENTITIES
from ledgerline.sources.layer import RawLayer
from ledgerline.sources.schemas import RAW_SCHEMAS

KEYS = {"orders": "order_id", "order_items": "order_item_id", "refunds": "refund_id", "payments": "payment_id", "payouts": "payout_id"}
DAYS = [date(2024, 1, 10) + timedelta(days=17 * i) for i in range(9)]


class Shop:
    """Rows of the five feeds that the tables depend on, changed at random and delivered to a layer."""

    def __init__(self, spark, folder, seed):
        self.spark, self.pick = spark, random.Random(seed)
        self.layer = RawLayer(spark, f"{folder}/raw")
        self.marts = MonthlyMarts(self.layer, f"{folder}/marts")
        self.clock = datetime(2025, 1, 1, tzinfo=timezone.utc)
        p = self.pick
        self.rows = {
            "orders": [self.order(i) for i in range(40)],
            "order_items": [self.item(i) for i in range(90)],
            "refunds": [self.refund(i) for i in range(25)],
            "payments": [self.payment(i) for i in range(45)],
            "payouts": [dict(payout_id=f"P{i}", period_start=p.choice(DAYS).replace(day=1), gross_sales=50.0 + i) for i in range(8)],
        }

    def order(self, i):
        p = self.pick
        return dict(order_id=f"O{i}", order_date=p.choice(DAYS), channel_id=p.randint(1, 7),
                    order_status=p.choice(["completed", "cancelled", "shipped"]), total_amount=float(p.randint(1, 99)))

    def item(self, i):
        return dict(order_item_id=f"I{i}", order_id=f"O{self.pick.randint(0, 44)}", revenue=float(self.pick.randint(1, 50)))

    def refund(self, i):
        return dict(refund_id=f"R{i}", order_id=f"O{self.pick.randint(0, 44)}", amount=float(self.pick.randint(1, 20)))

    def payment(self, i):
        p = self.pick
        return dict(payment_id=f"Y{i}", order_id=f"O{p.randint(0, 44)}", payment_date=p.choice(DAYS),
                    amount=float(p.randint(1, 50)), status=p.choice(["completed", "failed"]))

    def frame(self, entity, rows):
        columns = [part.split()[0] for part in RAW_SCHEMAS[entity].split(", ")]
        full = [{**DEFAULTS[entity], **row} for row in rows]
        return self.spark.createDataFrame([tuple(r[c] for c in columns) for r in full], RAW_SCHEMAS[entity])

    def deliver(self, entity, rows, replace):
        self.clock += timedelta(hours=1)
        made = ingest.with_metadata(self.frame(entity, rows), entity, ingest.batch_id(self.clock), self.clock)
        self.layer.load(made, ENTITIES[entity].table, replace, dated_by=ingest.dated_by(entity, made))

    def reload(self, *entities):
        for entity in entities or self.rows:
            self.deliver(entity, self.rows[entity], True)

    def same(self):
        whole = Warehouse(self.spark, self.layer)
        for name in TABLES:
            want, got = whole[name], self.marts.table(name)
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name

    def loads(self, name):
        """The load that each month is in."""
        return {part: x.commit.load for x in self.marts.tables.live(name) for part in x.parts}


@pytest.fixture
def shop(spark, tmp_path, request):
    made = Shop(spark, str(tmp_path), getattr(request, "param", 1))
    made.reload()
    made.marts.refresh()
    return made


def test_first_build_and_nothing_new(shop):
    shop.same()
    before = {name: shop.loads(name) for name in TABLES}
    assert shop.marts.refresh() == []
    shop.reload()
    assert shop.marts.refresh() == []
    assert before == {name: shop.loads(name) for name in TABLES}


def test_only_months_concerned_are_written(shop):
    order = shop.rows["orders"][3]
    month = str(order["order_date"].replace(day=1))
    before = {name: shop.loads(name) for name in TABLES}
    order["order_status"] = "refunded"
    shop.reload("orders")
    assert shop.marts.refresh() == [month]
    shop.same()
    for name in TABLES:
        after = shop.loads(name)
        changed = {part for part in before[name].keys() | after.keys() if before[name].get(part) != after.get(part)}
        assert changed <= {month}
    assert shop.loads("int_order_revenue")[month] != before["int_order_revenue"][month]


def test_an_order_moves_and_its_month_empties(shop):
    alone = date(2023, 7, 3)
    shop.rows["orders"].append(dict(order_id="X", order_date=alone, total_amount=5.0))
    shop.rows["order_items"].append(dict(order_item_id="IX", order_id="X"))
    shop.reload("orders", "order_items")
    assert shop.marts.refresh() == ["2023-07-01"]
    shop.same()
    shop.rows["orders"][-1]["order_date"] = date(2023, 9, 1)
    shop.reload("orders")
    assert shop.marts.refresh() == ["2023-07-01", "2023-09-01"]
    shop.same()
    assert "2023-07-01" not in shop.loads("int_order_revenue")
    del shop.rows["orders"][-1]
    shop.reload("orders")
    shop.marts.refresh()
    shop.same()


def test_appended_rows_supersede_older_ones(shop):
    """Newer rows of known keys: an order in another month, an item and a refund of another order, a later payment. Then
    one of the orders that lost something changes again, and the stale rows must not come back."""
    order, item, refund, payment = (dict(shop.rows[e][0]) for e in ("orders", "order_items", "refunds", "payments"))
    lost = item["order_id"] = "O1"
    for entity, row, change in (
        ("orders", order, dict(order_date=date(2024, 12, 24))),
        ("order_items", item, dict(order_id="O2", revenue=77.0)),
        ("refunds", refund, dict(order_id="O3", amount=1.5)),
        ("payments", payment, dict(payment_date=date(2024, 12, 25))),
    ):
        shop.deliver(entity, [{**row}], False)
        shop.deliver(entity, [{**row, **change}], False)
    shop.marts.refresh()
    shop.same()
    again = next(r for r in shop.rows["orders"] if r["order_id"] == lost)
    shop.deliver("orders", [{**again, "total_amount": 1234.0}], False)
    assert len(shop.marts.refresh()) == 1
    shop.same()


def test_payments_and_payouts_alone(shop):
    shop.rows["payments"][0]["amount"] += 10
    shop.rows["payouts"][0]["period_start"] = date(2022, 1, 1)
    before = shop.loads("mart_sales")
    shop.reload("payments", "payouts")
    assert len(shop.marts.refresh()) in (2, 3)
    shop.same()
    assert shop.loads("mart_sales") == before


@pytest.mark.parametrize("step", ["mart_sales", "state"])
def test_a_refresh_that_ends_early_is_run_again(shop, monkeypatch, step):
    shop.rows["orders"][5]["order_date"] = date(2025, 2, 2)
    shop.rows["order_items"][5]["revenue"] = 500.0
    del shop.rows["refunds"][2]
    shop.reload("orders", "order_items", "refunds")
    commit = shop.marts.tables._commit

    def ending(table, *fields):
        if table == step:
            raise RuntimeError("killed")
        commit(table, *fields)

    with monkeypatch.context() as m:
        m.setattr(shop.marts.tables, "_commit", ending)
        with pytest.raises(RuntimeError):
            shop.marts.refresh()
    shop.marts.refresh()
    shop.same()


@pytest.mark.parametrize("shop", [7], indirect=True)
def test_random_changes(shop):
    p = shop.pick
    for round_ in range(2):
        for entity, make in (("orders", shop.order), ("order_items", shop.item), ("refunds", shop.refund), ("payments", shop.payment)):
            rows = shop.rows[entity]
            for _ in range(2):
                at = p.randrange(len(rows))
                number = rows[at][KEYS[entity]][1:]
                rows[at] = make(int(number)) if p.random() < 0.7 else rows[at]
            rows.append(make(1000 + round_))
            rows.pop(p.randrange(len(rows)))
        if round_ == 1:
            shop.rows["orders"].append(dict(order_id="O7777", order_date=None))
        shop.reload()
        shop.marts.refresh()
        shop.same()


def test_large_feeds_are_followed_slice_by_slice(shop, monkeypatch):
    """Changes and rows of the orders concerned are written in slices; the result is that of a rebuild."""
    monkeypatch.setattr(session, "FILE_BYTES_PER_SLICE", 3000)
    shop.rows["orders"][5]["order_date"] = date(2025, 2, 2)
    shop.rows["order_items"][5]["revenue"] = 500.0
    shop.rows["order_items"][6]["order_id"] = None
    shop.rows["order_items"][7] = {**shop.rows["order_items"][7], "order_id": "O2"}
    del shop.rows["refunds"][2]
    shop.reload("orders", "order_items", "refunds")
    shop.marts.refresh()
    shop.same()
    assert shop.marts.tables.version("orders_concerned") > 3
    for feed in ("raw_orders", "raw_order_items"):
        assert shop.marts.tables.version(f"{feed}_concerned") == session.slices(shop.layer.table(feed)) > 1
    assert shop.marts.table("raw_order_items_concerned").count() < shop.layer.count("raw_order_items")
    # The next refresh starts these tables anew.
    shop.rows["order_items"][8]["revenue"] = 600.0
    shop.reload("order_items")
    assert len(shop.marts.refresh()) == 1
    shop.same()
