"""Shipment reports against nested loops, and the cases without keys or dispatches."""

import datetime
import random
from collections import Counter, defaultdict

import pytest

from tallymark.plans import shipments as sh

BOOKINGS = "fba_id string, sku string, cartons bigint, qty bigint, booking_date date"
DISPATCHES = "file_name string, fba_id string, dispatch_date date, sku string, inv_qty bigint"
LEDGER = "date_text string, msku string, quantity bigint, event_type string, reference_id string"
IDS = ["FBA000000001", "FBA000000002", "FBA000000003"]


def day(number):
    return datetime.date(2022, 1, number)


def make_inputs(seed, dispatched=True):
    g = random.Random(seed)
    skus = ["111111111111", "222222222222", "333333333333"]
    bookings = [
        (g.choice([*IDS[:2], "short", None]), g.choice(skus) + g.choice(["", "_New", ".0"]), g.randint(0, 2), g.randint(0, 2), day(g.randint(1, 2)))
        for _ in range(14)
    ]
    dispatches = [
        (f"{g.choice(IDS) if dispatched else 'X'}_ViewTransaction.xlsx", g.choice([*IDS, None]), day(g.randint(3, 4)), g.choice([*skus, skus[0] + ".0", None]), g.randint(0, 2))
        for _ in range(12)
    ]
    ledger = [
        (f"1/{g.randint(5, 6)}/2022", g.choice([*skus, skus[1] + "-more", None]), g.randint(0, 2), g.choice(["Receipts", "Receipts", "Adjustments"]), g.choice([*IDS, None]))
        for _ in range(16)
    ]
    return bookings, dispatches, ledger


def expected_detail(bookings, dispatches, ledger):
    clean = lambda sku: sku.removesuffix(".0").replace("_New", "")
    booked = [(b[0], clean(b[1]), *b[2:]) for b in bookings if b[0] and len(b[0]) == 12]
    ids = {b[0] for b in booked}
    sent = [(f, (s or "").removesuffix(".0"), d, q) for name, f, d, s, q in dispatches if name[:12] in ids and s is not None]
    received = [
        (f, "nan" if s is None else s[:12], datetime.datetime.strptime(t, "%m/%d/%Y").date(), q)
        for t, s, q, e, f in ledger
        if e == "Receipts" and f in ids
    ]
    keys = {r[:2] for r in booked + sent + received}
    rows = []
    for key in keys:
        same = lambda side, width: [r[2:] for r in side if r[:2] == key] or [(None,) * width]
        for cartons, quantity, at in same(booked, 3):
            for left, dispatched in same(sent, 2):
                for arrived, units in same(received, 2):
                    rows.append((*key, at, left, cartons, dispatched, quantity, units, arrived))
    return rows, bool(sent)


def frames(spark, inputs):
    bookings, dispatches, ledger = inputs
    booked = sh.clean_bookings(spark.createDataFrame(bookings, BOOKINGS))
    sent = sh.clean_dispatches(spark.createDataFrame(dispatches, DISPATCHES), booked)
    return booked, sent, sh.booked_receipts(spark.createDataFrame(ledger, LEDGER), booked)


def expected_by_sku(rows, any_dispatch):
    sums = defaultdict(int)
    for fba, sku, _, _, cartons, dispatched, quantity, units, _ in rows:
        if any_dispatch:
            cartons, quantity = cartons or 0, quantity or 0
        if None not in (fba, sku, cartons, quantity):
            sums[fba, sku, cartons, dispatched or 0, quantity] += units or 0
    return Counter((f, s, c, d, c - d, q, u, q - u) for (f, s, c, d, q), u in sums.items())


@pytest.mark.parametrize("seed", range(5))
def test_reports_equal_nested_loops(spark, seed):
    inputs = make_inputs(seed)
    rows, any_dispatch = expected_detail(*inputs)
    sides = frames(spark, inputs)
    gap = lambda a, b: (a - b).days if a and b else 0
    expected = Counter(
        (f, at, left, s, c or 0, d or 0, q or 0, u or 0, arrived, gap(left, at), gap(arrived, left))
        for f, s, at, left, c, d, q, u, arrived in rows
    )
    assert any_dispatch
    assert Counter(map(tuple, sh.shipment_detail(*sides).collect())) == expected
    by_sku = sh.shipment_by_sku(*sides)
    lines = expected_by_sku(rows, True)
    assert Counter(map(tuple, by_sku.collect())) == lines

    exceptions = sh.shipment_exceptions(by_sku)
    assert Counter(map(tuple, exceptions.collect())) == Counter(r for r in lines if r[4] or r[7])
    for r in sh.shipment_summary(by_sku).collect():
        mine = [x for x in lines if x[0] == r.fba_id]
        assert r.sku_count == len(mine)
        assert r.short_units_received == sum(max(x[7], 0) for x in mine)
        assert r.excess_units_received == sum(max(-x[7], 0) for x in mine)
        assert r.short_units_received - r.excess_units_received == r.units_booked - r.units_received
        assert r.short_cartons_dispatched - r.excess_cartons_dispatched == r.cartons_booked - r.cartons_dispatched
    figures = sh.shipment_kpis(by_sku).first()
    assert tuple(figures) == (
        sum(x[5] for x in lines),
        sum(max(-x[7], 0) for x in lines),
        -sum(max(x[7], 0) for x in lines),
        -sum(x[6] for x in lines),
        sum(x[7] == 0 for x in lines),
        sum(x[7] != 0 for x in lines),
    )


def test_without_any_dispatch(spark):
    inputs = make_inputs(3, dispatched=False)
    rows, any_dispatch = expected_detail(*inputs)
    sides = frames(spark, inputs)
    assert not any_dispatch
    assert Counter(map(tuple, sh.shipment_by_sku(*sides).collect())) == expected_by_sku(rows, False)
    expected = Counter((f, at, None, s, c, 0, q, u, arrived, None, None) for f, s, at, _, c, _, q, u, arrived in rows)
    assert Counter(map(tuple, sh.shipment_detail(*sides).collect())) == expected


def test_dispatch_without_an_id_stays_in_the_detail(spark):
    bookings = [(IDS[0], "1", 1, 1, day(1))]
    dispatches = [(f"{IDS[0]}_ViewTransaction.xlsx", None, day(3), "1", 5)]
    sides = frames(spark, (bookings, dispatches, [("1/5/2022", "1", 1, "Receipts", IDS[0])]))
    detail = {(r.fba_id, r.cartons_booked, r.cartons_dispatched) for r in sh.shipment_detail(*sides).collect()}
    assert detail == {(IDS[0], 1, 0), (None, 0, 5)}
    assert [r.fba_id for r in sh.shipment_by_sku(*sides).collect()] == [IDS[0]]


def test_hot_key_with_repeated_lines(spark):
    bookings = [(IDS[0], "1", 1, 1, day(1))] * 30 + [(IDS[1], "1", 1, 1, day(1))]
    dispatches = [(f"{IDS[0]}_ViewTransaction.xlsx", IDS[0], day(3), "1", 1)] * 20
    ledger = [("1/5/2022", "1", 2, "Receipts", IDS[0])] * 10
    sides = frames(spark, (bookings, dispatches, ledger))
    assert sh.shipment_detail(*sides).count() == 30 * 20 * 10 + 1
    assert {(r.fba_id, r.units_received) for r in sh.shipment_by_sku(*sides).collect()} == {(IDS[0], 12000), (IDS[1], 0)}
