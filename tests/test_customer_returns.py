"""The five reports against plain loops over small random inputs, and hand-made cases."""

import datetime
import random
from collections import Counter, defaultdict

import pytest

from tallymark.operators.staging import stage
from tallymark.plans import customer_returns as cr
from tests.test_matching import greedy

PAYMENTS = "posted string, type string, order_id string, sku string, description string, quantity bigint, total decimal(18,2)"
RETURNS = "order_id string, sku string, status string, quantity bigint, return_date string, fulfillment_center_id string"
REIMBURSEMENTS = (
    "reason string, approval_date string, amazon_order_id string, sku string, amount_total decimal(18,2), "
    "quantity_reimbursed_cash bigint, quantity_reimbursed_inventory bigint, quantity_reimbursed_total bigint"
)
LEDGER = (
    "date_text string, msku string, quantity bigint, fulfillment_center string, event_type string, disposition string"
)
SETTLEMENT = "FBA Inventory Reimbursement - Customer Return"
STATUSES = ["Reimbursed", "Unit returned to inventory", "Repackaged Successfully", "Damaged", None]


def plain_sku(sku):
    sku = ("Not Available" if sku is None else sku).replace("_New", "").replace("_NEW", "")
    return "SKU-" + (sku[8:20] if len(sku) > 13 else sku)


def make_inputs(seed):
    g = random.Random(seed)
    orders = ["o1", "o2", "o3", None]
    skus = ["000000000001", "000000000001_New", "amzn.gr.000000000002", None]
    centres = ["x", "y", None]
    moment = lambda: f"2022-01-{g.randint(1, 9):02}T{g.randint(0, 23):02}:00:00"
    payments = [
        (
            g.choice(["Jan 3, 2022", "Feb 3, 2022"]),
            g.choice(["Refund", "Refund", "Order"]),
            g.choice(orders),
            g.choice(skus),
            g.choice([SETTLEMENT, "other"]),
            g.choice([1, 2, 3, None]),
            -g.randint(100, 900),
        )
        for _ in range(40)
    ]
    returns = [
        (g.choice(orders), g.choice(skus), g.choice(STATUSES), g.randint(0, 3), g.choice([moment(), moment(), None]), g.choice(centres))
        for _ in range(90)
    ]
    reimbursements = []
    for _ in range(40):
        cash, stock = g.randint(0, 2), g.randint(0, 3)
        reimbursements.append(
            (g.choice(["CustomerReturn", "CustomerReturn", "Lost"]), g.choice([moment(), moment(), None]), g.choice(orders),
             g.choice(skus), g.randint(100, 900), cash, stock, cash + stock)
        )
    ledger = [
        (f"{1:02}/{g.randint(1, 14):02}/2022", g.choice(["000000000001", "amzn.gr.000000000002xx", "Not Availabl"]), g.randint(0, 3),
         g.choice(["x", "y"]), g.choice(["CustomerReturns", "CustomerReturns", "Receipts"]), g.choice(["SELLABLE", "SELLABLE", "DEFECTIVE"]))
        for _ in range(60)
    ]
    return payments, returns, reimbursements, ledger


def group(rows, keys, values):
    sums = defaultdict(lambda: [0] * len(values))
    for row in rows:
        key = tuple(row[k] for k in keys)
        if None not in key:
            for i, v in enumerate(values):
                sums[key][i] += row[v] or 0
    return dict(sums)


def expected_reports(payments, returns, reimbursements, ledger):
    refunds = group(
        [(p[2], plain_sku(p[3]), p[5], -p[6]) for p in payments if p[1] == "Refund"], (0, 1), (2, 3)
    )
    settled = group([(p[2], plain_sku(p[3]), p[5], p[6]) for p in payments if p[4] == SETTLEMENT], (0, 1), (2, 3))
    lines = [(r[0], plain_sku(r[1]), *r[2:]) for r in returns]
    by_status = group(lines, (0, 1, 2), (3,))
    by_centre = group(lines, (0, 1, 2, 5), (3,))
    by_date = group(lines, (0, 1, 2, 4, 5), (3,))
    paid = [(p[2], plain_sku(p[3]), p[1], *p[4:]) for p in reimbursements if p[0] == "CustomerReturn"]
    by_key = group(paid, (0, 1), (3, 4, 5, 6))
    by_day = group(paid, (0, 1, 2), (5,))

    first = Counter()
    for key, (quantity, total) in refunds.items():
        found = [(k[2], q) for k, (q,) in by_status.items() if k[:2] == key] or [(None, 0)]
        back = sum(q for _, q in found)
        missing = quantity * len(found) - back
        first[
            (*key, quantity * len(found), total * len(found), back,
             sum(q for s, q in found if s == "Reimbursed"),
             sum(q for s, q in found if s in ("Unit returned to inventory", "Repackaged Successfully")),
             missing, round(total / quantity * missing, 3) if quantity else 0)
        ] += 1

    second, third, granted = Counter(), Counter(), []
    for (order, sku, status, centre), (quantity,) in sorted(by_centre.items()):
        if status != "Reimbursed" or quantity == 0 or (order, sku) not in refunds:
            continue
        total = refunds[order, sku][1]
        amount, cash, stock, both = by_key.get((order, sku), (0, 0, 0, 0))
        second[(order, sku, total, quantity, amount, cash, stock, both, quantity - both,
                round(total / quantity * (quantity - both), 3))] += 1
        if cash:
            number, value = settled.get((order, sku), (0, 0))
            third[(order, sku, cash, amount, number, value, cash - number, amount - value)] += 1
        for (o, s, moment), (units,) in sorted(by_day.items()):
            if (o, s) == (order, sku) and units:
                granted.append((sku, centre, moment, (order, centre, moment), units, quantity, total))

    restocked = [
        (sku, centre, moment, (order, status, moment), units, 1, refunds[order, sku][1])
        for (order, sku, status, moment, centre), (units,) in by_date.items()
        if status in ("Unit returned to inventory", "Repackaged Successfully") and units and (order, sku) in refunds
    ]
    stock = []
    for text, msku, units, centre, event, disposition in ledger:
        if event == "CustomerReturns" and disposition == "SELLABLE":
            sku = (msku[8:20] if msku.startswith("amzn") else msku)[:12]
            month, number, year = map(int, text.split("/"))
            stock.append(("SKU-" + sku, centre, datetime.date(year, month, number), units))
    return first, second, third, unit_report(restocked, stock), unit_report(granted, stock)


def unit_report(units, stock):
    report = Counter()
    runs = [(sku, centre, datetime.date.fromisoformat(m[:10]), (rank, shown, total), n) for sku, centre, m, rank, n, shown, total in units]
    for (sku, centre, day, (_, shown, total), found), count in greedy(runs, stock).items():
        hit = found is not None
        report[(sku, centre, day, shown, total, found, 1 if hit else None, (found - day).days if hit else None,
                0 if hit else 1, 0 if hit else total)] += count
    return report


def frames(spark, inputs):
    money = lambda rows, i: [(*r[:i], __import__("decimal").Decimal(r[i]), *r[i + 1:]) for r in rows]
    payments, returns, reimbursements, ledger = inputs
    return (
        spark.createDataFrame(money(payments, 6), PAYMENTS),
        spark.createDataFrame(returns, RETURNS),
        spark.createDataFrame(money(reimbursements, 4), REIMBURSEMENTS),
        spark.createDataFrame(ledger, LEDGER),
    )


def found(df, places=3):
    return Counter(
        tuple(round(float(v), places) if type(v).__name__ == "Decimal" else v for v in row) for row in df.collect()
    )


NAMES = ["refunds_vs_returns", "returns_vs_reimbursements", "cash_reimbursement", "returned_to_inventory", "inventory_reimbursement"]


@pytest.mark.parametrize("seed", range(4))
def test_reports_equal_plain_loops(spark, seed):
    inputs = make_inputs(seed)
    reports = cr.reconcile(*frames(spark, inputs))
    for name, expected in zip(NAMES, expected_reports(*inputs)):
        assert found(reports[name]) == expected, name


def test_staged_job_equals_single_plans(spark):
    payments, returns, reimbursements, ledger = frames(spark, make_inputs(11))
    reports = cr.reconcile(payments, returns, reimbursements, ledger)
    refunded, returned = cr.refunds(payments), cr.normalized_returns(returns)
    paid = cr.normalized_reimbursements(reimbursements)
    lines = cr.reimbursed_refunds(refunded, returned)
    days = cr.ledger_days(ledger)
    single = [
        cr.refunds_vs_returns(refunded, returned),
        cr.returns_vs_reimbursements(lines, cr.reimbursements_by(paid)),
        cr.cash_reimbursement(lines, cr.reimbursements_by(paid), cr.settlements(payments)),
        cr.returned_to_inventory(stage(cr.restocked_runs(refunded, returned)), days),
        cr.inventory_reimbursement(stage(cr.inventory_reimbursed_runs(lines, cr.reimbursements_by(paid, "approval_date"))), days),
    ]
    for name, df in zip(NAMES, single):
        assert found(df) == found(reports[name]), name


def test_two_statuses_count_a_refund_twice(spark):
    payments = spark.createDataFrame([("d", "Refund", "o", "s", "", 2, -10)], PAYMENTS.replace("decimal(18,2)", "int"))
    returns = spark.createDataFrame([("o", "s", "Damaged", 1, "d", None), ("o", "s", "Reimbursed", 1, "d", "x")], RETURNS)
    row = cr.refunds_vs_returns(cr.refunds(payments), cr.normalized_returns(returns)).first()
    assert (row.quantity_refund, row.total, row.quantity_returns, row.quantity_difference, row.amount_difference) == (4, 20, 2, 2, 10)


def test_month_and_prefix_of_the_older_report(spark):
    payments, *_ = frames(spark, make_inputs(3))
    options = cr.ReturnsOptions(month="Feb", sku_prefix="")
    some = cr.refunds(payments, options)
    every = cr.refunds(payments.filter("posted like 'Feb%'"))
    assert {(r.order_id, "SKU-" + r.sku, r.quantity_refund, r.total) for r in some.collect()} == {tuple(r) for r in every.collect()}


def test_nothing_matches(spark):
    payments, returns, reimbursements, ledger = frames(spark, make_inputs(0))
    reports = cr.reconcile(payments, returns, reimbursements, ledger.limit(0))
    rows = reports["returned_to_inventory"].collect()
    assert rows and all(r.date_added is None and r.quantity_difference == 1 and r.amount_difference == r.total for r in rows)


def test_empty_inputs_keep_their_columns(spark):
    empty = [df.limit(0) for df in frames(spark, make_inputs(5))]
    for df in cr.reconcile(*empty).values():
        assert df.columns and df.count() == 0
