import datetime

from tallymark.plans import packing as pk

PACKING = "carton_id string, upc_number string, total_qty bigint, bl_date date"
LEDGER = "date_text string, msku string, quantity bigint, event_type string, reference_id string"
ID = "FBA000000001"
MAY1, MAY3 = datetime.date(2022, 5, 1), datetime.date(2022, 5, 3)


def frames(spark):
    packing = [
        (f"{ID}U000001", "1", 5, MAY1),
        (f"{ID}U000002", "1", 4, MAY3),
        (f"{ID}U000003", None, 2, MAY1),
        (f"{ID}U000004", "9", 3, None),
        (None, "1", 100, MAY1),
    ]
    ledger = [
        ("5/5/2022", "1", 6, "Receipts", ID),
        ("05/07/2022", "1", 2, "Receipts", ID),
        ("05/07/2022", None, 2, "Receipts", ID),
        ("05/07/2022", "1", 50, "Shipments", ID),
        ("05/07/2022", "unpacked", 1, "Receipts", ID),
        ("05/07/2022", "1", 70, "Receipts", None),
    ]
    return spark.createDataFrame(packing, PACKING), spark.createDataFrame(ledger, LEDGER)


def test_reports(spark):
    reports = pk.reconcile(*frames(spark))
    assert {tuple(r) for r in reports["packing_vs_receipts"].collect()} == {
        (ID, "1", 9, 8, -1),
        (ID, "nan", 2, 2, 0),
        (ID, "9", 3, 0, -3),
    }
    may5, may7 = datetime.date(2022, 5, 5), datetime.date(2022, 5, 7)
    assert {tuple(r) for r in reports["packing_vs_receipts_dated"].collect()} == {
        (ID, "1", 5, MAY1, 6, may5, 4),
        (ID, "1", 5, MAY1, 2, may7, 6),
        (ID, "1", 4, MAY3, 6, may5, 2),
        (ID, "1", 4, MAY3, 2, may7, 4),
        (ID, "nan", 2, MAY1, 2, may7, 6),
    }


def test_no_receipts(spark):
    packing, ledger = frames(spark)
    reports = pk.reconcile(packing, ledger.limit(0))
    assert {r.qty_inv_ledger for r in reports["packing_vs_receipts"].collect()} == {0}
    assert {(r.receipt_date, r.transit_days) for r in reports["packing_vs_receipts_dated"].collect()} == {(None, None)}
