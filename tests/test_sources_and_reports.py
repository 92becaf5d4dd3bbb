import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.operators import reporting as R
from tallymark.plans import packing as pk
from tallymark.plans import shipments as sh
from tallymark.sources import reports as S
from tallymark.sources import sheets
from tallymark.sources.sinks import write_reports

LEDGER_HEADER = "Date,FNSKU,MSKU,Quantity,Fulfillment Center,Event Type,Disposition,Reference ID"


def write(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_payments_with_a_byte_order_mark(spark, tmp_path):
    path = write(
        tmp_path,
        "payments.csv",
        '﻿"date/time",settlement id,type,order id,sku,description,quantity,total',
        '"Feb 1, 2022",9,Refund,o1,007,text,2,"-1,234.50"',
        '"Feb 2, 2022",9,Order,o2,,text,,3',
    )
    rows = S.read_csv(spark, "payments", path, thousands=True).collect()
    assert [tuple(r) for r in rows] == [
        ("Feb 1, 2022", "Refund", "o1", "007", "text", 2, Decimal("-1234.50")),
        ("Feb 2, 2022", "Order", "o2", None, "text", None, Decimal("3.00")),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        S.read_csv(spark, "payments", path).collect()


def test_many_ledger_files_with_one_header(spark, tmp_path):
    paths = [
        write(tmp_path, f"l{i}.csv", LEDGER_HEADER, f"01/0{i}/2022,x,00{i},{i},x,Receipts,SELLABLE,FBA") for i in (1, 2)
    ]
    rows = {(r.date_text, r.msku, r.quantity) for r in S.read_csv(spark, "ledger", paths).collect()}
    assert rows == {("01/01/2022", "001", 1), ("01/02/2022", "002", 2)}


def test_columns_are_found_by_each_files_header(spark, tmp_path):
    turned = ",".join(reversed(LEDGER_HEADER.split(",")))
    paths = [
        write(tmp_path, "a.csv", LEDGER_HEADER, "01/01/2022,x,m1,1,x,Receipts,SELLABLE,F1"),
        write(tmp_path, "b.csv", turned, "F2,DEFECTIVE,Receipts,y,2,m2,x,01/02/2022"),
        write(tmp_path, "c.csv", LEDGER_HEADER.replace(",FNSKU", ""), "01/03/2022,m3,3,z,Receipts,SELLABLE,F3"),
    ]
    rows = {tuple(r) for r in S.read_csv(spark, "ledger", paths).collect()}
    assert rows == {
        ("01/01/2022", "m1", 1, "x", "Receipts", "SELLABLE", "F1"),
        ("01/02/2022", "m2", 2, "y", "Receipts", "DEFECTIVE", "F2"),
        ("01/03/2022", "m3", 3, "z", "Receipts", "SELLABLE", "F3"),
    }


def test_missing_column_is_named(spark, tmp_path):
    path = write(tmp_path, "l.csv", "Date,MSKU", "01/01/2022,m")
    with pytest.raises(Exception, match="Quantity"):
        S.read_csv(spark, "ledger", path).collect()
    found = S.read_csv(spark, "ledger", path, required=["date_text", "msku"]).collect()
    assert [tuple(r) for r in found] == [("01/01/2022", "m", None, None, None, None, None)]


def test_quotes_header_text_and_line_breaks(spark, tmp_path):
    path = write(
        tmp_path, "l.csv", LEDGER_HEADER, '01/01/2022,x,"12"" ruler, blue",1,Reference ID,Receipts,SELLABLE,F1',
        '01/02/2022,x,"two\nlines",2,x,Receipts,SELLABLE,F2',
    )
    rows = S.read_csv(spark, "ledger", path, multi_line=True).collect()
    assert [(r.msku, r.quantity, r.fulfillment_center) for r in rows] == [('12" ruler, blue', 1, "Reference ID"), ("two\nlines", 2, "x")]


def test_booking_files_with_headers_of_their_own(spark, tmp_path):
    write(tmp_path, "2022_04_19-a.csv", "FBA ID,SKU,CARTONS,QTY", "FBA000000001,1,2,3")
    write(tmp_path, "2022_04_20-b.csv", "qty, sku , fba id ,Cartons", "6,1,FBA000000001,5")
    rows = S.read_bookings(spark, str(tmp_path / "*.csv")).collect()
    assert {(r.cartons, r.qty, r.booking_date.day) for r in rows} == {(2, 3, 19), (5, 6, 20)}


def test_blank_cartons_raise(spark, tmp_path):
    write(tmp_path, "2022_04_19-a.csv", "FBA ID,SKU,CARTONS,QTY", "FBA000000001,1,,3")
    bookings = S.read_bookings(spark, str(tmp_path / "*.csv"))
    with pytest.raises(Exception, match="whole number is missing"):
        sh.clean_bookings(bookings).collect()
    assert sh.clean_bookings(bookings, strict=False).first().cartons is None


def test_bookings_are_dated_by_file_name(spark, tmp_path):
    for name in ("2022_04_19-first.csv", "2022_04_20-second-part.csv"):
        write(tmp_path, name, " Fba Id,Sku ,Cartons,Qty,Note", f"FBA000000001,12.0,2.0,{name[8:10]},n", "short,1,1,1,n")
    bookings = sh.clean_bookings(S.read_bookings(spark, [str(tmp_path / "*.csv")]))
    assert {tuple(r) for r in bookings.collect()} == {
        ("FBA000000001", "12", 2, day, datetime.date(2022, 4, day)) for day in (19, 20)
    }


def test_parquet_reports(spark, tmp_path):
    df = spark.createDataFrame(
        [("o", "s", "Damaged", 1.0, "2022-01-01", None, "extra")],
        "`order-id` string, sku string, status string, quantity double, `return-date` string, `fulfillment-center-id` string, other string",
    )
    df.write.parquet(str(tmp_path / "returns"))
    rows = S.read_parquet(spark, "returns", str(tmp_path / "returns"))
    assert [tuple(r) for r in rows.collect()] == [("o", "s", "Damaged", 1, "2022-01-01", None)]


def test_column_letters(spark):
    df = spark.createDataFrame([("A",), ("Z",), ("AA",), ("AS",), ("XFD",)], "c string")
    assert [r.n for r in df.select(sheets.column_number(F.col("c")).alias("n")).collect()] == [1, 26, 27, 45, 16384]


CELLS = "file string, row bigint, col string, value string"


def test_packing_sheet(spark):
    cells = [
        ("f", 2, "B", "BL/FCR/AWB DATE"), ("f", 2, "C", "2022-05-01 00:00:00"),
        ("f", 4, "B", "Carton From"), ("f", 4, "C", "FBA Id /  Carton Id"), ("f", 4, "M", "UPC Number"), ("f", 4, "E", "Total Qty"),
        ("f", 4, "N", "Total Qty"),
        ("f", 3, "C", "above the table"),
        ("f", 5, "C", "FBA000000001U1"), ("f", 5, "M", "123"), ("f", 5, "E", "7.0"), ("f", 5, "N", "99"),
        ("f", 6, "C", "FBA000000001U2"), ("f", 6, "E", "8"),
        ("f", 7, "B", "SUB TOTAL"), ("f", 7, "E", "15"),
        ("g", 1, "B", "Carton From"), ("g", 1, "D", "FBA Id /  Carton Id"), ("g", 1, "F", "Total Qty"),
        ("g", 2, "D", "FBA000000002U1"), ("g", 2, "F", "1"),
        ("h", 1, "B", "no table here"),
    ]
    lines = sheets.packing_from_cells(spark.createDataFrame(cells, CELLS))
    day = datetime.date(2022, 5, 1)
    assert {tuple(r) for r in lines.collect()} == {
        ("f", "FBA000000001U1", "123", 7, day),
        ("f", "FBA000000001U2", None, 8, day),
        ("g", "FBA000000002U1", None, 1, None),
    }
    assert {r.sku_id for r in pk.packing_lines(lines).collect()} == {"123", "nan"}


def test_dispatch_sheet(spark):
    name = "FBA000000001_ViewTransaction.xlsx"
    cells = [
        (name, 9, "R", "FBA000000001"), (name, 4, "AD", "2022-05-02 09:30:00"),
        (name, 46, "C", " sku"), (name, 46, "AS", "Inv Qty "), (name, 46, "AT", "INV QTY"), (name, 40, "C", "above"),
        (name, 47, "C", "5.0"), (name, 47, "AS", "3"), (name, 47, "AT", "77"),
        (name, 48, "AS", "9"),
        ("blank.xlsx", 46, "C", "SKU"), ("blank.xlsx", 46, "D", "INV QTY"), ("blank.xlsx", 47, "C", "6"), ("blank.xlsx", 47, "D", "1"),
    ]
    lines = sheets.dispatches_from_cells(spark.createDataFrame(cells, CELLS))
    assert {tuple(r) for r in lines.collect()} == {
        (name, "FBA000000001", datetime.date(2022, 5, 2), "5.0", 3),
        ("blank.xlsx", None, None, "6", 1),
    }
    booked = spark.createDataFrame([("FBA000000001",)], "fba_id string")
    assert [tuple(r) for r in sh.clean_dispatches(lines, booked).collect()] == [
        ("FBA000000001", datetime.date(2022, 5, 2), "5", 3)
    ]


BY_SKU = (
    "fba_id string, sku string, cartons_booked bigint, cartons_dispatched bigint, cartons_short_dispatched bigint, "
    "units_booked bigint, units_received bigint, units_short_received bigint"
)


def by_sku(spark):
    return spark.createDataFrame([("f2", "s", 3, 1, 2, 5, 5, 0), ("f1", "s", 1, 1, 0, 5, 9, -4)], BY_SKU)


def test_flags_pass_exactly_at_zero(spark):
    for row in R.with_flags(by_sku(spark), "shipment_by_sku").collect():
        for name in R.REPORTS["shipment_by_sku"].flags:
            assert row[f"{name}_status"] == ("PASS" if row[name] == 0 else "FAIL")


def test_totals_add_up(spark):
    df = by_sku(spark)
    rows = R.with_totals(df, R.REPORTS["shipment_exceptions"].totals).collect()
    (total,) = [r for r in rows if r[R.KIND] == R.TOTAL]
    assert len(rows) == 3
    assert (total.fba_id, total.units_booked) == (None, None)
    assert (total.cartons_short_dispatched, total.units_short_received) == (2, -4)


def test_every_layout_names_its_columns():
    for report in R.REPORTS.values():
        for name in (*report.totals, *report.flags, *report.date_flags, *report.zero_flags, *report.sort):
            assert name in report.columns


def test_written_reports(spark, tmp_path):
    detail = spark.createDataFrame(
        [("f", datetime.date(2022, 1, 2), None, "s", 1, 0, 2, 3, None, 0, 0), ("e", None, None, "s", 1, 1, 2, 3, None, 0, 0)],
        "fba_id string, booking_date date, dispatch_date date, sku string, cartons_booked bigint, cartons_dispatched bigint, "
        "units_booked bigint, units_received bigint, receipt_date date, dispatch_days bigint, receipt_days bigint",
    )
    written = write_reports({"shipment_by_sku": by_sku(spark), "shipment_detail": detail}, str(tmp_path / "out"))
    assert set(written) == {"shipment_by_sku", "shipment_by_sku_totals", "shipment_detail"}
    lines = spark.read.parquet(written["shipment_detail"]).coalesce(1).collect()
    assert [r["FBA ID"] for r in lines] == ["e", "f"]
    assert lines[1]["BOOKING DATE"] == "2022-01-02"
    assert lines[1]["DISPATCH DATE"] == "NOT AVAILABLE"
    assert (lines[0]["BOOKING DATE Status"], lines[1]["BOOKING DATE Status"]) == ("FAIL", "PASS")
    assert (lines[0]["CARTONS DISPATCHED Status"], lines[1]["CARTONS DISPATCHED Status"]) == ("PASS", "FAIL")
    total = spark.read.parquet(written["shipment_by_sku_totals"]).first()
    assert (total["FBA ID"], total["UNITS BOOKED"], total["UNITS SHORT RECEIVED"]) == (None, 10, -4)


def test_empty_report_keeps_its_schema(spark, tmp_path):
    written = write_reports({"shipment_by_sku": by_sku(spark).limit(0)}, str(tmp_path / "out"))
    df = spark.read.parquet(written["shipment_by_sku"])
    assert df.count() == 0
    assert "UNITS SHORT RECEIVED Status" in df.columns
    assert spark.read.parquet(written["shipment_by_sku_totals"]).first()["UNITS BOOKED"] == 0


def test_totals_and_flags_come_from_the_writing_job(spark, tmp_path):
    def seen(kind, value):
        calls.add(1)
        return f"{kind}{value}"

    calls = spark.sparkContext.accumulator(0)
    sku = F.udf(seen)(F.lit("s"), F.col("id"))
    short = (F.col("id") % 3).cast("long")
    figures = ["cartons_booked", "cartons_dispatched", "cartons_short_dispatched", "units_booked", "units_received", "units_short_received"]
    rows = spark.range(0, 1000, 1, 7).select(F.lit("f").alias("fba_id"), sku.alias("sku"), *[short.alias(c) for c in figures])
    written = write_reports({"shipment_by_sku": rows}, str(tmp_path / "out"), flag_counts=True)
    assert calls.value == 1000
    assert spark.read.parquet(written["shipment_by_sku_totals"]).first()["UNITS BOOKED"] == 999
    counts = {r["column"]: (r.passed, r.failed) for r in spark.read.parquet(written["shipment_by_sku_flags"]).collect()}
    assert counts == {"CARTONS SHORT DISPATCHED": (334, 666), "UNITS SHORT RECEIVED": (334, 666)}
    empty = write_reports({"shipment_by_sku": rows.limit(0)}, str(tmp_path / "empty"), flag_counts=True)
    assert spark.read.parquet(empty["shipment_by_sku_totals"]).first()["UNITS BOOKED"] == 0
    assert {(r.passed, r.failed) for r in spark.read.parquet(empty["shipment_by_sku_flags"]).collect()} == {(0, 0)}


def test_short_lines_are_not_malformed(spark, tmp_path, monkeypatch):
    (tmp_path / "1994_03_01-booking.csv").write_text(
        " Sku,Cartons ,FBA ID,qty\nA,1,F1,2\n\"FBA ID, SKU, CARTONS, QTY\",3,F2,4\nB,5\nC,6,F3,7,more,still more\n"
    )
    reader = type(spark.read)
    plain = reader.csv
    monkeypatch.setattr(reader, "csv", lambda self, *paths: plain(self.option("mode", "FAILFAST"), *paths))
    rows = {(r.sku, r.cartons, r.fba_id, r.qty) for r in S.read_bookings(spark, str(tmp_path)).collect()}
    names = "FBA ID, SKU, CARTONS, QTY"
    assert rows == {("A", 1, "F1", 2), (names, 3, "F2", 4), ("B", 5, None, None), ("C", 6, "F3", 7)}
