"""Whole jobs from files to written reports."""

from tallymark import jobs

LEDGER = "Date,MSKU,Quantity,Fulfillment Center,Event Type,Disposition,Reference ID"
ID = "FBA000000001"
CELLS = "file string, row bigint, col string, value string"


def write(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_customer_returns(spark, tmp_path):
    payments = write(
        tmp_path, "payments.csv", "date/time,type,order id,sku,description,quantity,total",
        "d,Refund,o1,123456789012,x,2,-20", "d,Adjustment,o1,123456789012,FBA Inventory Reimbursement - Customer Return,1,9",
        "d,Refund,o2,,x,1,-5",
    )
    returns = write(
        tmp_path, "returns.csv", "return-date,order-id,sku,fulfillment-center-id,status,quantity",
        "2022-01-01T00:00:00,o1,123456789012,x,Reimbursed,1", "2022-01-02T00:00:00,o1,123456789012,x,Repackaged Successfully,1",
    )
    reimbursements = write(
        tmp_path, "reimbursements.csv",
        "approval-date,amazon-order-id,reason,sku,amount-total,quantity-reimbursed-cash,quantity-reimbursed-inventory,quantity-reimbursed-total",
        "2022-01-03T00:00:00,o1,CustomerReturn,123456789012,10,1,1,2",
    )
    ledger = [write(tmp_path, "l1.csv", LEDGER, "01/05/2022,amzn.gr.123456789012,1,x,CustomerReturns,SELLABLE,")]
    ledger.append(write(tmp_path, "l2.csv", LEDGER, "01/06/2022,123456789012,1,x,CustomerReturns,DEFECTIVE,"))
    written = jobs.reconcile_customer_returns(spark, payments, returns, reimbursements, ledger, str(tmp_path / "out"))
    assert len(written) == 10
    rows = {r["Order ID"]: r for r in spark.read.parquet(written["refunds_vs_returns"]).collect()}
    assert rows["o2"]["SKU"] == "SKU-Not Available"
    assert rows["o2"]["Quantity Difference Status"] == "FAIL"
    cash = spark.read.parquet(written["cash_reimbursement"]).first()
    assert (cash["Quantity Difference"], cash["Amount Difference"]) == (0, 1.0)
    stocked = spark.read.parquet(written["returned_to_inventory"]).first()
    assert (stocked["Return Date"], stocked["Date added to Inventory"], stocked["Days Difference"]) == ("01/02/2022", "01/05/2022", 3)
    granted = spark.read.parquet(written["inventory_reimbursement"]).first()
    assert (granted["Approval Date"], granted["Received Date"], granted["Amount"]) == ("01/03/2022", "01/05/2022", 20.0)
    assert spark.read.parquet(written["refunds_vs_returns_totals"]).first()["Refund Amount"] == 45.0


def test_shipments_and_packing(spark, tmp_path):
    bookings = write(tmp_path, "2022_04_19-all.csv", "FBA ID,SKU,Cartons,Qty", f"{ID},1.0,2,5", "short,1,1,1")
    ledger = write(tmp_path, "l.csv", LEDGER, f"04/25/2022,1,3,x,Receipts,SELLABLE,{ID}", f"04/26/2022,1,1,x,Receipts,SELLABLE,{ID}")
    name = f"{ID}_ViewTransaction.xlsx"
    spark.createDataFrame(
        [(name, 9, "R", ID), (name, 4, "AD", "2022-04-21"), (name, 46, "C", "SKU"), (name, 46, "D", "INV QTY"), (name, 50, "C", "1"), (name, 50, "D", "2")],
        CELLS,
    ).write.parquet(str(tmp_path / "dispatch"))
    written = jobs.reconcile_shipments(spark, bookings, str(tmp_path / "dispatch"), ledger, str(tmp_path / "out"))
    figures = spark.read.parquet(written["shipment_kpis"]).first()
    assert tuple(figures) == (5, 0, -1, -4, 0, 1)
    detail = spark.read.parquet(written["shipment_detail"]).collect()
    assert {(r["DISPATCH DAYS"], r["RECEIPT DAYS"], r["UNITS RECEIVED"]) for r in detail} == {(2, 4, 3), (2, 5, 1)}

    spark.createDataFrame(
        [("p", 1, "B", "BL/FCR/AWB DATE"), ("p", 1, "C", "2022-04-20"), ("p", 3, "B", "Carton From"), ("p", 3, "C", "FBA Id /  Carton Id"),
         ("p", 3, "D", "UPC Number"), ("p", 3, "E", "Total Qty"), ("p", 4, "C", f"{ID}U1"), ("p", 4, "D", "1"), ("p", 4, "E", "6")],
        CELLS,
    ).write.parquet(str(tmp_path / "packing"))
    written = jobs.reconcile_packing(spark, str(tmp_path / "packing"), ledger, str(tmp_path / "out"))
    assert tuple(spark.read.parquet(written["packing_vs_receipts"]).first()) == (ID, "1", 6, 4, -2, "FAIL")
    dated = spark.read.parquet(written["packing_vs_receipts_dated"]).collect()
    assert {(r["BL Date"], r["Receipt Date"], r["Transit Days"]) for r in dated} == {("2022-04-20", "2022-04-25", 5), ("2022-04-20", "2022-04-26", 6)}
