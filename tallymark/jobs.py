"""Whole jobs: read the report files, reconcile, write the reports.

Files are CSV, except sheets, which come as Parquet tables of cells.  Each job returns
the folders it wrote, by report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tallymark.plans import customer_returns, packing, shipments
from tallymark.sources.reports import read_bookings, read_csv
from tallymark.sources.sheets import dispatches_from_cells, packing_from_cells
from tallymark.sources.sinks import write_reports

Paths = str | Sequence[str]
# What the two receipt jobs use of the ledger.
RECEIPT_COLUMNS = ("date_text", "msku", "quantity", "event_type", "reference_id")


def reconcile_customer_returns(
    spark: SparkSession,
    payments: Paths,
    returns: Paths,
    reimbursements: Paths,
    ledger: Paths,
    folder: str,
    options: customer_returns.ReturnsOptions = customer_returns.DEFAULTS,
) -> dict[str, str]:
    how = {"thousands": options.thousands, "strict": options.strict}
    stock = ("date_text", "msku", "quantity", "fulfillment_center", "event_type", "disposition")
    reports = customer_returns.reconcile(
        read_csv(spark, "payments", payments, **how),
        read_csv(spark, "returns", returns, **how),
        read_csv(spark, "reimbursements", reimbursements, **how),
        read_csv(spark, "ledger", ledger, required=stock, **how),
        options,
    )
    return write_reports(reports, folder)


def reconcile_shipments(
    spark: SparkSession,
    bookings: Paths,
    dispatch_cells: str,
    ledger: Paths,
    folder: str,
    *,
    date_pattern: str = "M/d/yyyy",
    strict: bool = True,
    thousands: bool = False,
) -> dict[str, str]:
    how = {"thousands": thousands, "strict": strict}
    reports = shipments.reconcile(
        read_bookings(spark, bookings, **how),
        dispatches_from_cells(spark.read.parquet(dispatch_cells), strict),
        read_csv(spark, "ledger", ledger, required=RECEIPT_COLUMNS, **how),
        date_pattern,
        strict,
    )
    return write_reports(reports, folder)


def reconcile_packing(
    spark: SparkSession,
    packing_cells: str,
    ledger: Paths,
    folder: str,
    *,
    date_pattern: str = "M/d/yyyy",
    strict: bool = True,
    thousands: bool = False,
) -> dict[str, str]:
    receipts = read_csv(spark, "ledger", ledger, required=RECEIPT_COLUMNS, strict=strict, thousands=thousands)
    lines = packing_from_cells(spark.read.parquet(packing_cells), strict)
    return write_reports(packing.reconcile(lines, receipts, date_pattern, strict), folder)
