"""Finished reports: column names, pass and fail flags, totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.values import day_text, sum_or_zero

PASS, FAIL = "PASS", "FAIL"
DETAIL, TOTAL = "DETAIL", "TOTAL"
KIND = "Row Kind"
# Column that tells repeated lines apart while a report is sorted; not printed.
COPY_NO = "copy_no"


@dataclass(frozen=True)
class Report:
    """Layout of a report: ``columns`` maps plan columns, in order, to printed names.

    ``totals``, ``flags`` and ``sort`` name plan columns.  ``missing_dates`` is printed
    for a null date; ``date_flags`` and ``zero_flags`` mark missing dates and zeros.
    """

    title: str
    columns: dict[str, str]
    totals: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    date_pattern: str = "yyyy-MM-dd"
    missing_dates: str | None = None
    date_flags: tuple[str, ...] = ()
    zero_flags: tuple[str, ...] = ()
    sort: tuple[str, ...] = field(default=())


# Sheet titles and column names of the reports.
REPORTS: dict[str, Report] = {
    "refunds_vs_returns": Report(
        title="1. Refunds vs Returns",
        columns={
            "order_id": "Order ID",
            "sku": "SKU",
            "quantity_refund": "Refund Quantity",
            "total": "Refund Amount",
            "quantity_returns": "Customer Returns",
            "reimbursed": "Reimbursed",
            "returned_to_inventory": "Added to Inventory",
            "quantity_difference": "Quantity Difference",
            "amount_difference": "Amount Difference",
        },
        totals=(
            "quantity_refund",
            "total",
            "quantity_returns",
            "reimbursed",
            "returned_to_inventory",
            "quantity_difference",
            "amount_difference",
        ),
        flags=("quantity_difference", "amount_difference"),
    ),
    "returns_vs_reimbursements": Report(
        title="2. Returns vs Reimbursements",
        columns={
            "order_id": "Order ID",
            "sku": "SKU",
            "total": "Refund Amount",
            "reimbursed": "Reimbursed Quantity",
            "amount_total": "Reimbursed Amount",
            "quantity_reimbursed_cash": "Cash Reimbursement",
            "quantity_reimbursed_inventory": "Inventory Reimbursement",
            "quantity_reimbursed_total": "Total Reimbursement",
            "quantity_difference": "Quantity Difference",
            "amount_difference": "Amount Difference",
        },
        totals=(
            "total",
            "reimbursed",
            "amount_total",
            "quantity_reimbursed_cash",
            "quantity_reimbursed_inventory",
            "quantity_reimbursed_total",
            "quantity_difference",
            "amount_difference",
        ),
        flags=("quantity_difference", "amount_difference"),
    ),
    "cash_reimbursement": Report(
        title="3. Cash Reimbursement",
        columns={
            "order_id": "Order ID",
            "sku": "SKU",
            "quantity_reimbursed_cash": "Quantity Reimbursed",
            "amount_total": "Amount Reimbursed",
            "quantity_settled": "Quantity Settled",
            "amount_settled": "Amount Settled",
            "quantity_difference": "Quantity Difference",
            "amount_difference": "Amount Difference",
        },
        totals=(
            "quantity_reimbursed_cash",
            "amount_total",
            "quantity_settled",
            "amount_settled",
            "quantity_difference",
            "amount_difference",
        ),
        flags=("quantity_difference", "amount_difference"),
    ),
    "returned_to_inventory": Report(
        title="4. Returned to Inventory",
        columns={
            "sku": "SKU",
            "fulfillment_center_id": "Fulfillment Center",
            "return_day": "Return Date",
            "return_quantity": "Return Quantity",
            "total": "Amount",
            "date_added": "Date added to Inventory",
            "quantity_added": "Quantity Added",
            "days_difference": "Days Difference",
            "quantity_difference": "Quantity Difference",
            "amount_difference": "Amount Difference",
        },
        totals=("return_quantity", "total", "quantity_added", "quantity_difference", "amount_difference"),
        flags=("quantity_difference", "amount_difference"),
        date_pattern="MM/dd/yyyy",
    ),
    "inventory_reimbursement": Report(
        title="5. Inventory Reimbursement",
        columns={
            "sku": "SKU",
            "fulfillment_center_id": "Fulfillment Center",
            "approval_day": "Approval Date",
            "reimbursed": "Quantity",
            "total": "Amount",
            "quantity_added": "Quantity Received",
            "date_added": "Received Date",
            "days_difference": "Days Difference",
            "quantity_difference": "Quantity Difference",
            "amount_difference": "Amount Difference",
        },
        totals=("reimbursed", "total", "quantity_added", "quantity_difference", "amount_difference"),
        flags=("quantity_difference", "amount_difference"),
        date_pattern="MM/dd/yyyy",
    ),
    "shipment_summary": Report(
        title="FBA Summary",
        columns={
            "fba_id": "FBA ID",
            "sku_count": "SKU",
            "cartons_booked": "CARTONS BOOKED",
            "cartons_dispatched": "CARTONS DISPATCHED",
            "excess_cartons_dispatched": "EXCESS CARTONS DISPATCHED",
            "short_cartons_dispatched": "SHORT CARTONS DISPATCHED",
            "units_booked": "UNITS BOOKED",
            "units_received": "UNITS RECEIVED",
            "excess_units_received": "EXCESS UNITS RECEIVED",
            "short_units_received": "SHORT UNITS RECEIVED",
        },
        totals=(
            "sku_count",
            "cartons_booked",
            "cartons_dispatched",
            "excess_cartons_dispatched",
            "short_cartons_dispatched",
            "units_booked",
            "units_received",
            "excess_units_received",
            "short_units_received",
        ),
        flags=(
            "excess_cartons_dispatched",
            "short_cartons_dispatched",
            "excess_units_received",
            "short_units_received",
        ),
    ),
    "shipment_exceptions": Report(
        title="FBA Exceptions",
        columns={
            "fba_id": "FBA ID",
            "sku": "SKU",
            "cartons_booked": "CARTONS BOOKED",
            "cartons_dispatched": "CARTONS DISPATCHED",
            "cartons_short_dispatched": "CARTONS SHORT DISPATCHED",
            "units_booked": "UNITS BOOKED",
            "units_received": "UNITS RECEIVED",
            "units_short_received": "UNITS SHORT RECEIVED",
        },
        totals=("cartons_short_dispatched", "units_short_received"),
        flags=("cartons_short_dispatched", "units_short_received"),
    ),
    "shipment_by_sku": Report(
        title="FBA SKU-wise",
        columns={
            "fba_id": "FBA ID",
            "sku": "SKU",
            "cartons_booked": "CARTONS BOOKED",
            "cartons_dispatched": "CARTONS DISPATCHED",
            "cartons_short_dispatched": "CARTONS SHORT DISPATCHED",
            "units_booked": "UNITS BOOKED",
            "units_received": "UNITS RECEIVED",
            "units_short_received": "UNITS SHORT RECEIVED",
        },
        totals=(
            "cartons_booked",
            "cartons_dispatched",
            "cartons_short_dispatched",
            "units_booked",
            "units_received",
            "units_short_received",
        ),
        flags=("cartons_short_dispatched", "units_short_received"),
    ),
    "shipment_detail": Report(
        title="FBA Detail",
        columns={
            "fba_id": "FBA ID",
            "booking_date": "BOOKING DATE",
            "dispatch_date": "DISPATCH DATE",
            "sku": "SKU",
            "cartons_booked": "CARTONS BOOKED",
            "cartons_dispatched": "CARTONS DISPATCHED",
            "units_booked": "UNITS BOOKED",
            "units_received": "UNITS RECEIVED",
            "receipt_date": "RECEIPT DATE",
            "dispatch_days": "DISPATCH DAYS",
            "receipt_days": "RECEIPT DAYS",
        },
        missing_dates="NOT AVAILABLE",
        date_flags=("booking_date", "dispatch_date", "receipt_date"),
        zero_flags=("cartons_booked", "cartons_dispatched", "units_booked", "units_received"),
        sort=(
            "fba_id",
            "booking_date",
            "dispatch_date",
            "sku",
            "cartons_booked",
            "cartons_dispatched",
            "units_booked",
            "units_received",
        ),
    ),
    "shipment_kpis": Report(
        title="FBA Key Figures",
        columns={
            "units_booked": "UNITS BOOKED",
            "excess_units_received": "EXCESS UNITS RECEIVED",
            "short_units_received": "SHORT UNITS RECEIVED",
            "units_received": "UNITS RECEIVED",
            "matching_skus": "MATCHING SKUS",
            "mismatching_skus": "MISMATCHING SKUS",
        },
    ),
    "packing_vs_receipts": Report(
        title="SKU-wise",
        columns={
            "fba_id": "FBA ID",
            "sku_id": "SKU ID",
            "qty_packing_list": "Qty: Packing List",
            "qty_inv_ledger": "Qty: Inv Ledger",
            "excess_short_received": "Excess/(Short) Received",
        },
        flags=("excess_short_received",),
    ),
    "packing_vs_receipts_dated": Report(
        title="SKU-wise Date-wise",
        columns={
            "fba_id": "FBA ID",
            "sku_id": "SKU ID",
            "qty_packing_list": "Qty: Packing List",
            "bl_date": "BL Date",
            "qty_inv_ledger": "Qty: Inv Ledger",
            "receipt_date": "Receipt Date",
            "transit_days": "Transit Days",
        },
        missing_dates="-",
    ),
}


REPORTS["rejected_quantities"] = Report(
    title="Rejected quantities",
    columns={"source": "Report", "order_id": "Order ID", "sku": "SKU", "date": "Date", "quantity": "Quantity"},
)


def zero_flag(value: Column) -> Column:
    """PASS where a difference is 0; a missing difference fails too."""
    return F.when(value == 0, PASS).otherwise(FAIL)


def with_flags(df: DataFrame, name: str) -> DataFrame:
    """Add a ``<column>_status`` for every flagged column of a report."""
    report = REPORTS[name]
    status = {f"{c}_status": zero_flag(F.col(c)) for c in report.flags}
    status |= {f"{c}_status": F.when(F.col(c).isNull(), FAIL).otherwise(PASS) for c in report.date_flags}
    status |= {f"{c}_status": F.when(F.col(c) == 0, FAIL).otherwise(PASS) for c in report.zero_flags}
    return df.withColumns(status) if status else df


def totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the sums of some columns; the others are null."""
    sums = df.agg(*[sum_or_zero(F.col(c)).alias(c) for c in columns])
    return sums.select(
        *[F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]
    )


def with_totals(df: DataFrame, columns: Sequence[str], kind: str = KIND) -> DataFrame:
    """The rows of a report and its totals row, told apart by a ``kind`` column."""
    return df.withColumn(kind, F.lit(DETAIL)).unionByName(totals(df, columns).withColumn(kind, F.lit(TOTAL)))


def _printed(field_: T.StructField, report: Report) -> Column:
    column = F.col(field_.name)
    if isinstance(field_.dataType, T.DateType):
        return day_text(column, report.date_pattern, report.missing_dates)
    if isinstance(field_.dataType, T.DecimalType):
        return column.cast("double")
    return column


def print_columns(df: DataFrame, name: str) -> DataFrame:
    """A plan's result with the names, order and date texts of its report.

    Columns the report does not name, such as flags, follow behind under a title-case
    name.
    """
    report = REPORTS[name]
    fields = {f.name: f for f in df.schema}
    named = [_printed(fields[c], report).alias(text) for c, text in report.columns.items()]
    others = []
    for column in df.columns:
        if column not in report.columns:
            source = column.removesuffix("_status")
            text = f"{report.columns[source]} Status" if source in report.columns else column
            others.append(_printed(fields[column], report).alias(text))
    return df.select(*named, *others)
