"""Shipments: were booked cartons dispatched and booked units received?

Inputs (snake case; extra columns are ignored):

* bookings: fba_id, sku, cartons, qty, booking_date
* dispatches: fba_id, dispatch_date, sku, inv_qty, and file_name where it is known
* ledger: date_text, msku, quantity, event_type, reference_id
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.keys import (
    SKU_LENGTH,
    dispatch_file_name,
    first_chars,
    is_shipment_id,
    without_condition,
    without_decimal_suffix,
)
from tallymark.functions.values import (
    days_between,
    or_zero,
    sum_of_negatives,
    sum_of_positives,
    sum_or_zero,
    text_or,
    us_day,
    whole_number,
)
from tallymark.operators.grouping import all_present, with_copies
from tallymark.operators.joins import outer_join
from tallymark.operators.reporting import COPY_NO
from tallymark.operators.staging import stage
from tallymark.operators.units import repeat_rows

# Fixed value: the ledger's name for goods booked in.
RECEIPTS = "Receipts"

KEYS = ["fba_id", "sku"]


def clean_bookings(bookings: DataFrame, strict: bool = True) -> DataFrame:
    return (
        bookings.withColumn("fba_id", text_or(F.col("fba_id")))
        .filter(is_shipment_id(F.col("fba_id")))
        .select(
            "fba_id",
            without_condition(without_decimal_suffix(text_or(F.col("sku")))).alias("sku"),
            whole_number(F.col("cartons"), strict).alias("cartons"),
            whole_number(F.col("qty"), strict).alias("qty"),
            "booking_date",
        )
    )


def booked_ids(bookings: DataFrame) -> DataFrame:
    return bookings.select("fba_id").distinct()


def clean_dispatches(dispatches: DataFrame, bookings: DataFrame, strict: bool = True) -> DataFrame:
    """Dispatch lines from the files of booked shipments."""
    booked = booked_ids(bookings)
    if "file_name" in dispatches.columns:
        names = booked.select(dispatch_file_name(F.col("fba_id")).alias("file_name"))
        wanted = dispatches.join(names, "file_name", "left_semi")
    else:
        wanted = dispatches.join(booked, "fba_id", "left_semi")
    return wanted.filter(F.col("sku").isNotNull()).select(
        "fba_id",
        "dispatch_date",
        without_decimal_suffix(text_or(F.col("sku"))).alias("sku"),
        whole_number(F.col("inv_qty"), strict).alias("inv_qty"),
    )


def receipts(ledger: DataFrame, date_pattern: str = "M/d/yyyy", strict: bool = True) -> DataFrame:
    return ledger.filter(F.col("event_type") == RECEIPTS).select(
        F.col("reference_id").alias("fba_id"),
        first_chars(text_or(F.col("msku")), SKU_LENGTH).alias("sku"),
        us_day(F.col("date_text"), date_pattern, strict).alias("receipt_date"),
        "quantity",
    )


def booked_receipts(ledger: DataFrame, bookings: DataFrame, date_pattern: str = "M/d/yyyy", strict: bool = True) -> DataFrame:
    """Receipt lines of booked shipments."""
    return receipts(ledger, date_pattern, strict).join(booked_ids(bookings), "fba_id", "left_semi")


def _any_copy(lines: DataFrame) -> Column:
    """Whether grouped lines have rows, as a scalar subquery that reuses their shuffle."""
    return lines.agg((sum_or_zero(F.col("_dispatched")) > 0).alias("any_row")).scalar()


def _outer(bookings: DataFrame, dispatches: DataFrame, received: DataFrame) -> DataFrame:
    """Full outer join of grouped sides, which have a row per key and pair of numbers at most."""
    return bookings.join(dispatches, KEYS, "full_outer").join(received, KEYS, "full_outer")


def shipment_detail(
    bookings: DataFrame, dispatches: DataFrame, received: DataFrame, copy_no: str | None = None
) -> DataFrame:
    """Every booking line with every dispatch and receipt line of its key.

    The sides are joined as distinct lines with their number of copies, so that
    repeated lines of a hot key multiply only after the shuffles.  Skew handling can split
    each join; the first is staged, as it leaves joins on top of each other alone.  Without any
    dispatch, missing values and day counts stay null.  ``copy_no`` names a column that
    tells repeated lines apart.
    """
    sent = with_copies(dispatches, "_dispatched")
    booked_and_sent = stage(outer_join(with_copies(bookings, "_booked"), sent, KEYS), "lines")
    lines = outer_join(booked_and_sent, with_copies(received, "_received"), KEYS)
    one = F.lit(1).cast("bigint")
    copies = F.coalesce("_booked", one) * F.coalesce("_dispatched", one) * F.coalesce("_received", one)

    def filled(column: Column) -> Column:
        return F.when(F.col("_any"), or_zero(column)).otherwise(column)

    detail = lines.withColumn("_any", _any_copy(sent)).select(
        "fba_id",
        "booking_date",
        "dispatch_date",
        "sku",
        filled(F.col("cartons")).alias("cartons_booked"),
        or_zero(F.col("inv_qty")).alias("cartons_dispatched"),
        filled(F.col("qty")).alias("units_booked"),
        filled(F.col("quantity")).alias("units_received"),
        "receipt_date",
        F.when(F.col("_any"), or_zero(days_between(F.col("dispatch_date"), F.col("booking_date")))).cast("bigint").alias("dispatch_days"),
        F.when(F.col("_any"), or_zero(days_between(F.col("receipt_date"), F.col("dispatch_date")))).cast("bigint").alias("receipt_days"),
        copies.alias("_copies"),
    )
    return repeat_rows(detail, "_copies", ["fba_id", "sku", "booking_date", "dispatch_date", "receipt_date"], copy_no)


def shipment_by_sku(bookings: DataFrame, dispatches: DataFrame, received: DataFrame) -> DataFrame:
    """Booked, dispatched and received per shipment, SKU and booked and dispatched value.

    Equals grouping the detail report, without building it: receipts are added up
    first, and the lines they would have been repeated for are counted.
    """
    booked = (
        bookings.select(*KEYS, or_zero(F.col("cartons")).alias("cartons"), or_zero(F.col("qty")).alias("qty"))
        .groupBy(*KEYS, "cartons", "qty")
        .agg(F.count(F.lit(1)).alias("_booked"))
    )
    sent = (
        dispatches.select(*KEYS, or_zero(F.col("inv_qty")).alias("inv_qty"))
        .groupBy(*KEYS, "inv_qty")
        .agg(F.count(F.lit(1)).alias("_dispatched"))
    )
    arrived = received.groupBy(*KEYS).agg(sum_or_zero(F.col("quantity")).alias("quantity"))
    lines = _outer(booked, sent, arrived).filter(all_present(KEYS))
    one = F.lit(1).cast("bigint")
    return lines.filter(F.col("cartons").isNotNull() | _any_copy(sent)).select(
        *KEYS,
        or_zero(F.col("cartons")).alias("cartons_booked"),
        or_zero(F.col("inv_qty")).alias("cartons_dispatched"),
        (or_zero(F.col("cartons")) - or_zero(F.col("inv_qty"))).alias("cartons_short_dispatched"),
        or_zero(F.col("qty")).alias("units_booked"),
        (or_zero(F.col("quantity")) * F.coalesce("_booked", one) * F.coalesce("_dispatched", one)).alias("units_received"),
    ).withColumn("units_short_received", F.col("units_booked") - F.col("units_received"))


def shipment_exceptions(by_sku: DataFrame) -> DataFrame:
    return by_sku.filter((F.col("cartons_short_dispatched") != 0) | (F.col("units_short_received") != 0))


def shipment_summary(by_sku: DataFrame) -> DataFrame:
    """Totals per shipment, with shortages and excesses added up apart."""
    return by_sku.groupBy("fba_id").agg(
        F.count("sku").alias("sku_count"),
        sum_or_zero(F.col("cartons_booked")).alias("cartons_booked"),
        sum_or_zero(F.col("cartons_dispatched")).alias("cartons_dispatched"),
        sum_of_negatives(F.col("cartons_short_dispatched")).alias("excess_cartons_dispatched"),
        sum_of_positives(F.col("cartons_short_dispatched")).alias("short_cartons_dispatched"),
        sum_or_zero(F.col("units_booked")).alias("units_booked"),
        sum_or_zero(F.col("units_received")).alias("units_received"),
        sum_of_negatives(F.col("units_short_received")).alias("excess_units_received"),
        sum_of_positives(F.col("units_short_received")).alias("short_units_received"),
    )


def shipment_kpis(by_sku: DataFrame) -> DataFrame:
    """One row of headline figures; received and short units come back negated."""
    short = F.col("units_short_received")
    return by_sku.agg(
        sum_or_zero(F.col("units_booked")).alias("units_booked"),
        sum_of_negatives(short).alias("excess_units_received"),
        (-sum_of_positives(short)).alias("short_units_received"),
        (-sum_or_zero(F.col("units_received"))).alias("units_received"),
        F.count_if(short == 0).alias("matching_skus"),
        F.count_if(short != 0).alias("mismatching_skus"),
    )


def reconcile(
    bookings: DataFrame, dispatches: DataFrame, ledger: DataFrame, date_pattern: str = "M/d/yyyy", strict: bool = True
) -> dict[str, DataFrame]:
    """Summary, exceptions, SKU-wise and detail reports, and the headline figures.

    What several of them read is staged once.  The detail report numbers its copies so
    that the sink can sort and spread a line repeated very often.
    """
    booked = stage(clean_bookings(bookings, strict), "bookings")
    sent = stage(clean_dispatches(dispatches, booked, strict), "dispatches")
    arrived = stage(booked_receipts(ledger, booked, date_pattern, strict), "receipts")
    by_sku = stage(shipment_by_sku(booked, sent, arrived), "by-sku")
    return {
        "shipment_summary": shipment_summary(by_sku),
        "shipment_exceptions": shipment_exceptions(by_sku),
        "shipment_by_sku": by_sku,
        "shipment_detail": shipment_detail(booked, sent, arrived, copy_no=COPY_NO),
        "shipment_kpis": shipment_kpis(by_sku),
    }
