"""Packing lists against receipts: did the packed units arrive, and how fast?

Inputs (snake case; extra columns are ignored):

* packing: carton_id, upc_number, total_qty, bl_date
* ledger: date_text, msku, quantity, event_type, reference_id
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.keys import SHIPMENT_ID_LENGTH, first_chars
from tallymark.functions.values import days_between, or_zero, sum_or_zero, text_or, us_day
from tallymark.operators.grouping import all_present, sum_by
from tallymark.operators.staging import stage
from tallymark.plans.shipments import RECEIPTS

KEYS = ["fba_id", "sku_id"]


def packing_lines(packing: DataFrame) -> DataFrame:
    """Carton lines with the shipment id that starts each carton id."""
    return packing.filter(F.col("carton_id").isNotNull()).select(
        first_chars(F.col("carton_id"), SHIPMENT_ID_LENGTH).alias("fba_id"),
        text_or(F.col("upc_number")).alias("sku_id"),
        "bl_date",
        "total_qty",
    )


def receipt_lines(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("event_type") == RECEIPTS).select(
        F.col("reference_id").alias("fba_id"), text_or(F.col("msku")).alias("sku_id"), "date_text", "quantity"
    )


def packing_vs_receipts(packed: DataFrame, received: DataFrame) -> DataFrame:
    """Packed and received quantity per shipment and SKU."""
    arrived = sum_by(received, KEYS, qty_inv_ledger="quantity")
    return (
        sum_by(packed, KEYS, qty_packing_list="total_qty")
        .join(arrived, KEYS, "left")
        .withColumn("qty_inv_ledger", or_zero(F.col("qty_inv_ledger")))
        .withColumn("excess_short_received", F.col("qty_inv_ledger") - F.col("qty_packing_list"))
    )


def packing_vs_receipts_dated(
    packed: DataFrame, received: DataFrame, date_pattern: str = "M/d/yyyy", strict: bool = True
) -> DataFrame:
    """The same per loading date and receipt date, with the days between them."""
    arrived = sum_by(received, [*KEYS, "date_text"], qty_inv_ledger="quantity").select(
        *KEYS, us_day(F.col("date_text"), date_pattern, strict).alias("receipt_date"), "qty_inv_ledger"
    )
    return (
        sum_by(packed, [*KEYS, "bl_date"], qty_packing_list="total_qty")
        .join(arrived, KEYS, "left")
        .select(
            *KEYS,
            "qty_packing_list",
            "bl_date",
            or_zero(F.col("qty_inv_ledger")).alias("qty_inv_ledger"),
            "receipt_date",
            days_between(F.col("receipt_date"), F.col("bl_date")).cast("bigint").alias("transit_days"),
        )
    )


def reconcile(packing: DataFrame, ledger: DataFrame, date_pattern: str = "M/d/yyyy", strict: bool = True) -> dict[str, DataFrame]:
    """Both reports, from lines that are added up and staged once."""
    packed = stage(_compact(packing_lines(packing), "bl_date", "total_qty"), "packed")
    received = stage(_compact(receipt_lines(ledger), "date_text", "quantity"), "receipts")
    return {
        "packing_vs_receipts": packing_vs_receipts(packed, received),
        "packing_vs_receipts_dated": packing_vs_receipts_dated(packed, received, date_pattern, strict),
    }


def _compact(lines: DataFrame, date: str, quantity: str) -> DataFrame:
    """Sums per key and day.  A null day stays: only the dated report leaves it out."""
    return lines.filter(all_present(KEYS)).groupBy(*KEYS, date).agg(sum_or_zero(F.col(quantity)).alias(quantity))
