"""Clean-up of the identifiers that the reports are joined on.

All functions take and return a ``Column`` and stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.values import text_or

# Tokens and positions that the reports' keys are built with.
MISSING_SKU = "Not Available"
CONDITION_SUFFIXES = ("_New", "_NEW")
SKU_PREFIX = "SKU-"
LONG_SKU = 13
LEDGER_PREFIX = "amzn"
EMBEDDED_SKU_START = 9
SKU_LENGTH = 12
SHIPMENT_ID_LENGTH = 12
DISPATCH_FILE_SUFFIX = "_ViewTransaction.xlsx"


def without_condition(sku: Column) -> Column:
    """Drop the condition suffixes wherever they stand."""
    for suffix in CONDITION_SUFFIXES:
        sku = F.replace(sku, F.lit(suffix), F.lit(""))
    return sku


def embedded_sku(code: Column) -> Column:
    """The stock number inside a longer marketplace code."""
    return F.substring(code, EMBEDDED_SKU_START, SKU_LENGTH)


def normalize_sku(sku: Column, prefix: str = SKU_PREFIX) -> Column:
    """SKU of a payment, return or reimbursement line."""
    plain = without_condition(text_or(sku, MISSING_SKU))
    plain = F.when(F.length(plain) > LONG_SKU, embedded_sku(plain)).otherwise(plain)
    return F.concat(F.lit(prefix), plain) if prefix else plain


def normalize_ledger_sku(sku: Column, prefix: str = SKU_PREFIX, missing: str = "nan") -> Column:
    """SKU of a ledger line that is matched against returned units."""
    inner = F.when(F.startswith(sku, F.lit(LEDGER_PREFIX)), embedded_sku(sku)).otherwise(sku)
    plain = first_chars(text_or(inner, missing), SKU_LENGTH)
    return F.concat(F.lit(prefix), plain) if prefix else plain


def without_decimal_suffix(code: Column) -> Column:
    """Undo a number-typed cell: ``123.0`` becomes ``123``."""
    return F.regexp_replace(code, r"\.0$", "")


def first_chars(code: Column, count: int) -> Column:
    return F.substring(code, 1, count)


def is_shipment_id(code: Column) -> Column:
    return F.length(code) == SHIPMENT_ID_LENGTH


def dispatch_file_name(shipment_id: Column) -> Column:
    """Name under which the warehouse reports the dispatch of a shipment."""
    return F.concat(shipment_id, F.lit(DISPATCH_FILE_SUFFIX))
