"""Missing values, numbers and dates with the rules the reports need.

Bad input raises by default.  ``strict=False`` turns it into null instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Prorated money: divided, so it is rounded once per row and then summed exactly.
PRORATED = "decimal(28,6)"
PRORATED_SCALE = 6
MISSING_TEXT = "nan"


def text_or(column: Column, missing: str = MISSING_TEXT) -> Column:
    """Text of a value, with a token in place of null so that grouping keeps the row."""
    return F.coalesce(column.cast("string"), F.lit(missing))


def sum_or_zero(column: Column) -> Column:
    """Sum that is 0, not null, for a group without any value."""
    return F.coalesce(F.sum(column), F.lit(0))


def sum_of_positives(column: Column) -> Column:
    return sum_or_zero(F.when(column > 0, column))


def sum_of_negatives(column: Column) -> Column:
    """Sum of the values below 0, turned positive."""
    return sum_or_zero(F.when(column < 0, -column))


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def whole_number(column: Column, strict: bool | None = None) -> Column:
    """Integer from a number or a number-like text such as ``12.0`` (truncates).

    By default text that is no number raises and a missing value stays null.  With
    ``strict`` a missing value raises too; with ``strict=False`` neither does.
    """
    if strict is False:
        return column.try_cast("decimal(24,4)").cast("bigint")
    number = column.cast("decimal(24,4)").cast("bigint")
    return F.coalesce(number, F.raise_error(F.lit("a whole number is missing")).cast("bigint")) if strict else number


def money(column: Column, thousands: bool = False, strict: bool = True) -> Column:
    """Amount with two decimals; ``thousands`` also accepts ``1,234.50``."""
    if thousands:
        column = F.replace(column.cast("string"), F.lit(","), F.lit(""))
    return column.cast(MONEY) if strict else column.try_cast(MONEY)


def prorated(amount: Column, over: Column, share: Column) -> Column:
    """``amount / over * share``; null where ``over`` is 0."""
    ratio = F.try_divide(amount.cast("double"), over.cast("double"))
    return F.round(ratio * share.cast("double"), PRORATED_SCALE).cast(PRORATED)


def day(column: Column, pattern: str, strict: bool = True) -> Column:
    if strict:
        return F.to_date(column, pattern)
    return F.try_to_date(column, pattern)


def iso_day(column: Column, strict: bool = True) -> Column:
    """Date from the first ten characters of an ISO timestamp text."""
    return day(F.substring(column, 1, 10), "yyyy-M-d", strict)


def us_day(column: Column, pattern: str = "M/d/yyyy", strict: bool = True) -> Column:
    """Date from month-first text, with or without leading zeros."""
    return day(column, pattern, strict)


def day_from_file_name(name: Column, strict: bool = True) -> Column:
    """Date from a file name such as ``2022_04_19-first batch.csv``."""
    return day(F.substring_index(name, "-", 1), "yyyy_M_d", strict)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def day_text(column: Column, pattern: str, missing: str | None = None) -> Column:
    text = F.date_format(column, pattern)
    return text if missing is None else F.coalesce(text, F.lit(missing))
