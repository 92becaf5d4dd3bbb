"""Small helpers on frames that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_bytes(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """Number of rows and of text bytes, added up by Spark; two numbers reach the driver."""
    row = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(column).cast("string"))), F.lit(0))).first()
    return int(row[0]), int(row[1])


def id_remainder(column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a missing id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor


def plain_text(docs: DataFrame, column: str = "text") -> Column:
    """The text, empty if it is missing."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))
