"""Aggregation to a reporting grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.values import sum_or_zero


def all_present(columns: Sequence[str]) -> Column:
    """Whether no column is null, in a form that scans can use."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def sum_by(df: DataFrame, keys: Sequence[str], **measures: str | Column) -> DataFrame:
    """Sum measures per key.

    Rows with a null in any key are left out, and a sum without values is 0.
    Spark combines rows before the shuffle, so one hot key costs one row per task.
    """
    sums = [
        sum_or_zero(F.col(source) if isinstance(source, str) else source).alias(name)
        for name, source in measures.items()
    ]
    return df.filter(all_present(keys)).groupBy(*keys).agg(*sums)


def with_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Distinct rows with the number of times each occurs."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))
