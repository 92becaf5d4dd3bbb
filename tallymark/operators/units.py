"""One row per unit from rows that carry a quantity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.grouping import sum_by

RUN_SIZE = 256
MAX_RUNS = 65_536


def _checked(quantity: str) -> Column:
    whole = F.col(quantity).cast("bigint")
    message = F.concat(F.lit(f"negative {quantity}: "), whole.cast("string"))
    return F.when(whole < 0, F.raise_error(message).cast("bigint")).otherwise(whole)


def split_runs(
    df: DataFrame,
    quantity: str,
    *,
    run_no: str = "run_no",
    first_unit: str = "first_unit",
    units: str = "units",
    run_size: int = RUN_SIZE,
) -> DataFrame:
    """Cut a quantity into runs of consecutive units.

    A run holds ``run_size`` units, or more where a single row would otherwise need
    over ``MAX_RUNS`` runs.  The runs of a huge row are rows of their own, so a later
    shuffle can spread them.  Quantities are truncated; 0 gives no run, a negative
    quantity raises (``non_negative`` sets such rows aside beforehand).
    """
    whole = _checked(quantity)
    step = F.greatest(F.lit(run_size).cast("bigint"), F.ceil(whole / MAX_RUNS))
    return (
        df.filter(whole >= 1)
        .withColumn("_whole", whole)
        .withColumn("_step", step)
        .withColumn(run_no, F.explode(F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("_whole") / F.col("_step")))))
        .withColumn(first_unit, (F.col(run_no) - 1) * F.col("_step"))
        .withColumn(units, F.least(F.col("_step"), F.col("_whole") - F.col(first_unit)))
        .drop("_whole", "_step")
    )


def repeat_rows(df: DataFrame, copies: str, spread_by: Sequence[str], copy_no: str | None = None) -> DataFrame:
    """Repeat each row ``copies`` times, dropping that column; ``copy_no`` tells copies apart.

    Runs are shuffled before they are expanded, so the copies of one row are made
    by many tasks.
    """
    kept = df.drop(copies).columns
    runs = split_runs(df, copies, run_no="_run", first_unit="_first", units="_units")
    spread = runs.repartition(*spread_by, "_run")
    numbers = F.sequence(F.col("_first") + 1, F.col("_first") + F.col("_units"))
    numbered = spread.withColumn("_copy", F.explode(numbers))
    return numbered.select(*kept, *([F.col("_copy").alias(copy_no)] if copy_no else []))


def explode_units(df: DataFrame, keys: Sequence[str], quantity: str, unit_no: str = "unit_no") -> DataFrame:
    """Units of a report, numbered from 1 within their natural keys.

    Lines with equal keys are added up first: their units are alike, and numbering
    them then needs no sort.
    """
    lines = df.withColumn(quantity, _checked(quantity)).filter(F.col(quantity) >= 1)
    totals = sum_by(lines, keys, _quantity=quantity)
    runs = split_runs(totals, "_quantity").repartition(*keys, "run_no")
    numbers = F.sequence(F.col("first_unit") + 1, F.col("first_unit") + F.col("units"))
    return runs.select(*keys, F.explode(numbers).alias(unit_no))


def negative_quantities(df: DataFrame, quantity: str) -> DataFrame:
    """Lines whose quantity cannot be turned into units."""
    return df.filter(F.col(quantity) < 0)


def non_negative(df: DataFrame, quantity: str) -> DataFrame:
    """The other lines."""
    return df.filter(~F.coalesce(F.col(quantity) < 0, F.lit(False)))
