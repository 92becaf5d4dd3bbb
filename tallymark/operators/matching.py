"""One-to-one matching of units by nearest date.

Every unit on the left takes at most one unit on the right of the same block, not
earlier than itself; the pair with the smallest gap goes first, and among units of
one day the first in order.  Taking pairs in that order equals pairing brackets on
the time line of a block: a left unit opens, a right unit closes the latest one
still open.  No pair table is built.

The work is done on daily counts.  One pass over the days of a block keeps a stack of
left days with open units: a right day closes whole entries from the top and at most
one in part.  So a block has at most one range of ranks per left day, one per right day
and one unmatched rest per left day, however many units there are.  The pass is a Python function over
sorted partitions, because a stack is no window function; it sees two rows per block and
day at most, and holds no more than the open days of one block.

The outcome of a day is a list of rank ranges, each with its right day.  The rows of
that day, in order, tile the same ranks, so laying one tiling over the other in a
window gives every row its outcome.  Rows are dealt by ranges of block, day and order, so a day
with very many rows spans several partitions, and each part is a window of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.grouping import all_present
from tallymark.operators.staging import stage

LEFT, RIGHT = 0, 1


def daily_units(df: DataFrame, block: Sequence[str], date: str, units: str) -> DataFrame:
    """Units per block and day; rows without block or day cannot be matched."""
    whole = F.col(units).cast("bigint")
    message = F.concat(F.lit(f"negative {units}: "), whole.cast("string"))
    checked = F.when(whole < 0, F.raise_error(message).cast("bigint")).otherwise(whole)
    return (
        df.withColumn("_whole", checked)
        .filter(all_present([*block, date]) & (F.col("_whole") >= 1))
        .groupBy(*block, F.col(date).alias("day"))
        .agg(F.sum("_whole").alias("units"))
    )


def _pairing(block: list[str]):
    """Ranges of ranks per left day from sorted daily counts."""

    def run(batches):
        import pyarrow as pa

        stack, owner, out = [], None, []

        def rest():
            out.extend((*owner, day, first, last, None) for day, first, last in stack)
            stack.clear()

        for batch in batches:
            types = [batch.schema.field(name).type for name in (*block, "day")]
            columns = [batch.column(name).to_pylist() for name in (*block, "day", "side", "units")]
            for *key, day, side, units in zip(*columns):
                if key != owner:
                    rest()
                    owner = key
                if side == 0:
                    stack.append((day, 1, units))
                    continue
                while units and stack:
                    left_day, first, last = stack.pop()
                    taken = min(units, last - first + 1)
                    out.append((*owner, left_day, first, first + taken - 1, day))
                    units -= taken
                    if first + taken <= last:
                        stack.append((left_day, first + taken, last))
            yield made(pa, out, types)
            out.clear()
        if stack:
            rest()
            yield made(pa, out, types)

    def made(pa, rows, types):
        types = [*types, pa.int64(), pa.int64(), types[-1]]
        names = [*block, "day", "first", "last", "right_day"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return run


def daily_matches(left_days: DataFrame, right_days: DataFrame, block: Sequence[str]) -> DataFrame:
    """For each block and left day, which ranks of that day go to which right day.

    ``left_days`` and ``right_days`` come from ``daily_units``.  The ranges ``first`` to
    ``last`` of one day cover all of its units; a null ``right_day`` marks the unmatched
    rest.
    """
    block = list(block)
    events = left_days.select(*block, "day", F.lit(LEFT).alias("side"), "units").unionByName(
        right_days.select(*block, "day", F.lit(RIGHT).alias("side"), "units")
    )
    schema = T.StructType([events.schema[name] for name in (*block, "day")])
    schema.add("first", T.LongType()).add("last", T.LongType()).add("right_day", schema["day"].dataType)
    in_time = events.repartition(*block).sortWithinPartitions(*block, "day", "side")
    return in_time.mapInArrow(_pairing(block), schema)


def match_nearest(
    left: DataFrame,
    right_days: DataFrame,
    *,
    block: Sequence[str],
    left_date: str,
    order: Sequence[str],
    units: str = "units",
    partitions: int | None = None,
) -> DataFrame:
    """Match the units of ``left`` against the daily units of the right side.

    The rows of ``left`` stand for ``units`` alike units each; ``order`` ranks rows of one
    block and day and must be unique there.  Every row comes back cut by outcome, with
    the number of ``units`` that share it, the ``right_date`` (null if unmatched) and the
    ``gap_days``.  Rows without a block or date are kept as unmatched.

    The left side is written once, in ranges of block, day and order (as many as
    ``partitions``, or as the session's shuffles have).
    """
    block = list(block)
    kept = left.columns
    days = [*block, left_date]
    dealt = (partitions, *days, *order) if partitions else (*days, *order)
    left = stage(left.repartitionByRange(*dealt).withColumn("slice", F.spark_partition_id()), "left-units")
    dated = left.filter(all_present(days))
    ranges = daily_matches(daily_units(left, block, left_date, units), right_days, block).withColumnRenamed("day", left_date)

    # Only a group that crosses a border between partitions has several slices, so there are
    # fewer such groups than partitions, and no more of their slices than partitions and groups.
    per_slice = dated.groupBy(*days, "slice").agg(F.sum(F.col(units).cast("bigint")).alias("total"))
    over = Window.partitionBy(*days)
    before = F.sum("total").over(over.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    bounds = (
        per_slice.withColumn("before", F.coalesce(before, F.lit(0).cast("bigint")))
        .withColumn("slices", F.count(F.lit(1)).over(over))
        .filter("slices > 1")
        .select(*days, "slice", "before", "total")
    )
    cut = bounds.groupBy(*days).agg(F.collect_list(F.struct("slice", "before", "total")).alias("slices"))
    inside = F.filter(
        "slices", lambda s: (F.col("last") > s["before"]) & (F.col("first") <= s["before"] + s["total"])
    )
    none = F.lit(0).cast("bigint")
    whole = F.array(F.struct(F.lit(0).alias("slice"), none.alias("before"), none.alias("total")))
    outcomes = (
        ranges.join(F.broadcast(cut), days, "left")
        .withColumn("part", F.explode(F.coalesce(inside, whole)))
        .select(
            *days,
            F.col("part.slice").alias("slice"),
            F.lit(None).alias("row"),
            F.lit(0).alias("_size"),
            F.greatest(F.col("first") - F.col("part.before"), F.lit(1)).alias("first"),
            F.struct("right_day").alias("range"),
        )
    )
    several = F.broadcast(cut.select(*days, F.lit(True).alias("_several")))
    rows = dated.join(several, days, "left").select(
        *days,
        F.when(F.col("_several"), F.col("slice")).otherwise(0).alias("slice"),
        F.struct(*kept).alias("row"),
        F.col(units).alias("_size"),
        F.lit(None).alias("first"),
        F.lit(None).alias("range"),
    )

    # Rows and ranges share one shuffle; both windows run on it.
    place = Window.partitionBy(*days, "slice")
    in_order = place.orderBy(*[F.col(f"row.{name}") for name in order])
    by_rank = place.orderBy("first")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.col("row").isNotNull(), F.struct("row", "_last"))
    matched = (
        rows.unionByName(outcomes)
        .withColumn("_last", F.sum("_size").over(in_order.rowsBetween(*so_far)))
        .withColumn("first", F.coalesce("first", F.col("_last") - F.col("_size") + 1))
        .withColumn("_own", F.last(own, ignorenulls=True).over(by_rank.rowsBetween(*so_far)))
        .withColumn("range", F.last("range", ignorenulls=True).over(by_rank.rowsBetween(*so_far)))
        .withColumn("_units", F.coalesce(F.lead("first").over(by_rank), F.col("_own._last") + 1) - F.col("first"))
        .filter(F.col("_units") > 0)
        .select("_own.row.*", "range.right_day", "_units")
    )
    undated = left.filter(~all_present(days)).select(
        *kept, F.lit(None).cast("date").alias("right_day"), F.col(units).alias("_units")
    )
    return (
        matched.select(*kept, "right_day", "_units")
        .unionByName(undated)
        .withColumn(units, F.col("_units"))
        .select(*kept, F.col("right_day").alias("right_date"), F.datediff("right_day", left_date).alias("gap_days"))
    )
