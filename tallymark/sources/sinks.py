"""Finished reports as tables in a folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, DoubleType, StringType

from tallymark.functions.values import sum_or_zero
from tallymark.operators.reporting import COPY_NO, FAIL, PASS, REPORTS, print_columns, totals, with_flags


def _file_system(df: DataFrame, folder: str):
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _publish(df: DataFrame, hidden: str, written: dict[str, str], mode: str) -> None:
    """Move finished tables to their places; nothing is moved if one of the places is taken."""
    path, files = _file_system(df, hidden)
    taken = [place for place in written.values() if files.exists(path(place))]
    if taken and mode != "overwrite":
        raise FileExistsError(f"there already: {', '.join(taken)}")
    for place in written.values():
        if place in taken:
            files.delete(path(place), True)
        if not files.rename(path(f"{hidden}/{place.rsplit('/', 1)[1]}"), path(place)):
            raise OSError(f"{place} could not be put in its place")


def _as_printed(kind: DataType) -> DataType:
    """Type of a plan column in a printed report."""
    if isinstance(kind, DateType):
        return StringType()
    return DoubleType() if isinstance(kind, DecimalType) else kind


def write_reports(
    reports: dict[str, DataFrame], folder: str, mode: str = "errorifexists", flag_counts: bool = False
) -> dict[str, str]:
    """Write each report with flags, and its totals beside it, and return the folders.

    All tables are written to a hidden folder first and moved when the last one is complete, so
    that a failed job leaves no table and can be run again.  Modes: ``errorifexists`` and ``overwrite``.
    Totals are observed by the job that writes a report, on exact decimals, so the report is neither computed
    nor read twice; Spark counts the part of a retried writing task once.  ``flag_counts`` also writes, for
    each flagged report, a table of PASS and FAIL counts by flag, from the same job.
    An empty report keeps its schema.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    folder = folder.rstrip("/")
    hidden = f"{folder}/_writing-{uuid.uuid4().hex}"
    written: dict[str, str] = {}
    any_report = next(iter(reports.values()), None)
    if any_report is None:
        return written
    try:
        for name, df in reports.items():
            for table in _write_report(df, name, hidden, flag_counts):
                written[table] = f"{folder}/{table}"
        _publish(any_report, hidden, written, mode)
    finally:
        path, files = _file_system(any_report, folder)
        files.delete(path(hidden), True)
    return written


def _write_report(df: DataFrame, name: str, folder: str, flag_counts: bool) -> list[str]:
    """Write a report, its totals and its counts of flags below a folder; the names of the tables."""
    layout, spark = REPORTS[name], df.sparkSession
    flagged = with_flags(df, name)
    flags = [c for c in flagged.columns if c not in df.columns] if flag_counts else []
    if layout.sort:
        number = [c for c in flagged.columns if c == COPY_NO]
        flagged = flagged.orderBy(*[F.col(c).asc_nulls_last() for c in (*layout.sort, *number)])
    figures = [sum_or_zero(F.col(c)).alias(c) for c in layout.totals]
    figures += [F.count_if(F.col(c) == verdict).alias(f"{c} {verdict}") for c in flags for verdict in (PASS, FAIL)]
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    watched = flagged.observe(seen, *figures) if figures else flagged
    print_columns(watched.drop(COPY_NO), name).write.parquet(f"{folder}/{name}")
    tables = [name]
    one_row = spark.range(0, 1, 1, 1)
    if layout.totals:
        sums = totals(df.select(*layout.columns), layout.totals).schema
        values = [F.lit(seen.get[f.name] if f.name in layout.totals else None) for f in sums]
        row = [v.cast(_as_printed(f.dataType)).alias(layout.columns[f.name]) for v, f in zip(values, sums)]
        one_row.select(*row).write.parquet(f"{folder}/{name}_totals")
        tables.append(f"{name}_totals")
    if flags:
        texts = {c: layout.columns[c.removesuffix("_status")] for c in flags}
        counts = [
            F.struct(
                F.lit(text).alias("column"),
                F.lit(seen.get[f"{c} {PASS}"]).cast("long").alias("passed"),
                F.lit(seen.get[f"{c} {FAIL}"]).cast("long").alias("failed"),
            )
            for c, text in texts.items()
        ]
        one_row.select(F.inline(F.array(*counts))).write.parquet(f"{folder}/{name}_flags")
        tables.append(f"{name}_flags")
    return tables
