"""Report files as DataFrames with declared columns.

Each file's columns are found by its header, so neither extra columns nor their order
matter, and then cast.  Identifiers stay text.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.values import MONEY, day_from_file_name, money, whole_number
from tallymark.operators.staging import stage


@dataclass(frozen=True)
class Source:
    """``columns`` maps header names to snake-case names and types."""

    columns: dict[str, tuple[str, str]]
    first_column: str | None = None
    upper_header: bool = False


# Header names of the reports.
SOURCES: dict[str, Source] = {
    "payments": Source(
        first_column="date/time",
        columns={
            "date/time": ("posted", "string"),
            "type": ("type", "string"),
            "order id": ("order_id", "string"),
            "sku": ("sku", "string"),
            "description": ("description", "string"),
            "quantity": ("quantity", "bigint"),
            "total": ("total", MONEY),
        },
    ),
    "returns": Source(
        columns={
            "order-id": ("order_id", "string"),
            "sku": ("sku", "string"),
            "status": ("status", "string"),
            "quantity": ("quantity", "bigint"),
            "return-date": ("return_date", "string"),
            "fulfillment-center-id": ("fulfillment_center_id", "string"),
        },
    ),
    "reimbursements": Source(
        columns={
            "reason": ("reason", "string"),
            "approval-date": ("approval_date", "string"),
            "amazon-order-id": ("amazon_order_id", "string"),
            "sku": ("sku", "string"),
            "amount-total": ("amount_total", MONEY),
            "quantity-reimbursed-cash": ("quantity_reimbursed_cash", "bigint"),
            "quantity-reimbursed-inventory": ("quantity_reimbursed_inventory", "bigint"),
            "quantity-reimbursed-total": ("quantity_reimbursed_total", "bigint"),
        },
    ),
    "ledger": Source(
        columns={
            "Date": ("date_text", "string"),
            "MSKU": ("msku", "string"),
            "Quantity": ("quantity", "bigint"),
            "Fulfillment Center": ("fulfillment_center", "string"),
            "Event Type": ("event_type", "string"),
            "Disposition": ("disposition", "string"),
            "Reference ID": ("reference_id", "string"),
        },
    ),
    "bookings": Source(
        upper_header=True,
        columns={
            "FBA ID": ("fba_id", "string"),
            "SKU": ("sku", "string"),
            "CARTONS": ("cartons", "bigint"),
            "QTY": ("qty", "bigint"),
        },
    ),
    "dispatches": Source(
        upper_header=True,
        columns={
            "FBA ID": ("fba_id", "string"),
            "DISPATCH DATE": ("dispatch_date", "date"),
            "SKU": ("sku", "string"),
            "INV QTY": ("inv_qty", "bigint"),
        },
    ),
    "packing": Source(
        columns={
            "FBA Id /  Carton Id": ("carton_id", "string"),
            "UPC Number": ("upc_number", "string"),
            "Total Qty": ("total_qty", "bigint"),
            "BL Date": ("bl_date", "date"),
        },
    ),
}


def clean_header(df: DataFrame, upper: bool = False, first_column: str | None = None) -> DataFrame:
    """Trim column names, optionally upper-case them and rename the first by position."""
    names = [c.strip().upper() if upper else c.strip() for c in df.columns]
    if first_column is not None:
        names[0] = first_column
    return df.toDF(*names)


def _typed(column: Column, kind: str, thousands: bool, strict: bool = True) -> Column:
    if kind == MONEY:
        return money(column, thousands, strict)
    if kind == "bigint":
        column = F.replace(column.cast("string"), F.lit(","), F.lit("")) if thousands else column
        return whole_number(column, None if strict else False)
    return column.cast(kind) if strict else column.try_cast(kind)


def select_report(df: DataFrame, source: str, thousands: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """The declared columns of a report from a frame with its header names."""
    layout = SOURCES[source]
    clean = clean_header(df.drop(*extra), layout.upper_header, layout.first_column)
    known = {old: new for old, new in zip(df.drop(*extra).columns, clean.columns)}
    wanted = {name: column for column, name in known.items()}
    missing = [name for name in layout.columns if name not in wanted]
    if missing:
        raise ValueError(f"{source}: columns not found: {missing}")
    return df.select(
        *[_typed(F.col(f"`{wanted[name]}`"), kind, thousands).alias(new) for name, (new, kind) in layout.columns.items()],
        *extra,
    )


MAX_COLUMNS = 100
_MANY_FILES = 100_000


def _fields(spark: SparkSession, paths: Sequence[str], width: int, multi_line: bool) -> DataFrame:
    """All lines of CSV files as arrays of text fields, with their file; one field more than ``width``.

    A last column is declared and never read: Spark then picks columns by place, and a short line just
    lacks some.  If all were read, each such line would cost an exception as a malformed one.
    """
    names = [f"c{i}" for i in range(width + 1)]
    lines = (
        spark.read.schema(", ".join(f"{name} string" for name in [*names, "unread"]))
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(list(paths))
    )
    return lines.select(
        F.array(*names).alias("fields"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("at"),
    )


def read_csv(
    spark: SparkSession,
    source: str,
    paths: str | Sequence[str],
    *,
    required: Sequence[str] | None = None,
    thousands: bool = False,
    strict: bool = True,
    multi_line: bool = False,
    width: int = MAX_COLUMNS,
    extra: Sequence[str] = (),
) -> DataFrame:
    """CSV files of one report as one frame, each file's columns found by its own header.

    A header is a line at the start of a file that has all ``required`` names (by default every
    name of the report) among its fields, trimmed and, for some reports, upper-cased.  Columns
    that are not required and that a file lacks are null.  Doubled quotes are read as one;
    line breaks inside quotes need ``multi_line``, which keeps a file from being split.
    A file with a value beyond ``width`` columns raises.  The headers are found at the call and staged.
    """
    rows, column = _rows(spark, source, paths, required, multi_line, width)
    return rows.select(
        *[_typed(column(name), kind, thousands, strict).alias(new) for name, (new, kind) in SOURCES[source].columns.items()],
        *extra,
    )


def _rows(
    spark: SparkSession, source: str, paths: str | Sequence[str], required: Sequence[str] | None, multi_line: bool, width: int
) -> tuple[DataFrame, Callable[[str], Column]]:
    """Data lines with their file's header, and the text of a named column of them."""
    layout = SOURCES[source]
    names = {new: header for header, (new, _) in layout.columns.items()}
    wanted = [names[n] for n in (required or names) if names[n] != layout.first_column]
    lines = _fields(spark, [paths] if isinstance(paths, str) else paths, width, multi_line)
    clean = F.transform("fields", lambda c: F.upper(F.trim(c)) if layout.upper_header else F.trim(c))
    is_header = F.forall(F.array(*map(F.lit, wanted)), lambda name: F.array_contains(clean, name))
    # Few lines hold all names somewhere; only their fields are looked at one by one.
    text = F.concat_ws("\n", "fields")
    text = F.upper(text) if layout.upper_header else text
    likely = functools.reduce(operator.and_, [F.contains(text, F.lit(name)) for name in wanted], F.lit(True))
    lines = lines.withColumn("is_header", F.when(likely, F.coalesce(is_header, F.lit(False))).otherwise(False))
    headers = lines.filter("at = 0 and is_header").select("file", clean.alias("header"))
    headers = headers.withColumn("_line", F.monotonically_increasing_id())
    # Staged, as a broadcast that has to wait for all lines would run into its time limit.
    headers = stage(headers.groupBy("file").agg(F.min_by("header", "_line").alias("header")), "headers")
    if len(lines.inputFiles()) <= _MANY_FILES:  # one short row per file
        headers = F.broadcast(headers)
    rows = lines.filter(~F.col("is_header")).join(headers, "file", "left")
    no_header = F.raise_error(F.concat(F.lit(f"{source}: no header with {wanted} in "), F.col("file"))).cast("array<string>")
    too_wide = F.raise_error(F.concat(F.lit(f"{source}: more than {width} columns in "), F.col("file"))).cast("array<string>")
    beyond = F.get("fields", F.lit(width)).isNotNull() | F.get("header", F.lit(width)).isNotNull()
    rows = rows.withColumn("header", F.when(beyond, too_wide).otherwise(F.coalesce("header", no_header)))

    def column(name: str) -> Column:
        if name == layout.first_column:
            return F.element_at("fields", 1)
        place = F.array_position("header", name)
        return F.when(place > 0, F.get("fields", (place - 1).cast("int")))

    return rows, column


# Reasons why a value is refused.
NOT_A_NUMBER, NOT_A_DATE, MISSING = "not a number", "not a date", "missing"


def read_checked(
    spark: SparkSession,
    source: str,
    paths: str | Sequence[str],
    *,
    required: Sequence[str] | None = None,
    filled: Sequence[str] = (),
    dates: dict[str, Callable[[Column], Column]] | None = None,
    thousands: bool = False,
    multi_line: bool = False,
    width: int = MAX_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    """CSV files as their good lines, and the refused values of the others.

    A line is good if every number and every column named in ``dates`` can be read where it is not
    blank, and no column named in ``filled`` is blank.  ``dates`` gives for a text column what turns it into a date,
    or null if it is none, such as ``lambda c: us_day(c, strict=False)``.  Refused values come as
    ``line_id, file, column, raw, reason``; lines with several have several rows, ``line_id`` tells lines apart.
    The lines are parsed once and staged; both results read what was staged.
    """
    layout, dates = SOURCES[source], dates or {}
    rows, column = _rows(spark, source, paths, required, multi_line, width)
    texts = [column(name).cast("string").alias(new) for name, (new, _) in layout.columns.items()]
    faults = []
    for new, kind in layout.columns.values():
        raw = F.col(new)
        blank = raw.isNull() | (F.trim(raw) == "")
        reason = F.when(blank, F.lit(MISSING)) if new in filled else F.when(blank, F.lit(None).cast("string"))
        if kind != "string":
            reason = reason.when(_typed(raw, kind, thousands, False).isNull(), NOT_A_DATE if kind == "date" else NOT_A_NUMBER)
        elif new in dates:
            reason = reason.when(dates[new](raw).isNull(), NOT_A_DATE)
        elif new not in filled:
            continue
        faults.append(F.struct(F.lit(new).alias("column"), raw.alias("raw"), reason.alias("reason")))
    refused = F.filter(F.array(*faults), lambda f: f["reason"].isNotNull())
    read = rows.select(F.monotonically_increasing_id().alias("line_id"), "file", *texts)
    checked = stage(read.withColumn("refused", refused), source)
    good = checked.where(F.size("refused") == 0).select(
        *[_typed(F.when(F.trim(F.col(new)) != "", F.col(new)), kind, thousands, False).alias(new) if kind != "string" else F.col(new) for new, kind in layout.columns.values()]
    )
    rejects = checked.where(F.size("refused") > 0).select("line_id", "file", F.explode("refused").alias("r")).select("line_id", "file", "r.*")
    return good, rejects


def read_parquet(spark: SparkSession, source: str, paths: str | Sequence[str], thousands: bool = False) -> DataFrame:
    """Parquet files of one report, with the reports' header names."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return select_report(spark.read.parquet(*paths), source, thousands)


def read_bookings(
    spark: SparkSession, paths: str | Sequence[str], *, strict: bool = True, thousands: bool = False, multi_line: bool = False
) -> DataFrame:
    """Booking files named ``YYYY_MM_DD-...``, each dated by its name and read by its own header."""
    files = read_csv(
        spark, "bookings", paths, strict=strict, thousands=thousands, multi_line=multi_line, extra=["file_name"]
    )
    return with_booking_date(files, strict=strict)


def with_booking_date(bookings: DataFrame, file_name: str = "file_name", strict: bool = True) -> DataFrame:
    return bookings.withColumn("booking_date", day_from_file_name(F.col(file_name), strict)).drop(file_name)
