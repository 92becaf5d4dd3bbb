"""Form-like sheets as a long table of cells: ``file, row, col, value``.

A sheet holds a few labelled cells and a table that starts at a header row.  Both
are found by grouping and joining on the file, so a sheet of any size is spread over
tasks.  ``col`` is the letter of the column, ``value`` the text of the cell.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.values import iso_day, whole_number

# Labels, cells and headers of the two forms.
PACKING_LABEL_COLUMN = "B"
PACKING_HEADER_LABEL = "Carton From"
PACKING_DATE_LABEL = "BL/FCR/AWB DATE"
PACKING_DATE_COLUMN = "C"
PACKING_COLUMNS = ("B", "M")
PACKING_HEADERS = {"FBA Id /  Carton Id": "carton_id", "UPC Number": "upc_number", "Total Qty": "total_qty"}
DISPATCH_ID_CELL = ("R", 9)
DISPATCH_DATE_CELL = ("AD", 4)
DISPATCH_HEADER_ROW = 46
DISPATCH_COLUMNS = ("C", "AS")
DISPATCH_HEADERS = {"SKU": "sku", "INV QTY": "inv_qty"}


def column_number(letters: Column) -> Column:
    """Position of a spreadsheet column of up to three letters: A is 1, AA is 27."""
    size = F.length(letters)
    value = [F.ascii(F.substring(letters, i, 1)) - F.lit(64) for i in (1, 2, 3)]
    return (
        F.when(size == 1, value[0])
        .when(size == 2, value[0] * 26 + value[1])
        .otherwise(value[0] * 676 + value[1] * 26 + value[2])
    )


def labelled_row(cells: DataFrame, column: str, label: str, name: str) -> DataFrame:
    """Row of a label in a column, per file; the last one if it occurs again."""
    hits = cells.filter((F.col("col") == column) & (F.col("value") == label))
    return hits.groupBy("file").agg(F.max("row").alias(name))


def value_beside(cells: DataFrame, label_column: str, label: str, value_column: str, name: str) -> DataFrame:
    """Value in another column of a label's row, per file."""
    at = labelled_row(cells, label_column, label, "row")
    beside = cells.filter(F.col("col") == value_column)
    return at.join(beside, ["file", "row"], "left").select("file", F.col("value").alias(name))


def fixed_cells(cells: DataFrame, wanted: dict[str, tuple[str, int]]) -> DataFrame:
    """Values of cells at known places, one row per file."""
    places = {name: (F.col("col") == col) & (F.col("row") == row) for name, (col, row) in wanted.items()}
    any_place = reduce(lambda a, b: a | b, places.values())
    return cells.filter(any_place).groupBy("file").agg(
        *[F.max(F.when(place, F.col("value"))).alias(name) for name, place in places.items()]
    )


def table_below(
    cells: DataFrame,
    header_rows: DataFrame | int,
    headers: dict[str, str],
    columns: tuple[str, str],
    upper: bool = False,
) -> DataFrame:
    """The rows below each file's header row, with the wanted columns found by header.

    ``header_rows`` has ``file`` and ``header_row``, or is one row for all files.
    """
    first, last = (column_number(F.lit(c)) for c in columns)
    number = column_number(F.col("col"))
    inside = cells.filter((number >= first) & (number <= last) & F.col("value").isNotNull())
    title = F.trim("value")
    title = F.upper(title) if upper else title
    if isinstance(header_rows, int):
        placed = inside.withColumn("header_row", F.lit(header_rows))
    else:
        placed = inside.join(header_rows, "file")
    titles = (
        placed.filter(F.col("row") == F.col("header_row"))
        .select("file", "col", title.alias("title"))
        .filter(F.col("title").isin(*headers))
    )
    body = placed.filter(F.col("row") > F.col("header_row")).join(titles, ["file", "col"])
    return body.groupBy("file", "row").agg(
        *[F.max(F.when(F.col("title") == text, F.col("value"))).alias(name) for text, name in headers.items()]
    )


def packing_from_cells(cells: DataFrame, strict: bool = True) -> DataFrame:
    """Packing lines with the loading date of their sheet."""
    headers = labelled_row(cells, PACKING_LABEL_COLUMN, PACKING_HEADER_LABEL, "header_row")
    dates = value_beside(cells, PACKING_LABEL_COLUMN, PACKING_DATE_LABEL, PACKING_DATE_COLUMN, "bl_date_text")
    lines = table_below(cells, headers, PACKING_HEADERS, PACKING_COLUMNS)
    return lines.filter(F.col("carton_id").isNotNull()).join(dates, "file", "left").select(
        "file",
        "carton_id",
        "upc_number",
        whole_number(F.col("total_qty"), None if strict else False).alias("total_qty"),
        iso_day(F.col("bl_date_text"), strict).alias("bl_date"),
    )


def dispatches_from_cells(cells: DataFrame, strict: bool = True) -> DataFrame:
    """Dispatch lines with the shipment id and date written on their sheet."""
    heads = fixed_cells(cells, {"fba_id": DISPATCH_ID_CELL, "dispatch_date_text": DISPATCH_DATE_CELL})
    lines = table_below(cells, DISPATCH_HEADER_ROW, DISPATCH_HEADERS, DISPATCH_COLUMNS, upper=True)
    return lines.filter(F.col("sku").isNotNull()).join(heads, "file", "left").select(
        F.col("file").alias("file_name"),
        "fba_id",
        iso_day(F.col("dispatch_date_text"), strict).alias("dispatch_date"),
        "sku",
        whole_number(F.col("inv_qty"), None if strict else False).alias("inv_qty"),
    )
