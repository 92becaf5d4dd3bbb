"""Report inputs derived from ``lineitem``.

The same SQL serves both engines: as Spark DataFrames here, and as the opening common
table expressions of every SQL counterpart.
"""

from __future__ import annotations

import textwrap

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS: dict[str, str] = {
    "fx_base": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus,
          cast(l_quantity as int) as q, cast(l_extendedprice as decimal(18,2)) as price,
          cast(l_shipdate as date) as d,
          'O-' || cast(l_orderkey as string) as order_id,
          'FBA' || lpad(cast(l_orderkey as string), 9, '0') as fba_id,
          lpad(cast(l_partkey % 40 as string), 12, '0') as base_sku,
          case when l_linenumber % 3 = 0 then 'amzn.gr.' || lpad(cast(l_partkey % 40 as string), 12, '0')
               when l_linenumber % 3 = 1 then lpad(cast(l_partkey % 40 as string), 12, '0') || '_New'
               else lpad(cast(l_partkey % 40 as string), 12, '0') end as raw_sku,
          'FC' || cast(l_suppkey % 10 as string) as fc,
          1 + cast(l_quantity as int) % 5 as u,
          case l_linenumber % 4 when 0 then 'Reimbursed' when 1 then 'Unit returned to inventory'
               when 2 then 'Repackaged Successfully' else 'Damaged' end as st
        from lineitem""",
    "fx_payments": """
        select cast(d as string) as posted, 'Refund' as type, order_id,
          case when l_suppkey % 37 = 0 then null else raw_sku end as sku,
          'Order refund' as description, u as quantity, -price as total
        from fx_base where l_returnflag = 'R'
        union all
        select cast(d as string), 'Adjustment', order_id, raw_sku,
          'FBA Inventory Reimbursement - Customer Return', u, cast(price * 0.9 as decimal(18,2))
        from fx_base where l_returnflag = 'R' and st = 'Reimbursed' and l_suppkey % 5 <> 0""",
    "fx_returns": """
        select order_id, raw_sku as sku, st as status, greatest(1, u - l_linenumber % 2) as quantity,
          cast(d + 3 as string) as return_date,
          case when l_suppkey % 41 = 0 then null else fc end as fulfillment_center_id
        from fx_base where l_returnflag = 'R' and l_linenumber <> 7""",
    "fx_reimbursements": """
        select case when l_suppkey % 11 = 0 then 'Lost_Warehouse' else 'CustomerReturn' end as reason,
          cast(d + 5 as string) as approval_date, order_id as amazon_order_id, raw_sku as sku,
          cast(price * 0.9 as decimal(18,2)) as amount_total,
          case when l_partkey % 2 = 0 then u else 0 end as quantity_reimbursed_cash,
          case when l_partkey % 2 = 0 then 0 else u end as quantity_reimbursed_inventory,
          u as quantity_reimbursed_total
        from fx_base where l_returnflag = 'R' and st = 'Reimbursed' and l_suppkey % 7 <> 0""",
    "fx_ledger": """
        select substr(cast(d + 6 as string), 6, 2) || '/' || substr(cast(d + 6 as string), 9, 2) || '/'
            || substr(cast(d + 6 as string), 1, 4) as date_text,
          case when l_linenumber % 2 = 0 then 'amzn.gr.' || base_sku else base_sku end as msku,
          1 + q % 3 as quantity, fc as fulfillment_center, 'CustomerReturns' as event_type,
          case when l_linestatus = 'O' then 'SELLABLE' else 'DEFECTIVE' end as disposition,
          cast(null as string) as reference_id
        from fx_base where l_returnflag = 'A'
        union all
        select substr(cast(d + 9 as string), 6, 2) || '/' || substr(cast(d + 9 as string), 9, 2) || '/'
            || substr(cast(d + 9 as string), 1, 4),
          base_sku, case when l_linenumber = 3 then q + 1 else greatest(q - l_suppkey % 3, 0) end, fc,
          'Receipts', 'SELLABLE', fba_id
        from fx_base where l_returnflag = 'N' and l_linenumber <> 5""",
    "fx_bookings": """
        select fba_id, base_sku || case when l_linenumber % 2 = 0 then '_NEW' else '' end as sku,
          1 + q % 10 as cartons, q as qty, d as booking_date
        from fx_base where l_returnflag = 'N'""",
    "fx_dispatches": """
        select fba_id, d + 2 as dispatch_date, base_sku || '.0' as sku,
          greatest(1 + q % 10 - case when l_suppkey % 4 = 0 then 1 else 0 end, 0) as inv_qty
        from fx_base where l_returnflag = 'N' and l_linenumber <> 6""",
    "fx_packing": """
        select fba_id || 'U' || lpad(cast(l_linenumber as string), 6, '0') as carton_id,
          base_sku as upc_number, q as total_qty, d as bl_date
        from fx_base where l_returnflag = 'N'""",
}


LINEITEM = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
    l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"""


def common_tables(*names: str) -> str:
    """The named views as common table expressions, after ``fx_base``."""
    wanted = dict.fromkeys(("fx_base", *names))
    return ",\n".join(f"{name} as ({textwrap.dedent(VIEWS[name])})" for name in wanted)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived view as a Spark DataFrame."""
    lineitem = spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    text = common_tables(name).replace("from lineitem", "from {lineitem}")
    return spark.sql(f"with {text} select * from {name}", lineitem=lineitem)


def _cells(df: DataFrame, cells: list[tuple[Column | int, str, Column | str]]) -> DataFrame:
    """Several cells per row: ``(row, column letter, value)`` in the row's ``file``."""
    made = [
        F.struct(
            (F.lit(row) if isinstance(row, int) else row).cast("bigint").alias("row"),
            F.lit(col).alias("col"),
            (F.lit(value) if isinstance(value, str) else value).cast("string").alias("value"),
        )
        for row, col, value in cells
    ]
    return df.select("file", F.explode(F.array(*made)).alias("cell")).select("file", "cell.*")


def packing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing sheets, one per shipment, SKU and loading date, as cells."""
    base = frame(spark, sf_dir, "fx_base").filter(F.col("l_returnflag") == "N")
    name = F.concat_ws("-", "fba_id", "base_sku", F.col("d").cast("string"))
    lines = base.groupBy("fba_id", "base_sku", "d", "l_linenumber").agg(F.sum("q").alias("qty")).withColumn("file", name)
    row = F.col("l_linenumber") + 12
    carton = F.concat("fba_id", F.lit("U"), F.lpad(F.col("l_linenumber").cast("string"), 6, "0"))
    body = _cells(
        lines,
        [(row, "B", F.col("l_linenumber")), (row, "D", carton), (row, "F", F.col("base_sku")), (row, "K", F.col("qty")), (row, "P", "999")],
    )
    head = _cells(
        lines.select("file", "d").distinct(),
        [
            (3, "B", "BL/FCR/AWB DATE"),
            (3, "C", F.col("d")),
            (12, "B", "Carton From"),
            (12, "D", "FBA Id /  Carton Id"),
            (12, "F", "UPC Number"),
            (12, "K", "Total Qty"),
            (12, "P", "Total Qty"),
            (40, "B", "SUB TOTAL"),
            (40, "K", "12345"),
        ],
    )
    return body.unionByName(head)


def dispatch_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch sheets, one per shipment, as cells."""
    base = (
        frame(spark, sf_dir, "fx_base")
        .filter((F.col("l_returnflag") == "N") & (F.col("l_linenumber") != 6))
        .withColumn("file", F.concat("fba_id", F.lit("_ViewTransaction.xlsx")))
        .withColumn("row", 46 + 100 * F.col("l_linenumber") + F.col("l_partkey") % 40)
    )
    lines = base.groupBy("file", "row", "base_sku").agg(F.sum(1 + F.col("q") % 10).alias("qty"))
    body = _cells(
        lines, [(F.col("row"), "E", F.concat("base_sku", F.lit(".0"))), (F.col("row"), "AB", F.col("qty"))]
    )
    head = _cells(
        base.groupBy("file", "fba_id").agg(F.date_add(F.min("d"), 2).alias("day")),
        [
            (9, "R", F.col("fba_id")),
            (4, "AD", F.concat(F.col("day").cast("string"), F.lit(" 00:00:00"))),
            (46, "E", "Sku "),
            (46, "AB", " Inv Qty"),
        ],
    )
    return body.unionByName(head)
