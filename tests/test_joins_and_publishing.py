"""Splittable outer join, report sets that appear whole, refused values, wide files."""

import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymark.functions.values import us_day
from tallymark.operators.joins import outer_join
from tallymark.plans import shipments as sh
from tallymark.sources.reports import MISSING, NOT_A_DATE, NOT_A_NUMBER, read_checked, read_csv
from tallymark.sources.sheets import packing_from_cells
from tallymark.sources.sinks import write_reports

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def skew(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(4))
def test_outer_join(spark, seed):
    g = random.Random(seed)

    def side():
        return [(g.choice([None, "a", "b", "c", "d"]), g.choice([None, 1, 2]), g.randint(0, 3)) for _ in range(g.choice([0, 1, 25]))]

    left = spark.createDataFrame(side(), "k string, n int, x int")
    right = spark.createDataFrame(side(), "k string, n int, y int")
    found = outer_join(left, right, ["k", "n"])
    plain = left.join(right, ["k", "n"], "full_outer")
    assert found.columns == plain.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def detail_of_hot_key(spark):
    """Half of all booking lines, and of all receipt lines in turn, have one key."""
    lines = spark.range(4000)
    ids = F.concat(F.lit("FBA"), F.lpad(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).cast("string"), 9, "0"))
    bookings = lines.select(ids.alias("fba_id"), F.lit("s").alias("sku"), (F.col("id") % 2000).alias("cartons"), F.col("id").alias("qty"), F.expr("date'2022-01-01'").alias("booking_date"))
    few = lines.where("id < 40")
    dispatches = few.select(ids.alias("fba_id"), F.expr("date'2022-01-02'").alias("dispatch_date"), F.lit("s").alias("sku"), F.lit(1).cast("bigint").alias("inv_qty"))
    received = few.where("id % 2 = 1 or id = 0").select(ids.alias("fba_id"), F.lit("s").alias("sku"), F.expr("date'2022-01-03'").alias("receipt_date"), F.col("id").alias("quantity"))
    return bookings, dispatches, received


def test_hot_key_of_the_detail_is_split(spark, skew):
    detail = sh.shipment_detail(*detail_of_hot_key(spark))
    rows = detail.collect()
    plan = detail._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan
    assert "SortMergeJoin(skew=true)" in plan
    # each booking line once or, of the hot key, 20 times (equal dispatch lines are copies)
    assert len(rows) == 2000 * 20 + 2000
    assert sum(r["units_booked"] for r in rows if r["fba_id"] == "FBA000000000") == 20 * sum(range(0, 4000, 2))


def reports_of(spark, bad):
    good = spark.range(3).select(F.lit("f").alias("fba_id"), F.col("id").cast("string").alias("sku_id"), "id")
    first = good.select("fba_id", "sku_id", F.col("id").alias("qty_packing_list"), F.col("id").alias("qty_inv_ledger"), F.lit(0).alias("excess_short_received"))
    kpis = ("units_booked", "excess_units_received", "short_units_received", "units_received", "matching_skus", "mismatching_skus")
    second = spark.range(1).select(*[F.col("id").alias(c) for c in kpis])
    names = ("fba_id", "sku", "cartons_booked", "cartons_dispatched", "cartons_short_dispatched", "units_booked", "units_received", "units_short_received")
    value = F.when(F.lit(bad), F.raise_error(F.lit("bad line")).cast("bigint")).otherwise(F.col("id"))
    third = spark.range(2).select(*[(value if c == "units_booked" else F.col("id")).alias(c) for c in names])
    return {"packing_vs_receipts": first, "shipment_kpis": second, "shipment_by_sku": third}


def test_a_set_appears_whole_or_not_at_all(spark, tmp_path):
    folder = tmp_path / "out"
    with pytest.raises(PySparkException):
        write_reports(reports_of(spark, True), str(folder))
    assert not folder.exists() or not list(folder.iterdir())
    written = write_reports(reports_of(spark, False), str(folder))
    assert set(written) == {"packing_vs_receipts", "shipment_kpis", "shipment_by_sku", "shipment_by_sku_totals"}
    assert sorted(p.name for p in folder.iterdir()) == sorted(written)
    assert spark.read.parquet(written["shipment_by_sku_totals"]).first()["UNITS BOOKED"] == 1


def test_a_taken_place_stops_the_set(spark, tmp_path):
    folder = tmp_path / "out"
    reports = reports_of(spark, False)
    write_reports({"shipment_kpis": reports["shipment_kpis"]}, str(folder))
    with pytest.raises(FileExistsError, match="shipment_kpis"):
        write_reports(reports, str(folder))
    assert [p.name for p in folder.iterdir()] == ["shipment_kpis"]
    written = write_reports(reports, str(folder), mode="overwrite")
    assert all(spark.read.parquet(p).count() for p in written.values())
    with pytest.raises(ValueError):
        write_reports(reports, str(folder), mode="append")


LEDGER = "Date,MSKU,Quantity,Fulfillment Center,Event Type,Disposition,Reference ID"


def test_refused_values(spark, tmp_path):
    lines = [LEDGER, '01/05/2022,a,"1,200",x,Receipts,S,f', "13/05/2022,b,many,x,Receipts,S,f", "01/06/2022,c,,x,Receipts,S,f", ",d,4,x,Receipts,S,f"]
    (tmp_path / "l.csv").write_text("\n".join(lines) + "\n")
    good, rejects = read_checked(
        spark, "ledger", str(tmp_path / "l.csv"), filled=["quantity"], thousands=True, dates={"date_text": lambda c: us_day(c, strict=False)}
    )
    assert [(r.msku, r.quantity, r.date_text) for r in good.orderBy("msku").collect()] == [("a", 1200, "01/05/2022"), ("d", 4, None)]
    found = rejects.collect()
    assert {(r["column"], r.raw, r.reason) for r in found} == {
        ("date_text", "13/05/2022", NOT_A_DATE), ("quantity", "many", NOT_A_NUMBER), ("quantity", None, MISSING),
    }
    assert good.count() + len({r.line_id for r in found}) == len(lines) - 1
    assert all(r.file.endswith("l.csv") for r in found)


def test_a_file_with_too_many_columns_raises(spark, tmp_path):
    wide = ",".join(f"h{i}" for i in range(104))
    (tmp_path / "l.csv").write_text(f"{wide},{LEDGER}\n" + ",".join(["v"] * 104) + ",01/05/2022,a,1,x,Receipts,S,f\n")
    with pytest.raises(PySparkException, match="columns"):
        read_csv(spark, "ledger", str(tmp_path / "l.csv")).collect()
    assert read_csv(spark, "ledger", str(tmp_path / "l.csv"), width=111).first()["msku"] == "a"


def test_lenient_packing_sheet(spark):
    cells = [
        ("p", 1, "B", "BL/FCR/AWB DATE"), ("p", 1, "C", "soon"), ("p", 3, "B", "Carton From"), ("p", 3, "C", "FBA Id /  Carton Id"),
        ("p", 3, "D", "UPC Number"), ("p", 3, "E", "Total Qty"), ("p", 4, "C", "FBA000000001U1"), ("p", 4, "D", "1"), ("p", 4, "E", "six"),
    ]
    table = spark.createDataFrame(cells, "file string, row bigint, col string, value string")
    row = packing_from_cells(table, strict=False).first()
    assert (row.total_qty, row.bl_date) == (None, None)
    with pytest.raises(PySparkException):
        packing_from_cells(table).collect()
