import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.functions import keys as K
from tallymark.functions import values as V
from tallymark.operators.grouping import sum_by


def one(spark, column, **data):
    """Value of a column expression over a one-row frame of text columns."""
    schema = ", ".join(f"{name} string" for name in data) or "x string"
    return spark.createDataFrame([tuple(data.values()) or (None,)], schema).select(column.alias("r")).first().r


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (None, "SKU-Not Available"),
        ("123456789012_New", "SKU-123456789012"),
        ("123456789012_NEW", "SKU-123456789012"),
        ("amzn.gr.123456789012-extra", "SKU-123456789012"),
        ("1234567890123", "SKU-1234567890123"),
        ("12345678901234", "SKU-901234"),
        ("A_New_NEW_New", "SKU-A"),
        ("", "SKU-"),
    ],
)
def test_normalize_sku(spark, raw, expected):
    assert one(spark, K.normalize_sku(F.col("c")), c=raw) == expected
    assert one(spark, K.normalize_sku(F.col("c"), prefix=""), c=raw) == expected.removeprefix("SKU-")


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("amzn.gr.123456789012xyz", "SKU-123456789012"),
        ("123456789012_New", "SKU-123456789012"),
        ("short", "SKU-short"),
        (None, "SKU-nan"),
    ],
)
def test_normalize_ledger_sku(spark, raw, expected):
    assert one(spark, K.normalize_ledger_sku(F.col("c")), c=raw) == expected


def test_identifier_helpers(spark):
    assert one(spark, K.without_decimal_suffix(F.col("c")), c="123.0") == "123"
    assert one(spark, K.without_decimal_suffix(F.col("c")), c="12.05") == "12.05"
    assert one(spark, K.without_decimal_suffix(F.col("c")), c="1.0.0") == "1.0"
    assert one(spark, K.is_shipment_id(F.col("c")), c="FBA123456789")
    assert not one(spark, K.is_shipment_id(F.col("c")), c="FBA12345678")
    assert one(spark, K.dispatch_file_name(F.col("c")), c="FBA1") == "FBA1_ViewTransaction.xlsx"


def test_missing_text_becomes_a_token(spark):
    assert one(spark, V.text_or(F.col("c")), c=None) == "nan"
    assert one(spark, V.text_or(F.col("c"), "?"), c=None) == "?"


def test_division_by_zero_adds_nothing(spark):
    df = spark.createDataFrame([("a", 10, 0, 2), ("a", 10, 4, 2)], "k string, amount int, over int, share int")
    result = sum_by(df, ["k"], r=V.prorated(F.col("amount"), F.col("over"), F.col("share"))).first().r
    assert result == Decimal("5.000000")


def test_money(spark):
    assert one(spark, V.money(F.col("c")), c="-12.5") == Decimal("-12.50")
    assert one(spark, V.money(F.col("c"), thousands=True), c="1,234.50") == Decimal("1234.50")
    assert one(spark, V.money(F.col("c"), strict=False), c="1,234.50") is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, V.money(F.col("c")), c="1,234.50")


def test_whole_number(spark):
    assert one(spark, V.whole_number(F.col("c")), c="12.0") == 12
    assert one(spark, V.whole_number(F.col("c")), c="12.9") == 12
    assert one(spark, V.whole_number(F.lit(3.7))) == 3


def test_dates(spark):
    expected = datetime.date(2022, 4, 9)
    assert one(spark, V.iso_day(F.col("c")), c="2022-04-09T10:11:12+00:00") == expected
    assert one(spark, V.us_day(F.col("c")), c="04/09/2022") == expected
    assert one(spark, V.us_day(F.col("c")), c="4/9/2022") == expected
    assert one(spark, V.day_from_file_name(F.col("c")), c="2022_04_09-second batch.csv") == expected
    assert one(spark, V.day_text(F.lit(expected), "MM/dd/yyyy")) == "04/09/2022"
    assert one(spark, V.day_text(F.lit(None).cast("date"), "MM/dd/yyyy", "-")) == "-"


def test_bad_dates_raise_or_become_null(spark):
    for parse, text in ((V.iso_day, "soon"), (V.us_day, "2022-04-09"), (V.day_from_file_name, "batch.csv")):
        assert one(spark, parse(F.col("c"), strict=False), c=text) is None
        with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
            one(spark, parse(F.col("c")), c=text)


def test_null_keys_drop_out_and_empty_sums_are_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 5), ("b", 2)], "k string, v int")
    assert {tuple(r) for r in sum_by(df, ["k"], v="v").collect()} == {("a", 0), ("b", 2)}


def test_sums_by_sign(spark):
    df = spark.createDataFrame([(3,), (-2,), (None,), (-5,), (0,)], "v int")
    row = df.agg(V.sum_of_positives(F.col("v")).alias("p"), V.sum_of_negatives(F.col("v")).alias("n")).first()
    assert (row.p, row.n) == (3, 7)
    row = df.filter("v = 0").agg(V.sum_of_positives(F.col("v")).alias("p"), V.sum_of_negatives(F.col("v")).alias("n")).first()
    assert (row.p, row.n) == (0, 0)
