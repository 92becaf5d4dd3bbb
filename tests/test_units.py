from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.operators.grouping import with_copies
from tallymark.operators.units import MAX_RUNS, explode_units, negative_quantities, non_negative, repeat_rows, split_runs


def test_runs_cover_every_unit_once(spark):
    quantities = [0, 1, 2, 7, 8, 9, 1000]
    df = spark.createDataFrame([(i, q) for i, q in enumerate(quantities)], "id int, q bigint")
    runs = split_runs(df, "q", run_size=4).collect()
    for i, quantity in enumerate(quantities):
        covered = [u for r in runs if r.id == i for u in range(r.first_unit, r.first_unit + r.units)]
        assert sorted(covered) == list(range(quantity))


def test_runs_of_a_huge_row_stay_bounded(spark):
    huge = 10**12
    df = spark.createDataFrame([(huge,)], "q bigint")
    facts = split_runs(df, "q").agg(F.count("*").alias("runs"), F.sum("units").alias("units")).first()
    assert facts.units == huge
    assert facts.runs <= MAX_RUNS


def test_fractions_are_cut_off(spark):
    df = spark.createDataFrame([(2.9,), (0.5,)], "q double")
    assert [r.units for r in split_runs(df, "q").collect()] == [2]


def test_units_are_numbered_within_their_key(spark):
    lines = [("a", 2), ("a", 1), ("b", 0), ("c", 300), (None, 4)]
    df = spark.createDataFrame(lines, "k string, q int")
    found = Counter((r.k, r.unit_no) for r in explode_units(df, ["k"], "q").collect())
    assert found == Counter([("a", i) for i in (1, 2, 3)] + [("c", i) for i in range(1, 301)])


def test_negative_quantities_raise_or_are_set_aside(spark):
    df = spark.createDataFrame([("a", -3), ("b", 2), ("c", None)], "k string, q int")
    for units in (split_runs(df, "q"), explode_units(df, ["k"], "q")):
        with pytest.raises(Exception, match="negative q: -3"):
            units.collect()
    assert [tuple(r) for r in negative_quantities(df, "q").collect()] == [("a", -3)]
    assert [r.k for r in split_runs(non_negative(df, "q"), "q").collect()] == ["b"]


def test_copies_are_restored(spark):
    rows = [("a", 1)] * 3 + [("a", None)] * 2 + [("b", 1)] * 700
    df = spark.createDataFrame(rows, "k string, v int")
    packed = with_copies(df)
    assert packed.count() == 3
    assert Counter(map(tuple, repeat_rows(packed, "copies", ["k", "v"]).collect())) == Counter(rows)
