"""Nearest-date matching against a greedy loop over all pairs."""

import datetime
import random
from collections import Counter

import pytest

from tallymark.operators.matching import daily_matches, daily_units, match_nearest
from tallymark.operators.staging import stage

DAY0 = datetime.date(2022, 1, 1)
LEFT = "block string, centre string, day date, name string, units bigint"
RIGHT = "block string, centre string, day date, quantity bigint"


def day(number):
    return DAY0 + datetime.timedelta(days=number)


def greedy(left, right):
    """Smallest gap first, then smallest left id; one row per left unit."""
    outcome = []
    for block in {(r[0], r[1]) for r in left}:
        units = []
        for row in sorted((r for r in left if r[:2] == block), key=lambda r: (r[3], r[2])):
            units += [row] * row[4]
        stock = [r[2] for r in right if r[:2] == block for _ in range(max(r[3], 0))]
        pairs = sorted(
            ((s - u[2]).days, i, j) for i, u in enumerate(units) for j, s in enumerate(stock) if s >= u[2]
        )
        taken, used = {}, set()
        for _, i, j in pairs:
            if i not in taken and j not in used:
                taken[i] = j
                used.add(j)
        outcome += [(*u[:4], stock[taken[i]] if i in taken else None) for i, u in enumerate(units)]
    return Counter(outcome)


def random_case(seed, days=8, lines=14, most=4):
    generator = random.Random(seed)
    blocks = [("a", "x"), ("a", "y"), ("b", "x")][: generator.randint(1, 3)]
    left = [
        (*generator.choice(blocks), day(generator.randrange(days)), f"n{i:03}", generator.randint(1, most))
        for i in range(generator.randint(1, lines))
    ]
    right = [
        (*generator.choice(blocks), day(generator.randrange(days)), generator.randint(0, most))
        for _ in range(generator.randint(0, lines))
    ]
    return left, right


def run(spark, left, right, **limits):
    runs = stage(spark.createDataFrame(left, LEFT))
    stock = daily_units(spark.createDataFrame(right, RIGHT), ["block", "centre"], "day", "quantity")
    matched = match_nearest(runs, stock, block=["block", "centre"], left_date="day", order=["name"], **limits)
    found = Counter()
    for row in matched.collect():
        gap = None if row.right_date is None else (row.right_date - row.day).days
        assert row.gap_days == gap
        found[(row.block, row.centre, row.day, row["name"], row.right_date)] += row.units
    return found


def many_cases(count, first_seed, **shape):
    """Independent random cases side by side, told apart by their block."""
    left, right = [], []
    for i in range(count):
        some_left, some_right = random_case(first_seed + i, **shape)
        left += [(f"{i}{b}", c, d, f"{i}-{n}", u) for b, c, d, n, u in some_left]
        right += [(f"{i}{b}", c, d, q) for b, c, d, q in some_right]
    return left, right


@pytest.mark.parametrize("shape", [{}, {"days": 3, "lines": 25}, {"days": 30, "lines": 30, "most": 9}])
def test_equals_greedy_choice(spark, shape):
    left, right = many_cases(150, 1000, **shape)
    assert run(spark, left, right) == greedy(left, right)


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_days_cut_by_partitions(spark, partitions):
    left, right = many_cases(40, 5000, days=2, lines=30, most=3)
    assert run(spark, left, right, partitions=partitions) == greedy(left, right)


def test_one_block_and_day_with_most_rows(spark):
    left = [("hot", "x", day(0), f"n{i:05}", 1 + i % 3) for i in range(600)] + [("cold", "x", day(i), "n", 2) for i in range(9)]
    right = [("hot", "x", day(i % 40), 1 + i % 7) for i in range(200)] + [("cold", "x", day(5), 4)]
    expected = greedy(left, right)
    assert run(spark, left, right) == expected
    assert run(spark, left, right, partitions=3) == expected
    assert run(spark, left, right, partitions=50) == expected


def test_ranges_grow_with_days_not_with_their_square(spark):
    days = 1000
    left = spark.createDataFrame([("a", "x", day(2 * i), "n", 100_000) for i in range(days)], LEFT)
    right = spark.createDataFrame([("a", "x", day(2 * i + 1), 99_999) for i in range(days)], RIGHT)
    block = ["block", "centre"]
    found = daily_matches(daily_units(left, block, "day", "units"), daily_units(right, block, "day", "quantity"), block)
    assert found.count() <= 3 * days


def test_each_right_unit_is_used_at_most_once(spark):
    left, right = many_cases(30, 9000)
    stock = Counter()
    for block, centre, date, quantity in right:
        stock[(block, centre, date)] += quantity
    used = Counter()
    for (block, centre, _, _, right_day), units in run(spark, left, right).items():
        if right_day is not None:
            used[(block, centre, right_day)] += units
    assert all(used[key] <= stock[key] for key in used)


def test_no_right_side(spark):
    left, _ = random_case(1)
    assert run(spark, left, []) == greedy(left, [])


def test_rows_without_a_date_stay_unmatched(spark):
    left = [("a", "x", None, "n1", 2), ("a", "x", day(0), "n2", 1)]
    found = run(spark, left, [("a", "x", day(1), 5)])
    assert found == Counter({("a", "x", None, "n1", None): 2, ("a", "x", day(0), "n2", day(1)): 1})
