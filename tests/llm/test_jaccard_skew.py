"""Jaccard join with one root that most nodes share, and with columns named like its helpers."""

import random

import numpy as np
import pytest

from tallymark.llm import jaccard_join
from tallymark.llm.shipping import ship
from tests.llm.test_operators import component_ids


def shared_passage(g, passage, n):
    """Texts that share a passage of most of their words and differ in the rest."""
    return [" ".join([*passage, *(f"w{g.randint(0, 10**6)}" for _ in range(g.choice([4, 9, 14, 30])))]) for _ in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"cell_points": 3, "bucket_entries": 200, "unit_rows": 5}])
def test_a_root_that_most_nodes_share(spark, sizes):
    ship(spark)
    g = random.Random(8)
    passage = [f"p{k}" for k in range(40)]
    texts = shared_passage(g, passage, 60) + [" ".join(passage)] * 5 + [" ".join(passage[:-2]), " ".join(passage[3:])]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(table, **sizes).collect()}
    assert found == component_ids(texts)


def test_searches_make_few_pairs(spark):
    """Copies with scattered changes: no search links more than a few pairs a node."""
    ship(spark)
    g = random.Random(2)
    base = [f"t{k}" for k in range(200)]
    texts = []
    for _ in range(300):
        some = list(base)
        for _ in range(3):
            some[g.randrange(200)] = f"z{g.randint(0, 10**6)}"
        texts.append(" ".join(some))
    made = []
    search = jaccard_join._links

    def counted(points, filed, percent, nearest, *rest):
        links = search(points, filed, percent, nearest, *rest)
        made.append((nearest, links.count(), points.count()))
        return links

    jaccard_join._links = counted
    try:
        table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(table).collect()}
    finally:
        jaccard_join._links = search
    assert found == component_ids(texts)
    nodes = made[0][2]
    assert all(links <= 3 * nodes for _, links, _ in made)
    assert [nearest for nearest, _, _ in made][-1] is False


def test_columns_named_like_helpers_stay(spark):
    ship(spark)
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text, "mine", 5, "a", 2), (2, text, "mine too", 6, "b", 3), (3, "few words", None, 7, "c", 4), (3, "few words", None, 7, "c", 4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _key string, _turn int, key string, turn int")
    kept = jaccard_join.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_wide_and_narrow_points_mix():
    narrow, wide = np.arange(jaccard_join.GROUPS, dtype=np.uint16), np.full(jaccard_join.GROUPS, 70_000, dtype=np.int32)
    found = jaccard_join._counts([narrow.tobytes(), wide.tobytes()])
    assert (found[0] == narrow).all() and (found[1] == wide).all()
    assert (jaccard_join._counts([narrow.tobytes()])[0] == narrow).all()
