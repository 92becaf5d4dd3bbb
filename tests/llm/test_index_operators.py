"""Manifest, spelling variants and exact search on small tables with odd cases, against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.llm import maxscore, merkle, spelling
from tallymark.llm.shipping import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, rank int, node long, word string"
VECTORS = "vec_id long, embedding array<float>, row int, part string, known int, score double"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# manifest -------------------------------------------------------------------------------------------------------------


def leaf_of(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def reduced(nodes, fanout):
    """Levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i : i + fanout]) for i in range(0, len(now), fanout)])
    return levels


def siblings(levels, i, fanout):
    out = []
    for nodes in levels[:-1]:
        first = i // fanout * fanout
        run = nodes[first : first + fanout]
        out.append((i - first, [x for k, x in enumerate(run) if k != i - first]))
        i //= fanout
    return out


def expected_manifest(rows, fanout):
    rows = [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in rows]
    for r in rows:
        r["leaf"] = leaf_of(r, r["text"])
        marked = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        r["now"] = leaf_of(r, lower(r["text"]) if marked and r["text"] is not None else r["text"])
    names = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = [r for r in rows if r["source"] == name]
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"], r["now"]))
        trees.append((own, reduced([r["leaf"] for r in own], fanout)))
    top = reduced([levels[-1][0] for _, levels in trees], fanout)
    root, out = top[-1][0], []
    for k, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            path = siblings(levels, i, fanout) + siblings(top, k, fanout)
            folded = r["now"]
            for place, others in path:
                folded = h(*others[:place], folded, *others[place:])
            proof = h(*(x for _, others in path for x in others))
            out.append((r["doc_id"], r["leaf"], levels[-1][0], root, proof, folded, folded == root))
    return Counter(out)


@pytest.mark.parametrize("levels,fanout", [(4, 16), (2, 2), (3, 2), (2, 16), (5, 3)])
def test_manifest(spark, levels, fanout):
    ship(spark)
    g = random.Random(levels * 100 + fanout)
    rows = [(i, f"Text {i} É", g.choice(["en", None]), g.choice(["hot", "hot", "hot", "a", "é", None, "Z"]), i) for i in range(150)]
    rows += [(i, None, None, "hot", None) for i in (5, 10)] + [(None, "X", "en", "hot", 1), (None, "X", "en", None, 1), (11, "", "en", "lone", 0)]
    rows += rows[3:6] + [(1000, "Word " * 50_000, "en", "hot", 2)]
    docs = spark.createDataFrame([(*r, "mine", 1, 2, "w") for r in rows], DOCS).repartition(5)
    marked = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(docs, marked, levels, fanout)
    got = Counter(map(tuple, found.collect()))
    expected = expected_manifest(rows, fanout)
    assert got == expected
    assert {r[-1] for r in got} == {True, False}
    if (levels, fanout) == (4, 16):
        assert Counter(map(tuple, merkle.manifest_of_documents(docs).collect())) == expected


def test_manifest_of_no_rows_and_of_one(spark):
    ship(spark)
    none = spark.createDataFrame([], DOCS)
    assert merkle.manifest_of_documents(none).count() == 0
    one = spark.createDataFrame([(1, "a", "en", None, 1, "", 0, 0, "")], DOCS)
    (row,) = merkle.manifest_of_documents(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root
    assert row.proof_sha256 == h()


@given(st.integers(1, 5), st.integers(2, 5))
@settings(max_examples=20, deadline=None)
def test_addresses_fill_the_array(levels, fanout):
    found = np.concatenate([merkle.address(levels, d, np.arange(fanout**d), fanout) for d in range(levels)])
    assert sorted(found) == list(range(merkle.size_of(levels, fanout)))


def test_subtrees_lie_together():
    inner = [merkle.address(4, 2, np.array([7]))[0], *merkle.address(4, 3, np.arange(7 * 16, 8 * 16))]
    assert sorted(inner) == list(range(min(inner), min(inner) + 17))


# spelling variants ----------------------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if code % 31 == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def variants(spark, rows):
    ship(spark)
    docs = spark.createDataFrame([(i, t, None, None, None, "t", 1, 2, "w") for i, t in rows], DOCS).repartition(4)
    found = [tuple(r) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_variants(spark):
    g = random.Random(9)
    letters = "abcé"
    words = ["".join(g.choice(letters) for _ in range(g.randint(7, 9))) for _ in range(60)]
    words += ["information", "mississippi", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "ab" * 40, "ÀÉ÷ÿÀÉ÷"]
    rows = []
    for i in range(400):
        picked = []
        for _ in range(12):
            w = g.choice(words) if g.random() < 0.5 else words[g.randint(0, 9) ** 2 % len(words)]
            if g.random() < 0.3:
                k = g.randint(0, len(w))
                w = g.choice([w[:k] + g.choice(letters) + w[k:], w[:k] + w[k + 1 :], w[:k] + g.choice(letters) + w[k + 1 :]])
            picked.append(w.upper() if g.random() < 0.1 else w)
        rows.append((i, g.choice([" ", "9", "\n", "_"]).join(picked)))
    rows += [(None, None), (500, None), (501, ""), (None, "information information"), *rows[:3], (502, ("x" * 30_000 + " ") * 2), (503, "short words")]
    expected = expected_variants(rows)
    assert any(f for _, f, *_ in expected)
    assert variants(spark, rows) == expected


def test_variants_follow_forms_to_the_last(spark):
    chain = [("abcdefgh", 2), ("abcdefgx", 20), ("abcdefyx", 200), ("abcdezyx", 2000)]
    rows = [(7, " ".join([w] * n)) for w, n in chain]
    if any(zlib.crc32(f"7:{w}".encode()) % 31 == 0 for w, _ in chain):
        raise AssertionError("choose another id")
    found = variants(spark, rows)
    assert found == expected_variants(rows)
    assert {r for _, _, r, *_ in found} == {"abcdezyx"}


def test_variants_of_nothing(spark):
    assert variants(spark, []) == set()
    assert variants(spark, [(1, None), (2, "a b c")]) == set()


# exact search ---------------------------------------------------------------------------------------------------------


def expected_nearest(rows, k, divisor):
    kept = []
    for at, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((at, i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = Counter()
    for at, q, v in kept:
        if q is None or q % divisor:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for other, i, w in kept if other != at]
        for rank, (minus, _, _, i) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            out[q, rank, i, -minus] += 1
    return out


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 7, "block_queries": 3}, {"shard_rows": 40, "block_queries": 100, "k": 3}])
def test_nearest(spark, sizes):
    ship(spark)
    g = random.Random(3)
    rows = [(i, [g.gauss(0, 0.2) for _ in range(12)]) for i in range(150)]
    rows += [(i, [0.5] * 12) for i in range(200, 240)]  # equal vectors
    rows += [(300, None), (301, [0.1, None]), (302, [float("nan")] * 12), (303, [float("inf")] + [0.0] * 11)]
    rows += [(304, []), (305, [0.3] * 5), (310, [-0.9] * 14), (None, [0.4] * 12), (None, [0.5] * 12), rows[10], rows[10], rows[155]]
    table = spark.createDataFrame([(i, v, 1, "p", 2, 0.5) for i, v in rows], VECTORS).repartition(6)
    found = maxscore.nearest(table, F.col("id") % 10 == 0, **sizes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, found.collect())) == expected_nearest(rows, sizes.get("k", 20), 10)


def test_nearest_with_large_numbers_and_few_rows(spark):
    ship(spark)
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1e6, -3e5]), (1, [2e6, 1.0]), (2, [-1e6, 7e6])]
    found = maxscore.nearest(spark.createDataFrame(rows, schema), F.col("id") % 2 == 0).collect()
    assert Counter(map(tuple, found)) == expected_nearest(rows, 20, 2)
    lone = spark.createDataFrame(rows[:1], schema)
    assert maxscore.nearest(lone, F.col("id") == 0).count() == 0
    assert maxscore.nearest(lone.where("vec_id > 0"), F.col("id") == 0).count() == 0
    huge = spark.createDataFrame([(0, [1e12]), (1, [1e12])], schema)
    with pytest.raises(Exception, match="64 bits"):
        maxscore.nearest(huge, F.col("id") == 0).count()


def test_other_terms_are_probed_only_while_competitive():
    """The same rows as a full product, with thresholds that make most terms non-essential."""
    g = np.random.default_rng(5)
    vectors = np.floor(g.normal(0, 8, (300, 16)) * np.linspace(3, 0.2, 16)).astype(np.int64)
    shard = maxscore.Shard(np.arange(300).tobytes(), np.arange(300).tobytes(), np.ones(300, np.uint8).tobytes(), 16, np.ascontiguousarray(vectors.T).tobytes())
    queries = maxscore.Shard(
        np.arange(20).tobytes(), np.arange(20).tobytes(), np.ones(20, np.uint8).tobytes(), 16, np.ascontiguousarray(vectors[:20].T).tobytes()
    )
    scores = vectors[:20] @ vectors.T
    np.fill_diagonal(scores, -(2**60))
    limits = np.sort(scores, axis=1)[:, -5]
    q, v, s = maxscore.top(shard, queries, limits, 5)
    expected = {(i, j, scores[i, j]) for i in range(20) for j in sorted(range(300), key=lambda j: (-scores[i, j], j))[:5]}
    assert set(zip(q, v, s)) == expected
