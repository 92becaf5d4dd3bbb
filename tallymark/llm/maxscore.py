"""Exact top-k search by integer inner product, with MaxScore.

The components of a vector are its terms and a component's values over a shard its posting list. Nearly
every vector has nearly every term, so a list is a column with one slot per vector. A shard keeps the least
and greatest value of each term; with them, a term adds at most max(q * least, q * greatest) to a score
(q: the query's component).

A query's terms are put in order of these bounds. Those at the end whose bounds together stay below the
query's threshold (the k-th best score known) are non-essential: no vector enters the result by them alone.
The essential postings are traversed for a block of queries at once, which gives each vector a partial
score. Vectors whose partial score and remaining bounds reach the threshold are competitive, and only for
these the other terms are probed, greatest bound first, dropping them as soon as they cannot reach it.

Thresholds come from a first round, in which each block of queries searches one shard with all terms
essential. The second round takes all other shards with these thresholds. A shard returns at most k rows a
query, and the k best of all rounds are the result. Ties go to the smaller id at each step.

How it is spread. Vectors are dealt to shards and queries to blocks of bounded size by a hash of a
row number, so equal vectors do not meet in one shard. A unit of work is one shard and one block: their rows are
repeated for each other's number and joined on the unit, so that no task holds more than one of each.
The number of units grows with vectors times queries, as an exact search by blocks must.

Edge cases. A missing vector, and one with a missing or non-finite component, takes no part. Shorter
vectors count as 0 in what they lack; an empty one scores 0 with all. Repeated rows are rows of their own,
as queries and as candidates; a missing id is never a query and comes last among ties. Scores are exact
as long as they fit into 64 bits; beyond that the search raises an error. An empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm import packed
from tallymark.operators.staging import discard, stage

K = 20
SCALE = 64
SHARD_ROWS = 4096
BLOCK_QUERIES = 1024
_AT_ONCE = 128
_PROBES = 4
_NEVER = np.iinfo(np.int64).min
_LAST_ID = np.iinfo(np.int64).max

_ROWS = "row long, id long, known boolean, vector binary"
_PACKED = "part long, rows binary, ids binary, known binary, width int, matrix binary"


def _quantised(scale: int):
    """Integer vectors as bytes; rows that take no part are left out."""

    def run(batches):
        for batch in batches:
            rows, vectors = [], []
            for i, values in enumerate(batch.column("embedding")):
                if not values.is_valid:
                    continue
                plain = values.values
                x = plain.cast(pa.float64()).to_numpy(zero_copy_only=False) if plain.null_count == 0 else np.array([np.nan])
                if not np.isfinite(x).all():
                    continue
                x = np.floor(scale * x)
                if len(x) and np.abs(x).max() >= 2.0**62:
                    raise OverflowError("a component is too large for an exact score")
                rows.append(i)
                vectors.append(x.astype(np.int64).tobytes())
            picked = batch.select(["row", "id"]).take(pa.array(rows, pa.int64()))
            known = picked.column("id").is_valid()
            ids = picked.column("id").fill_null(_LAST_ID)
            yield pa.RecordBatch.from_arrays([picked.column("row"), ids, known, pa.array(vectors, pa.binary())], _ROWS.replace(",", "").split()[::2])

    return run


def _pack(table: pa.Table) -> pa.Table:
    """One row for a shard or block: its vectors term by term, in the narrowest type that holds them."""
    vectors = [np.frombuffer(v, dtype=np.int64) for v in table.column("vector").to_pylist()]
    width = max(map(len, vectors))
    matrix = np.zeros((width, len(vectors)), dtype=np.int64)
    for i, v in enumerate(vectors):
        matrix[: len(v), i] = v
    most = np.abs(matrix).max() if matrix.size else 0
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
    rows, ids, known = (table.column(c).to_numpy() for c in ("row", "id", "known"))
    return pa.table(
        {
            "part": table.column("part").slice(0, 1),
            "rows": pa.array([rows.tobytes()], pa.binary()),
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "known": pa.array([known.astype(np.uint8).tobytes()], pa.binary()),
            "width": pa.array([width], pa.int32()),
            "matrix": pa.array([matrix.astype(kind).tobytes()], pa.binary()),
        }
    )


class Shard:
    """Postings of some vectors, with the bounds of their values."""

    def __init__(self, rows: bytes, ids: bytes, known: bytes, width: int, matrix: bytes):
        self.rows, self.ids = np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64)
        self.known = np.frombuffer(known, np.uint8).astype(bool)
        size = len(matrix) // max(1, width * len(self.rows))
        self.postings = np.frombuffer(matrix, dtype=f"i{size or 1}").reshape(width, len(self.rows)).astype(np.int64)

    def widened(self, width: int) -> np.ndarray:
        return np.pad(self.postings, ((0, width - len(self.postings)), (0, 0)))


def top(shard: Shard, queries: Shard, thresholds: np.ndarray, k: int):
    """The k best vectors of the shard for each query, if they reach its threshold.

    Returns arrays (query, vector, score) of places in the block and in the shard.
    """
    width = max(len(shard.postings), len(queries.postings), 1)
    postings, wanted = shard.widened(width), queries.widened(width).T
    reach = float(np.abs(postings).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * width
    if reach >= 2.0**62:
        raise OverflowError("a score may not fit into 64 bits")
    if reach < 2.0**50:  # exact, and much faster in floating point
        postings, wanted = postings.astype(np.float64), wanted.astype(np.float64)
    low, high = postings.min(1), postings.max(1)
    out = []
    for at in range(0, len(wanted), _AT_ONCE):
        found = _top(shard, postings, low, high, wanted[at : at + _AT_ONCE], queries.rows[at : at + _AT_ONCE], thresholds[at : at + _AT_ONCE], k)
        out.append((found[0] + at, found[1], found[2]))
    return tuple(np.concatenate([o[i] for o in out]).astype(np.int64) for i in range(3))


def _top(shard, postings, low, high, wanted, own, thresholds, k):
    terms = wanted.shape[1]
    bounds = np.maximum(wanted * low, wanted * high)
    order = np.argsort(-bounds, axis=1, kind="stable")
    rest = np.zeros((len(wanted), terms + 1), dtype=bounds.dtype)  # bounds of the terms from a place on
    rest[:, :-1] = np.cumsum(np.take_along_axis(bounds, order, 1)[:, ::-1], axis=1)[:, ::-1]
    open_end = thresholds == _NEVER
    limit = np.where(open_end, np.iinfo(np.int64).min // 2, thresholds).astype(rest.dtype)
    essential = np.where(rest < limit[:, None], np.arange(terms + 1), terms).min(1)
    mask = np.zeros(wanted.shape, dtype=bool)
    np.put_along_axis(mask, order, np.arange(terms) < essential[:, None], 1)
    partial = np.where(mask, wanted, 0) @ postings
    itself = own[:, None] == shard.rows[None, :]
    good = (partial + np.take_along_axis(rest, essential[:, None], 1) >= limit[:, None]) & ~itself
    for i in np.flatnonzero(open_end):  # all terms counted: the k-th best is the threshold
        scores = partial[i, good[i]]
        if len(scores) > k:
            good[i] &= partial[i] >= np.partition(scores, len(scores) - k)[len(scores) - k]
    query, vector = np.nonzero(good)
    score, place = partial[query, vector], essential[query]
    while (place < terms).any():  # probe the others, while they are competitive
        for _ in range(_PROBES):
            left = place < terms
            term = order[query, np.minimum(place, terms - 1)]
            score = score + np.where(left, wanted[query, term] * postings[term, vector], 0)
            place = place + left
        keep = score + rest[query, place] >= limit[query]
        query, vector, score, place = query[keep], vector[keep], score[keep], place[keep]
    best = np.lexsort((shard.rows[vector], shard.ids[vector], ~shard.known[vector], -score, query))
    query, vector, score = query[best], vector[best], score[best]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], vector[rank < k], score[rank < k]


_FOUND = "part long, q_row long, query_id long, row long, vec_id long, known boolean, score long"


def _search(k: int):
    """Rows of the k best for each unit."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                shard = Shard(*(r["shard"][c] for c in ("rows", "ids", "known", "width", "matrix")))
                queries = Shard(*(r["block"][c] for c in ("rows", "ids", "known", "width", "matrix")))
                limits = np.full(len(queries.rows), _NEVER)
                if r["limits"] is not None:
                    known, values = (np.frombuffer(r["limits"][c], np.int64) for c in ("rows", "scores"))
                    at = packed.lookup(known, queries.rows)
                    limits = np.where(at >= 0, values[at], _NEVER)
                q, v, score = top(shard, queries, limits, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(q), r["block"]["part"], dtype=np.int64)),
                        pa.array(queries.rows[q]),
                        pa.array(queries.ids[q]),
                        pa.array(shard.rows[v]),
                        pa.array(shard.ids[v]),
                        pa.array(shard.known[v]),
                        pa.array(score),
                    ],
                    _FOUND.replace(",", "").split()[::2],
                )

    return run


def _limits(k: int):
    """Per block the k-th best score of each of its queries in the first round."""

    def run(table: pa.Table) -> pa.Table:
        rows, scores = table.column("q_row").to_numpy(), table.column("score").to_numpy()
        order = np.lexsort((-scores, rows))
        rows, scores = rows[order], scores[order]
        names, first, counts = np.unique(rows, return_index=True, return_counts=True)
        last = np.where(counts >= k, scores[np.minimum(first + k - 1, len(scores) - 1)], _NEVER)
        return pa.table(
            {
                "part": table.column("part").slice(0, 1),
                "rows": pa.array([names.tobytes()], pa.binary()),
                "scores": pa.array([last.tobytes()], pa.binary()),
            }
        )

    return run


def nearest(
    vectors: DataFrame,
    query: Column,
    k: int = K,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k best rows of each query: query_id, rank, vec_id, score.

    query is a boolean column on `id`; rows for which it holds are the queries.
    """
    source = vectors.select(
        F.monotonically_increasing_id().alias("row"), vectors[id_column].cast("long").alias("id"), vectors[vector_column].alias("embedding")
    )
    rows = stage(source.mapInArrow(_quantised(scale), _ROWS), "vectors")
    asked = F.col("known") & F.coalesce(query, F.lit(False))
    n, m = rows.agg(F.count("*"), F.count(F.when(asked, 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_queries))

    def dealt_out(part: DataFrame, parts: int) -> DataFrame:
        dealt = part.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
        return stage(dealt.groupBy("part").applyInArrow(_pack, _PACKED), "vectors")

    shard_table, block_table = dealt_out(rows, shards), dealt_out(rows.where(asked), blocks)
    body = F.struct(*shard_table.columns)
    mine = F.pmod("part", F.lit(shards))

    def pairs(numbers: Column, of_block: DataFrame, empty: Column) -> DataFrame:
        one = of_block.select(body.alias("block"), empty.alias("limits"), F.explode(numbers).alias("s"))
        one = one.select("block", "limits", "s", F.col("block.part").alias("b"))
        other = shard_table.select(body.alias("shard"), F.col("part").alias("s"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
        return one.join(other.withColumn("b", F.col("b").cast("long")), ["s", "b"])

    kind = "struct<rows: binary, scores: binary>"
    first = stage(
        pairs(F.array(mine), block_table, F.lit(None).cast(kind)).select("shard", "block", "limits").mapInArrow(_search(k), _FOUND),
        "vectors",
    )
    whole = first
    if shards > 1:
        limits = first.groupBy("part").applyInArrow(_limits(k), "part long, rows binary, scores binary")
        limits = limits.select(F.col("part").alias("of"), F.struct("rows", "scores").alias("found"))
        known = block_table.join(limits, block_table["part"] == limits["of"], "left")
        others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), lambda s: s != mine)
        second = pairs(others, known, F.col("found")).select("shard", "block", "limits").mapInArrow(_search(k), _FOUND)
        whole = first.unionByName(second)
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.desc("known"), "vec_id", "row")
    ranked = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    vec_id = F.when(F.col("known"), F.col("vec_id"))
    result = stage(ranked.select("query_id", "rank", vec_id.alias("vec_id"), "score"), "nearest")
    discard(rows, shard_table, block_table, first)
    return result
