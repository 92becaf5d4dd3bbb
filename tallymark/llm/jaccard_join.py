"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct five-word shingles. Documents with equal sets are one node.

1. Shingles that only one node has cannot be shared. Sorted and packed shingle lists go to
   buckets of hash values, and only shingles of two nodes or more come back, with the number of
   nodes that have them. A node with less than the threshold's share of such shingles has no partner.
2. The tree. Its roots are shingles: two sets that reach the threshold share a shingle among the
   rarest n - ceil(t n) + 1 of each, so a node is filed under those roots only. Below a root, nodes
   are points: their shingles are hashed into groups and the group counts are the coordinates.
   Points are packed into leaves along the coordinates that spread most, and a leaf keeps its
   maxima. The sum of coordinate minima bounds the overlap of two points, and of two leaves by their
   maxima. Only pairs whose bound reaches the overlap that their sizes demand are verified.
3. Only connections are asked for, so the tree is searched several times. The first searches need not be
   complete: a node names the node of another component with the best bound, at first under three of its
   roots (the rarest, the most frequent, the one of least hash, on which copies agree), then under all, while
   that still finds many links. Their verified links make components. The last search takes every pair that
   the bound admits between different components. Together they connect what all pairs would connect, without
   listing a group of copies pair by pair.
4. Roots are in one order for all nodes, rarest first. If a root is the first that two nodes share,
   nothing before it adds to their overlap, so what comes from it on in either list bounds the overlap too. A pair is
   taken only where this bound holds; at its first shared root it does for every pair that reaches the threshold.

How it is spread. Numbers of buckets and parts grow with the input. A root with more points than
`cell_points` is cut into cells, and pairs of cells are units of their own, so no task holds a
whole root; buckets of units are sized by the rows that the cells make. Hot nodes in joins are left to skew handling, which can split them.

Edge cases. A text of fewer than five words is one shingle, its whole word sequence; a text without
words (or missing) has none and is linked with nothing. Repeated rows are equal nodes. A missing id
never becomes a component id unless nothing else is there. An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames, links, packed, words
from tallymark.operators.staging import discard, stage

SHINGLE = 5
PERCENT = 75
BUCKET_ENTRIES = 1_500_000
FLUSH_BYTES = 8 << 20
GROUPS = 32
LEAF_POINTS = 32
CELL_POINTS = 2048
UNIT_ROWS = 20_000
_ROUNDS, _FEW = 1, 50  # searches for the best pairs go on while they link one node in _FEW
_SHORT = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(texts: words.Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order, and the number of their text."""
    w = words.words(texts, lower=True)
    keys, at = words.windows(w.hashes, w.text, size)
    text = w.text[at]
    few = np.flatnonzero((w.counts > 0) & (w.counts < size))
    whole = words.hash_runs(w.hashes, w.firsts[few], (w.firsts + w.counts)[few]) * _SHORT
    keys, text = np.concatenate((keys, whole)), np.concatenate((text, few))
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[new], text[new]


def _set_hashes(keys: np.ndarray, text: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.bincount(text, minlength=count)
    ends = np.cumsum(sizes)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.mix(keys * _SHORT), dtype=np.uint64)))
    return words.mix(total[ends] - total[ends - sizes] + sizes.astype(np.uint64)), sizes


def _shingles(buckets: int, id_type: pa.DataType):
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=np.uint64)
    types = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(id_type))
    names = ["bucket", "keys", "owners", "nodes", "sizes", "ids"]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    def flush(keys, owners, nodes, sizes, turn):
        keys, owners, nodes, sizes = (np.concatenate(x) for x in (keys, owners, nodes, sizes))
        _, first, node_of = np.unique(nodes, return_index=True, return_inverse=True)
        own = np.zeros(len(nodes), dtype=bool)
        own[first] = True  # equal sets of one flush are listed once
        keep = own[owners]
        keys, owners = keys[keep], node_of[owners[keep]].astype(np.uint32)
        nodes, sizes = nodes[first], sizes[first].astype(np.uint32)
        order = np.argsort(keys)
        keys, owners = keys[order], owners[order]
        cuts = [0, *np.searchsorted(keys, edges), len(keys)]
        rows = []
        for bucket in range(buckets):
            a, b = cuts[bucket], cuts[bucket + 1]
            if b > a:
                used, index = np.unique(owners[a:b], return_inverse=True)
                rows.append(
                    (
                        bucket,
                        packed.pack_sorted(keys[a:b]),
                        packed.pack(index.astype(np.uint32)),
                        packed.pack_sorted(nodes[used]),
                        packed.pack(sizes[used]),
                        None,
                    )
                )
        return table(rows)

    def run(batches):
        parts, held, count, turn = ([], [], [], []), 0, 0, 0
        for batch in batches:
            ids = batch.column("doc_id")
            for texts in words.slices(batch.column("text")):
                keys, text = shingle_sets(texts)
                nodes, sizes = _set_hashes(keys, text, texts.count)
                turn += 1
                listed = pa.ListArray.from_arrays(
                    pa.array([0, texts.count], pa.int32()), ids.slice(texts.first, texts.count)
                )
                row = [pa.array([v], t) for v, t in zip((-1 - turn % buckets, None, None, nodes.tobytes(), sizes.astype(np.uint32).tobytes()), types)]
                yield pa.RecordBatch.from_arrays([*row, listed], names)
                for part, value in zip(parts, (keys, text + count, nodes, sizes)):
                    part.append(value)
                count += texts.count
                held += len(texts.data)
                if held >= FLUSH_BYTES:
                    yield flush(*parts, turn)
                    parts, held, count = ([], [], [], []), 0, 0
        if count:
            yield flush(*parts, turn)

    return run


_SHARED = "part int, keys binary, nodes binary, sizes binary, holders binary, ids array<{id}>, id_nodes array<long>, id_sizes array<long>"


def _shared(parts: int, id_type: pa.DataType):
    names = ["part", "keys", "nodes", "sizes", "holders", "ids", "id_nodes", "id_sizes"]
    long_list = pa.list_(pa.int64())
    types = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(id_type), long_list, long_list)

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            nodes = [np.frombuffer(x, np.int64) for x in table.column("nodes").to_pylist()]
            sizes = [np.frombuffer(x, np.uint32).astype(np.int64) for x in table.column("sizes").to_pylist()]
            n = table.num_rows
            plain = [pa.nulls(n, t) for t in types[:5]]
            lists = [table.column("ids").combine_chunks(), pa.array(nodes, long_list), pa.array(sizes, long_list)]
            return pa.table([*plain, *lists], names=names)
        keys, nodes, sizes = [], [], []
        for k, o, v, s in zip(*(table.column(c).to_pylist() for c in ("keys", "owners", "nodes", "sizes"))):
            owner = packed.unpack(o, np.uint32)
            keys.append(packed.unpack_sorted(k))
            nodes.append(packed.unpack_sorted(v)[owner])
            sizes.append(packed.unpack(s, np.uint32)[owner])
        keys, nodes, sizes = np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes)
        order = np.argsort(keys)
        near = np.zeros(len(keys), dtype=bool)
        ordered = keys[order]
        same = ordered[1:] == ordered[:-1]
        near[1:] |= same
        near[:-1] |= same
        pick = order[near]  # shingles of one row only go no further
        keys, nodes, sizes = keys[pick], nodes[pick], sizes[pick]
        order = np.lexsort((nodes, keys))
        keys, nodes, sizes = keys[order], nodes[order], sizes[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes, sizes = keys[new], nodes[new], sizes[new]
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        holders = counts[inverse]
        many = holders > 1
        keys, nodes, sizes, holders = keys[many], nodes[many], sizes[many], holders[many]
        part = (nodes % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        rows = []
        for p in range(parts):
            at = order[cuts[p] : cuts[p + 1]]
            if len(at):
                rows.append(
                    (p, packed.pack_sorted(keys[at]), packed.pack(nodes[at]), packed.pack(sizes[at]), packed.pack(holders[at].astype(np.uint32)), None, None, None)
                )
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return run


_POINTS = "node long, size long, shared binary, point binary, roots array<long>, before long, chosen array<long>"


def _points(percent: int):
    def run(table: pa.Table) -> pa.Table:
        keys = np.concatenate([packed.unpack_sorted(x) for x in table.column("keys").to_pylist()])
        nodes = np.concatenate([packed.unpack(x) for x in table.column("nodes").to_pylist()])
        sizes = np.concatenate([packed.unpack(x, np.uint32) for x in table.column("sizes").to_pylist()]).astype(np.int64)
        holders = np.concatenate([packed.unpack(x, np.uint32) for x in table.column("holders").to_pylist()])
        order = np.lexsort((keys, holders, nodes))
        keys, nodes, sizes = keys[order], nodes[order], sizes[order]
        cuts = np.concatenate((np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1]))), [len(nodes)]))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            n, shared = int(sizes[a]), int(b - a)
            if 100 * shared < percent * n:
                continue
            own = keys[a:b]
            prefix = n - -(-percent * n // 100) + 1 - (n - shared)
            point = np.bincount((words.mix(own) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
            point = point.astype(np.uint16 if point.max() < 1 << 16 else np.int32)
            roots = own[:prefix].view(np.int64)
            chosen = sorted({int(roots[0]), int(roots[-1]), int(roots[words.mix(own[:prefix]).argmin()])})
            out.append((int(nodes[a].astype(np.int64)), n, packed.pack_sorted(np.sort(own)), point.tobytes(), roots.tolist(), n - shared, chosen))
        long_list = pa.list_(pa.int64())
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), long_list, pa.int64(), long_list)
        names = ["node", "size", "shared", "point", "roots", "before", "chosen"]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    return run


def tree_pairs(points: np.ndarray, sizes: np.ndarray, rest: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int):
    """Pairs of leaves, then of points, whose bounds reach the overlap that their sizes demand.

    rest is the number of a node's shingles from the root on; left and right are the rows of the points on
    either side. Yields arrays of (row, row, bound).
    """

    def pack(rows):
        spread = points[rows].max(0) - points[rows].min(0) if len(rows) else points[:1].ravel()
        first, second = np.argsort(-spread, kind="stable")[:2]
        slabs = max(1, int(np.sqrt(len(rows) / LEAF_POINTS)))
        by_first = np.array_split(rows[np.argsort(points[rows, first], kind="stable")], slabs)
        sorted_rows = [s[np.argsort(points[s, second], kind="stable")] for s in by_first]
        leaves = [x for s in sorted_rows for x in np.array_split(s, max(1, -(-len(s) // LEAF_POINTS))) if len(x)]
        return leaves, np.array([points[x].max(0) for x in leaves]), np.array([[sizes[x].min(), sizes[x].max()] for x in leaves])

    if not len(left) or not len(right):
        return
    one, one_max, one_size = pack(left)
    two, two_max, two_size = (one, one_max, one_size) if left is right else pack(right)
    for k, rows in enumerate(one):
        begin = k if left is right else 0
        bound = np.minimum(one_max[k], two_max[begin:]).sum(1)
        least = one_size[k, 0] + two_size[begin:, 0]
        fits = (bound * (100 + percent) >= percent * least) & (100 * one_size[k, 1] >= percent * two_size[begin:, 0])
        fits &= 100 * two_size[begin:, 1] >= percent * one_size[k, 0]
        for j in np.flatnonzero(fits) + begin:
            other = two[j]
            bounds = np.minimum(points[rows][:, None, :], points[other][None, :, :]).sum(2)
            total = sizes[rows][:, None] + sizes[other][None, :]
            bounds = np.minimum(bounds, np.minimum(rest[rows][:, None], rest[other][None, :]))
            good = bounds * (100 + percent) >= percent * total
            if left is right and j == k:
                good = np.triu(good, 1)
            a, b = np.nonzero(good)
            if len(a):
                yield rows[a], other[b], bounds[a, b]


def _counts(blobs: list[bytes]) -> np.ndarray:
    """Group counts of points; those of very long texts are stored wider."""
    if all(len(b) == 2 * GROUPS for b in blobs):
        return np.frombuffer(b"".join(blobs), dtype=np.uint16).reshape(-1, GROUPS).astype(np.int32)
    return np.array([np.frombuffer(b, dtype=np.uint16 if len(b) == 2 * GROUPS else np.int32) for b in blobs], dtype=np.int32)


def _search(percent: int, nearest: bool):
    """Search the trees of a bucket of units: the best pair of each node, or all, between components."""

    def run(table: pa.Table) -> pa.Table:
        roots, units = table.column("root").to_numpy(), table.column("unit").to_numpy()
        order = np.lexsort((units, roots))
        nodes, sizes = table.column("node").to_numpy()[order], table.column("size").to_numpy()[order]
        sides, labels = table.column("side").to_numpy()[order], table.column("label").to_numpy()[order]
        rest = table.column("rest").to_numpy()[order]
        blob = table.column("point").to_pylist()
        points = _counts(blob)[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (roots[order][1:] != roots[order][:-1]) | (units[order][1:] != units[order][:-1])
        cuts = np.concatenate((np.flatnonzero(new), [len(order)]))
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        best: dict[int, tuple[float, int]] = {}
        for low, high in zip(cuts[:-1], cuts[1:]):
            rows = np.arange(low, high)
            left = rows[sides[rows] == 0]
            right = rows[sides[rows] == 1]
            right = right if len(right) else left
            for a, b, bound in tree_pairs(points, sizes, rest, left, right, percent):
                other = labels[a] != labels[b]
                a, b, bound = a[other], b[other], bound[other]
                if nearest:
                    value = bound / (sizes[a] + sizes[b])
                    a, b, value = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((value, value))
                    rank = np.lexsort((nodes[b], -value, nodes[a]))
                    _, first = np.unique(nodes[a[rank]], return_index=True)
                    for k in rank[first]:
                        key, entry = int(nodes[a[k]]), (-float(value[k]), int(nodes[b[k]]))
                        best[key] = min(best.get(key, entry), entry)
                else:
                    found_a.append(nodes[a])
                    found_b.append(nodes[b])
        if best:
            found_a.append(np.fromiter(best, np.int64, len(best)))
            found_b.append(np.array([e[1] for e in best.values()], dtype=np.int64))
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), 1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            one, two = batch.column("shared_a").to_pylist(), batch.column("shared_b").to_pylist()
            total = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
            inter = np.array(
                [len(np.intersect1d(packed.unpack_sorted(x), packed.unpack_sorted(y), True)) for x, y in zip(one, two)],
                dtype=np.int64,
            )
            good = pa.array(100 * inter >= percent * (total - inter))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(good)

    return run


_UNIT = ("root", "unit", "side", "node", "size", "label", "point", "rest")


def _units(filed: DataFrame, nearest: bool, cell_points: int) -> tuple[DataFrame, int, DataFrame]:
    """Cut the roots into units of bounded size; also the number of rows of all, and a table to discard."""
    sizes = filed.groupBy("root").agg(F.count("*").alias("points"), F.countDistinct("label").alias("labels"))
    sizes = sizes.where("points > 1 and labels > 1").select("root", "points", F.ceil(F.col("points") / cell_points).alias("cells"))
    sizes = stage(sizes, "jaccard")
    copies = F.least("cells", F.lit(3)) if nearest else F.col("cells")
    rows = sizes.agg(F.sum(F.col("points") * copies)).first()[0] or 0
    placed = filed.join(sizes.drop("points"), "root").withColumn("cell", F.pmod("node", "cells"))
    last = F.when(F.lit(nearest), F.least(F.col("cells") - 1, F.lit(1))).otherwise(F.col("cells") - 1)
    steps = placed.withColumn("step", F.explode(F.sequence(F.lit(0), last)))
    other = F.pmod(F.col("cell") + F.col("step"), "cells")
    mine, theirs = F.least("cell", other), F.greatest("cell", other)
    if nearest:  # neighbouring cells only; each row is also the neighbour of the cell before it
        back = steps.where("step = 1").withColumn("step", F.lit(-1))
        steps = steps.unionByName(back)
    units = steps.withColumn("unit", mine * F.col("cells") + theirs).withColumn(
        "side", F.when(mine == theirs, 0).otherwise((F.col("cell") == theirs).cast("int"))
    )
    units = units.select(*_UNIT)
    return (units.distinct() if nearest else units), rows, sizes


def _links(points: DataFrame, filed: DataFrame, percent: int, nearest: bool, cell_points: int, unit_rows: int) -> DataFrame:
    units, rows, sizes = _units(filed, nearest, cell_points)
    found = (
        units.withColumn("bucket", F.pmod(F.xxhash64("root", "unit"), F.lit(max(1, -(-rows // unit_rows)))))
        .groupBy("bucket")
        .applyInArrow(_search(percent, nearest), "a long, b long")
        .distinct()
    )
    side = points.select("node", "size", "shared")
    joined = found.join(side.toDF("a", "size_a", "shared_a"), "a").join(side.toDF("b", "size_b", "shared_b"), "b")
    linked = stage(joined.mapInArrow(_verify(percent), "a long, b long"), "jaccard")
    discard(sizes)
    return linked


def components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = PERCENT,
    cell_points: int = CELL_POINTS,
    bucket_entries: int = BUCKET_ENTRIES,
    unit_rows: int = UNIT_ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = docs.select(docs[id_column].alias("doc_id"), frames.plain_text(docs, text_column).alias("text"))
    _, size = frames.text_bytes(rows)
    buckets = max(1, -(-size // (6 * bucket_entries)))
    id_type = rows.schema["doc_id"].dataType
    arrow_id = pa.int64() if isinstance(id_type, T.LongType) else None
    if arrow_id is None:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow_id = to_arrow_type(id_type)
    simple = id_type.simpleString()
    packed_rows = rows.mapInArrow(
        _shingles(buckets, arrow_id),
        f"bucket int, keys binary, owners binary, nodes binary, sizes binary, ids array<{simple}>",
    )
    shared = stage(
        packed_rows.groupBy("bucket").applyInArrow(_shared(buckets, arrow_id), _SHARED.format(id=simple)), "jaccard"
    )
    listed = shared.where("part is null").select(F.explode(F.arrays_zip("ids", "id_nodes", "id_sizes")).alias("d"))
    listed = listed.select(
        F.col("d.ids").alias("doc_id"), F.col("d.id_sizes").alias("n_shingles"), F.col("d.id_nodes").alias("node")
    )
    points = stage(
        shared.where("part is not null").select("part", "keys", "nodes", "sizes", "holders").groupBy("part").applyInArrow(_points(percent), _POINTS),
        "jaccard",
    )
    filed = points.select(F.posexplode("roots").alias("place", "root"), "node", "size", "point", "before", "chosen")
    filed = filed.withColumn("rest", F.col("size") - F.col("before") - F.col("place"))
    some = filed.where(F.array_contains("chosen", F.col("root"))).withColumn("label", F.col("node"))
    found = [_links(points, some, percent, True, cell_points, unit_rows)]
    labels, nodes = links.components(found[0]), points.count()
    for turn in range(_ROUNDS + 1):
        last = turn == _ROUNDS or found[-1].count() * _FEW < nodes
        labelled = filed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        found.append(_links(points, labelled, percent, not last, cell_points, unit_rows))
        labels = links.components(reduce(DataFrame.union, found))
        if last:
            break
    discard(points, *found)

    placed = listed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = placed.where("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    return placed.join(smallest, "label", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of each component, and all documents without words; same columns."""
    row = F.struct(*[docs[c].alias(c) for c in docs.columns])
    key = F.xxhash64(docs[id_column], docs[text_column])
    keyed = docs.select(key.alias("key"), docs[id_column].alias("id"), docs[text_column].alias("text"), row.alias("row"))
    found = components(keyed.select("key", "text"), "key", percent=percent).distinct()
    ids = keyed.select(F.col("key").alias("doc_id"), "id").distinct()
    place = F.struct(F.col("id").isNull(), "id", "doc_id")
    kept = found.join(ids, "doc_id").groupBy("component_id").agg(F.min(place).alias("best"))
    kept = kept.select(F.col("best.doc_id").alias("key"))
    turn = F.row_number().over(Window.partitionBy("key").orderBy("key"))  # of repeated rows, one
    return keyed.join(kept, "key", "left_semi").withColumn("turn", turn).where("turn = 1").select("row.*")
