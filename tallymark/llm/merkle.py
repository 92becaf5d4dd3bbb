"""Merkle manifest of a table, its trees stored in van Emde Boas layout.

Every row is a leaf, a digest of five columns. The leaves of a source, in order, are the lowest level
of a tree: every `FANOUT` consecutive nodes become the digest of their concatenated digests, until one
is left, the source's subroot. The subroots, in order of source, are reduced to the root likewise.

A tree is cut into blocks, complete subtrees of `levels` levels of nodes at aligned places. A block
is one row with the array of its nodes in van Emde Boas order: the upper half of the levels comes first,
then each subtree below it, both laid out in the same way. `address` finds a node from its depth and
index by splitting the height at each step, whatever the size of a cache line; construction and the
retrieval of siblings use nothing else. The block roots are the leaves of the next tier of blocks,
and so on until a tree has one block.

How it is spread. Leaves are computed by Spark's own functions and sorted by ranges of (source, id), so
a source with most of the rows is spread over many partitions; a leaf's place is its place in its
partition plus the rows before it, from one count per partition and source. A task holds one block
(at most 4,096 leaves of 200 bytes) at a time. The paths above a block are computed once per block, top
tier first, and joined to it; the driver sees the root and the largest number of leaves of a tree.

Edge cases. Missing values are `-`, so an empty text differs from a missing one. The missing source is
a tree of its own, before all others; missing ids come first in it. Rows with the same source and id are
ordered by leaf, and repeated rows are leaves of their own. A very long text is hashed where it is and goes
no further. A row without an id is never tampered with. An empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.staging import discard, stage

FANOUT = 16
LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DIGEST = 64


def size_of(levels: int, fanout: int = FANOUT) -> int:
    """Number of nodes of a complete subtree."""
    return (fanout**levels - 1) // (fanout - 1)


def address(levels: int, depth: int, index: np.ndarray, fanout: int = FANOUT) -> np.ndarray:
    """Van Emde Boas addresses of nodes at a depth (0: root) of a complete subtree."""
    index = np.asarray(index, dtype=np.int64)
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index, fanout)
    below, width = levels - top, fanout ** (depth - top)
    return size_of(top, fanout) + index // width * size_of(below, fanout) + address(below, depth - top, index % width, fanout)


class Block:
    """An aligned subtree with up to fanout ** (levels - 1) leaves, in van Emde Boas order."""

    def __init__(self, nodes: np.ndarray, leaves: int, levels: int, fanout: int):
        self.nodes, self.leaves, self.levels, self.fanout = nodes, leaves, levels, fanout
        self._runs: dict[tuple[int, int], bytes] = {}
        self.counts = [leaves]
        for _ in range(levels - 1):
            self.counts.append(-(-self.counts[-1] // fanout))
        self.counts.reverse()

    @classmethod
    def build(cls, leaves: list[str], levels: int, fanout: int = FANOUT) -> Block:
        used = int(max(address(levels, d, np.array([-(-len(leaves) // fanout ** (levels - 1 - d)) - 1]), fanout)[0] for d in range(levels))) + 1
        block = cls(np.zeros(used, dtype=f"S{_DIGEST}"), len(leaves), levels, fanout)
        block.nodes[address(levels, levels - 1, np.arange(len(leaves)), fanout)] = np.array(leaves, dtype=f"S{_DIGEST}")
        for depth in range(levels - 2, -1, -1):
            for parent in range(block.counts[depth]):
                digest = sha256(block.run(depth + 1, parent)).hexdigest()
                block.nodes[address(levels, depth, np.array([parent]), fanout)[0]] = digest.encode()
        return block

    def run(self, depth: int, parent: int) -> bytes:
        """The children at a depth of a node above, left to right."""
        if (depth, parent) not in self._runs:
            first = parent * self.fanout
            index = np.arange(first, min(first + self.fanout, self.counts[depth]))
            self._runs[depth, parent] = self.nodes[address(self.levels, depth, index, self.fanout)].tobytes()
        return self._runs[depth, parent]

    @property
    def root(self) -> str:
        return self.nodes[0].decode()

    def path(self, leaf: int) -> list[tuple[int, bytes]]:
        """Place in its run and siblings of each node from a leaf up to below the root."""
        steps = []
        for depth in range(self.levels - 1, 0, -1):
            leaf, place = divmod(leaf, self.fanout)
            run = self.run(depth, leaf)
            steps.append((place, run[: place * _DIGEST] + run[(place + 1) * _DIGEST :]))
        return steps


def fold(digest: str, path: list[tuple[int, bytes]]) -> str:
    """The root that a digest gives with the siblings of its path."""
    for place, others in path:
        at = place * _DIGEST
        digest = sha256(others[:at] + digest.encode() + others[at:]).hexdigest()
    return digest


def _levels_of(total: int, most: int, fanout: int) -> int:
    """Levels of a block: just enough for a tree of one block, else all."""
    levels = 1
    while levels < most and fanout ** (levels - 1) < total:
        levels += 1
    return levels


def leaf(text: Column, columns: dict[str, Column]) -> Column:
    """Digest of a row, with this text."""
    parts = []
    for name in COLUMNS:
        value = (text if name == "text" else columns[name]).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in their tree and the tree's size; also the table that was staged."""
    rows = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = stage(rows.withColumn("place", F.monotonically_increasing_id()), "merkle")
    run = F.shiftright("place", 33)
    runs = placed.groupBy("tree", run.alias("part")).agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("tree").alias("of"),
        F.col("part"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("total"),
    )
    joined = placed.join(runs, placed["tree"].eqNullSafe(runs["of"]) & (run == runs["part"]))
    return joined.withColumn("rank", F.col("place") + F.col("shift")).drop("of", "part", "shift", "place"), placed


_BLOCKS = "tree {tree}, block long, total long, nodes binary, root string, {members}"


def _build(levels: int, fanout: int, members: list[str]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        total = table.column("total")[0].as_py()
        block = Block.build(table.column("digest").to_pylist(), _levels_of(total, levels, fanout), fanout)
        columns = {
            "tree": table.column("tree").slice(0, 1).combine_chunks(),
            "block": pa.array([table.column("block")[0].as_py()], pa.int64()),
            "total": pa.array([total], pa.int64()),
            "nodes": pa.array([block.nodes.tobytes()], pa.binary()),
            "root": pa.array([block.root], pa.string()),
        }
        for name in members:
            column = table.column(name).combine_chunks()
            offsets = pa.array([0, len(column)], pa.int32())
            columns[name] = pa.ListArray.from_arrays(offsets, column)
        return pa.table(columns)

    return run


def _stored(nodes: bytes, total: int, block: int, levels: int, fanout: int) -> Block:
    """The block of a row; its number of leaves follows from the tree's size."""
    height = _levels_of(total, levels, fanout)
    width = fanout ** (levels - 1)
    return Block(np.frombuffer(nodes, dtype=f"S{_DIGEST}"), min(width, total - block * width), height, fanout)


_PATH = "array<struct<place: int, others: binary>>"


def _paths(levels: int, fanout: int):
    """For every leaf of the blocks of a tier its whole path, given the path above the block."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _stored(row["nodes"], row["total"], row["block"], levels, fanout)
                above = [(s["place"], s["others"]) for s in row["above"] or []]
                first = row["block"] * fanout ** (levels - 1)
                paths = [
                    [{"place": p, "others": o} for p, o in block.path(i) + above] for i in range(block.leaves)
                ]
                kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.binary())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * block.leaves, batch.schema.field("tree").type),
                        pa.array(range(first, first + block.leaves), pa.int64()),
                        pa.array(paths, kind),
                    ],
                    ["of", "rank", "up"],
                )

    return run


class Forest:
    """The trees of a set of leaves (tree, rank, total, digest, members), tier by tier."""

    def __init__(self, leaves: DataFrame, members: list[str], levels: int = LEVELS, fanout: int = FANOUT):
        self.levels, self.fanout, self.width = levels, fanout, fanout ** (levels - 1)
        self.kind = leaves.schema["tree"].dataType.simpleString()
        self.tiers = [self._tier(leaves, members)]
        most = self.tiers[0].agg(F.max("total")).first()[0] or 0
        while most > self.width:
            most = -(-most // self.width)
            below = self.tiers[-1].where(F.col("total") > self.width)
            total = F.ceil(F.col("total") / self.width).cast("long")
            self.tiers.append(
                self._tier(below.select("tree", F.col("block").alias("rank"), total.alias("total"), F.col("root").alias("digest")), [])
            )

    def _tier(self, leaves: DataFrame, members: list[str]) -> DataFrame:
        listed = [f"{m} array<{leaves.schema[m].dataType.simpleString()}>" for m in members]
        schema = _BLOCKS.format(tree=self.kind, members=", ".join(listed)).rstrip(", ")
        wanted = leaves.select(
            "tree", F.floor(F.col("rank") / self.width).cast("long").alias("block"), "rank", "total", "digest", *(m for m in members if m != "digest")
        )
        built = wanted.groupBy("tree", "block").applyInArrow(_build(self.levels, self.fanout, members), schema)
        return stage(built, "merkle")

    def roots(self) -> DataFrame:
        """The root of each tree."""
        found = [t.where(F.col("total") <= self.width).select("tree", "root") for t in self.tiers]
        whole = found[0]
        for other in found[1:]:
            whole = whole.union(other)
        return whole

    def with_paths(self, above: DataFrame | None = None) -> DataFrame:
        """The lowest blocks with the path above each of them; above: (of, path) above the roots."""
        paths = None
        for tier in reversed(self.tiers[1:]):
            schema = f"of {self.kind}, rank long, up {_PATH}"
            joined = self._joined(tier, paths, above).select("tree", "block", "total", "nodes", "above")
            paths = joined.mapInArrow(_paths(self.levels, self.fanout), schema)
        return self._joined(self.tiers[0], paths, above)

    def _joined(self, tier: DataFrame, paths: DataFrame | None, above: DataFrame | None) -> DataFrame:
        """Blocks of a tier with what stands above: from the next tier, or for a last block from `above`."""
        found = tier.withColumn("above", F.lit(None).cast(_PATH))
        if paths is not None:
            found = found.join(paths, found["tree"].eqNullSafe(paths["of"]) & (found["block"] == paths["rank"]), "left")
            found = found.withColumn("above", F.col("up")).drop("of", "rank", "up")
        if above is not None:
            last = found["tree"].eqNullSafe(above["of"]) & (found["total"] <= self.width)
            found = found.join(above, last, "left").withColumn("above", F.coalesce("above", "path")).drop("of", "path")
        return found

    def discard(self) -> None:
        discard(*self.tiers)


_RESULT = "doc_id {id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(levels: int, fanout: int, root: str):
    """Rows of the result from the lowest blocks, with proofs from the stored nodes."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _stored(row["nodes"], row["total"], row["block"], levels, fanout)
                above = [(s["place"], s["others"]) for s in row["above"] or []]
                high = b"".join(o for _, o in above)
                folded: dict[str, str] = {}
                proofs, roots = [], []
                for i, (digest, changed) in enumerate(zip(row["digest"], row["tampered"])):
                    path = block.path(i)
                    proofs.append(sha256(b"".join(o for _, o in path) + high).hexdigest())
                    top = fold(changed or digest, path)
                    if top not in folded:  # most leaves of a block come out at its root
                        folded[top] = fold(top, above)
                    roots.append(folded[top])
                n = block.leaves
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_id"], batch.schema.field("doc_id").type.value_type),
                        pa.array(row["digest"], pa.string()),
                        pa.array([row["subroot"]] * n, pa.string()),
                        pa.array([root] * n, pa.string()),
                        pa.array(proofs, pa.string()),
                        pa.array(roots, pa.string()),
                        pa.array([r == root for r in roots], pa.bool_()),
                    ],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return run


def leaves(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """The leaf of each row (tree: its source), and of its tampered form where tamper holds."""
    columns = {name: docs[name] for name in COLUMNS}
    lowered = F.translate(columns["text"].cast("string"), UPPER, LOWER)
    chosen = F.lit(False) if tamper is None else F.coalesce(tamper, F.lit(False))
    return docs.select(
        columns["source"].cast("string").alias("tree"),
        columns["doc_id"].alias("doc_id"),
        leaf(columns["text"], columns).alias("digest"),
        F.when(chosen, leaf(lowered, columns)).alias("tampered"),
    )


def manifest(docs: DataFrame, tamper: Column | None = None, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    tamper (a boolean column) marks rows whose text is lower-cased before it is held against the root.
    """
    listed = stage(leaves(docs, tamper), "merkle")
    ranked, placed = _ranked(listed, ["doc_id", "digest", "tampered"])
    sources = Forest(ranked, ["doc_id", "digest", "tampered"], levels, fanout)
    discard(listed, placed)
    roots = stage(sources.roots(), "merkle")
    tops = roots.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), F.col("root").alias("digest"))
    ranked, placed = _ranked(tops, ["source"])
    corpus = Forest(ranked, ["source"], levels, fanout)
    found = corpus.roots().first()
    root = found["root"] if found else ""
    paths = corpus.with_paths().select("block", "total", "nodes", "above", F.col("source").alias("sources"))
    kind = roots.schema["tree"].dataType.simpleString()
    above = stage(paths.mapInArrow(_source_paths(levels, fanout), f"of {kind}, path {_PATH}"), "merkle")
    lowest = sources.with_paths(above)
    subroots = roots.select(F.col("tree").alias("of"), F.col("root").alias("subroot"))
    whole = lowest.join(subroots, lowest["tree"].eqNullSafe(subroots["of"])).select(
        "block", "total", "nodes", "above", "doc_id", "digest", "tampered", "subroot"
    )
    return whole.mapInArrow(_proofs(levels, fanout, root), _RESULT.format(id=listed.schema["doc_id"].dataType.simpleString()))


def _source_paths(levels: int, fanout: int):
    """The path from each source's subroot to the root."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _stored(row["nodes"], row["total"], row["block"], levels, fanout)
                above = row["above"] or []
                paths = [[{"place": p, "others": o} for p, o in block.path(i)] + above for i in range(block.leaves)]
                kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.binary())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["sources"], batch.schema.field("sources").type.value_type), pa.array(paths, kind)], ["of", "path"]
                )

    return run


def manifest_of_documents(docs: DataFrame) -> DataFrame:
    """The manifest, checked against a copy in which every fifth id (by crc32) has a lower-cased text."""
    return manifest(docs, F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0)
