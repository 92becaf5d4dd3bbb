"""K-d tree sharding by weighted medians.

The tree splits a node at the weighted median of its widest dimension and goes on until each leaf
holds the target bytes, the total divided by the number of shards. Widths are ranges relative to
the range of the whole table; among equally wide dimensions the first named is cut. Where a node
stands for an odd number of leaves it is cut at the matching quantile. Rows that share the value at
the cut are divided by a tie: a hash of the row, then a number that the row got when the table was
staged. So one hot source is split like any other rows, and so are equal rows.

Medians are found by rounds of histograms: Spark adds up the weights per node and bin, a few
hundred rows per node reach the driver, and the bin of the median is divided again until it weighs
next to nothing. All nodes of a level share each round, and each round reads only the staged
numbers, not the texts. There is no Python in the tasks.

Slots number the rows of a shard without gaps: rows are numbered inside hash buckets of bounded
size, and the buckets' counts are added up in order.

Edge cases. A missing text has size 1; missing dimension values count as 0; equal rows are spread
over shards like others, which of them goes where is not fixed; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames
from tallymark.operators.staging import stage

BINS = 512
SLOT_ROWS = 50_000
_LIMIT = 1 << 61
_TIE_BITS = 20  # of a tie: the part that tells equal rows apart
#: A cut may miss the median by this share of its node's weight.
_TOLERANCE = 1e-4


@dataclass
class _Node:
    """A node of the tree: how many leaves it stands for, and the search for its cut."""

    first: int
    leaves: int
    dim: int = 0
    goal: float = 0.0  # weight that goes left
    weight: float = 0.0
    value: int | None = None  # set when the search goes on among rows with this value
    low: int = 0
    high: int = 0
    below: float = 0.0
    cut: tuple[int, int] | None = None  # rows below (value, tie) go left
    left: int = field(default=0)


def _number(df: DataFrame, name: str) -> Column:
    column = df[name]
    if isinstance(df.schema[name].dataType, T.NumericType):
        value = F.least(F.greatest(column.cast("double"), F.lit(-float(_LIMIT))), F.lit(float(_LIMIT)))
        value = F.when(F.abs(column.cast("double")) < _LIMIT, column.cast("long")).otherwise(value.cast("long"))
    else:
        value = F.when(column.isNotNull(), F.shiftright(F.xxhash64(column.cast("string")), 2))
    return F.coalesce(value, F.lit(0))


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few literal rows, one per node of the tree."""
    names = [f.split()[0] for f in schema.split(", ")]
    casts = ", ".join(f"cast({n} as {t}) {n}" for n, t in (f.split() for f in schema.split(", ")))
    body = ", ".join("(" + ", ".join("null" if v is None else repr(v) for v in r) + ")" for r in rows)
    return F.broadcast(spark.sql(f"select {casts} from values {body} as t({', '.join(names)})"))


def _descend(rows: DataFrame, nodes: list[_Node]) -> DataFrame:
    """Send each row to the child of its node."""
    table = [(n.first, n.dim, *n.cut, n.first + n.left) for n in nodes if n.cut]
    if not table:
        return rows
    cuts = _values(rows.sparkSession, table, "node int, dim int, cut_value bigint, cut_tie bigint, right int")
    value = F.element_at("dims", F.col("dim") + 1)
    right = (value > F.col("cut_value")) | ((value == F.col("cut_value")) & (F.col("tie") >= F.col("cut_tie")))
    return rows.join(cuts, "node", "left").select(
        *[c for c in rows.columns if c != "node"], F.when(right, F.col("right")).otherwise(F.col("node")).alias("node")
    )


def _search(rows: DataFrame, nodes: list[_Node]) -> None:
    """Find the cuts of all nodes of a level, a histogram round at a time."""
    open_nodes = list(nodes)
    while open_nodes:
        steps = {n.first: (n.high - n.low) // BINS + 1 for n in open_nodes}
        table = [(n.first, n.dim, n.value, n.low, n.high, steps[n.first]) for n in open_nodes]
        state = _values(
            rows.sparkSession, table, "node int, dim int, value bigint, low bigint, high bigint, step bigint"
        )
        own = F.element_at("dims", F.col("dim") + 1)
        inside = rows.join(state, "node").withColumn("own", own).where("value is null or own = value")
        placed = inside.withColumn("at", F.when(F.col("value").isNull(), F.col("own")).otherwise(F.col("tie")))
        found = (
            placed.where("at between low and high")
            .withColumn("bin", F.expr("(at - low) div step"))
            .groupBy("node", "bin")
            .agg(F.sum("size").alias("weight"), F.min("at").alias("low"), F.max("at").alias("high"))
            .collect()
        )
        by_node: dict[int, list] = {}
        for r in found:
            by_node.setdefault(r["node"], []).append(r)
        still = []
        for n in open_nodes:
            for r in sorted(by_node[n.first], key=lambda r: r["bin"]):
                if n.below + r["weight"] >= n.goal:
                    break
                n.below += r["weight"]
            near = n.goal - n.below < r["weight"] / 2  # the cut before this bin is the closer one
            if r["weight"] <= _TOLERANCE * n.weight or (r["low"] == r["high"] and n.value is not None):
                edge = r["low"] if near else r["high"] + 1
                n.cut = (edge, -_LIMIT) if n.value is None else (n.value, edge)
            elif r["low"] == r["high"]:
                n.value, n.low, n.high = r["low"], -_LIMIT, _LIMIT
                still.append(n)
            else:
                n.low, n.high = r["low"], r["high"]
                still.append(n)
        open_nodes = still


def leaves(rows: DataFrame, shards: int, dims: int) -> DataFrame:
    """Move each row of (dims, tie, size, node), all of node 0, to its leaf, 0 to shards - 1."""
    level = [_Node(0, shards)]
    widths: list[int] | None = None
    while any(n.leaves > 1 for n in level):
        at = [F.element_at("dims", k + 1) for k in range(dims)]
        stats = rows.groupBy("node").agg(
            F.sum("size").alias("weight"),
            F.array(*[F.min(a) for a in at]).alias("low"),
            F.array(*[F.max(a) for a in at]).alias("high"),
        )
        stats = {r["node"]: r for r in stats.collect()}
        if widths is None and stats:
            widths = [max(1, b - a) for a, b in zip(stats[0]["low"], stats[0]["high"])]
        todo = [n for n in level if n.leaves > 1 and n.first in stats]
        for n in todo:
            low, high, n.weight = stats[n.first]["low"], stats[n.first]["high"], float(stats[n.first]["weight"])
            n.dim = max(range(dims), key=lambda k: ((high[k] - low[k]) / widths[k], -k))
            n.low, n.high, n.left = low[n.dim], high[n.dim], (n.leaves + 1) // 2
            n.goal = n.weight * n.left / n.leaves
        _search(rows, todo)
        rows = _descend(rows, todo)
        level = [
            c
            for n in level
            for c in (
                [n]
                if n.leaves == 1 or not n.cut
                else [_Node(n.first, n.left), _Node(n.first + n.left, n.leaves - n.left)]
            )
            if n.leaves == 1 or n.cut
        ]
    return rows


def shard_texts(
    docs: DataFrame,
    shards: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
    dimensions: tuple[str, ...] = ("source", "lang", "doc_id"),
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Rows of doc_id, size, text_crc32, law, shard, slot, grown_shard. The size is a dimension too."""
    text = frames.plain_text(docs, text_column)
    size = (F.octet_length(text) + 1).cast("long")
    crc = F.crc32(text.cast("binary"))
    dims = [*[_number(docs, name) for name in dimensions], size]
    of_row = F.shiftright(F.xxhash64(docs[id_column], size, crc), _TIE_BITS + 2) * (1 << _TIE_BITS)
    of_place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << _TIE_BITS))
    rows = stage(
        docs.select(
            docs[id_column].alias("doc_id"),
            size.alias("size"),
            crc.alias("text_crc32"),
            F.array(*dims).alias("dims"),
            (of_row + of_place).alias("tie"),
            F.lit(0).alias("node"),
        ),
        "sharding",
    )
    placed = leaves(rows, shards, len(dims)).withColumnRenamed("node", "shard")
    buckets = max(1, -(-rows.count() // (shards * slot_rows)))
    placed = placed.withColumn("bucket", F.pmod("tie", F.lit(buckets)))
    per_bucket = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = "sum(n) over (partition by shard order by bucket rows between unbounded preceding and 1 preceding)"
    offsets = per_bucket.select("shard", "bucket", F.expr(f"coalesce({before}, 0)").alias("offset"))
    order = "row_number() over (partition by shard, bucket order by tie, doc_id, size)"
    return (
        placed.withColumn("rank", F.expr(order))
        .join(offsets, ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
