"""Line deduplication with a segment-partition edit join.

Lines are compared in a normal form: A-Z lower-cased, white space to one space. Two lines of
`min_chars` code points or more are near if at most `edits` edits lie between them; shorter lines
only if they are equal. Near lines form classes; the first line of a class (smallest id, then place)
stays and all others are removed. Lines without words are left alone.

The join (after Li et al., Pass-Join, 2011). A line is split into edits + 1 segments; if two lines are
near, one of them holds a segment of the other unchanged, not far from its place. Each line lists
its segments, and for every length down to `edits` less, the few substrings that could be such a
segment (multi-match aware). Equal hashes of segment and substring give candidates; those
whose parities of code points and of adjacent pairs allow it are verified by banded bit-parallel edit distance over the full lines.

Only classes are asked for, so candidates are verified in two rounds: first each line against the
smallest line of its hash, then, between classes that still differ, all candidates. A group of
thousands of near copies is connected by the first round without listing its pairs.

How it is spread. Hashes go to buckets in sorted, packed lists; the number of buckets grows with the
input. Joins are plain equi-joins that skew handling can split. Texts are shuffled once, and only to
fetch candidates, chosen by a bitmap of their keys that the tasks get.

Edge cases. A missing text has no lines; repeated rows are told apart by their place in the input; ties
cannot occur; an empty table gives no rows; other columns pass through `filtered`. `filtered` drops
documents that had words and have none left, since earlier documents hold all they said.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames, links, packed, words
from tallymark.llm.edit_distance import within
from tallymark.operators.staging import discard, stage

EDITS = 2
MIN_CHARS = 24
BUCKET_ENTRIES = 1_500_000
_FLUSH_CHARS = 1 << 20
_SEEN = 500_000
_PIECE_BITS = 1 << 15  # of Spark's bitmaps
_BITS_PER_LINE = 16
_MOST_BITS = 1 << 26


def normal_lines(text: bytes):
    """Number, key and normal form of each line that has a word."""
    for number, line in enumerate(text.lower().split(b"\n")):
        normal = b" ".join(line.split())
        if normal:
            yield number, xxhash.xxh3_64_intdigest(normal) - (1 << 63), normal


def seeds(lines: list[np.ndarray], edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of segments (side 0) and of the substrings that probe for them (side 1), with line numbers."""
    data = np.concatenate(lines)
    length = np.array([len(x) for x in lines], dtype=np.int64)
    first = np.cumsum(length) - length
    power, inverse = words._power_tables(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.mix(data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], dtype=np.uint64)))
    parts = edits + 1

    def hashed(start, size, of_length, part):
        s = first + start
        value = (sums[s + size] - sums[s]) * inverse[s]
        return words.mix(value + (of_length * parts + part).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    number = np.arange(len(lines))
    found = []
    for gap in range(edits + 1):
        other = length - gap  # length of the line whose segment is sought
        short, longer = other // parts, other % parts
        for part in range(parts):
            size = short + (part >= parts - longer)
            place = part * short + np.maximum(0, part - (parts - longer))
            if gap == 0:
                found.append((hashed(place, size, other, part), number, 0))
            low = max(-part, gap - (edits - part))
            high = min(part, gap + (edits - part))
            for shift in range(low, high + 1):
                start = place + shift
                fits = (start >= 0) & (start + size <= length)
                value = hashed(np.clip(start, 0, length - size), size, other, part)
                found.append((value[fits], number[fits], 1))
    side = np.concatenate([np.full(len(v), s, dtype=np.uint32) for v, _, s in found])
    return np.concatenate([v for v, _, _ in found]), np.concatenate([n for _, n, _ in found]), side


def parities(points: np.ndarray) -> int:
    """For each of 64 classes of code points, whether an odd number of them stands in the line.

    An edit turns two bits at most, so near lines differ in at most 2 * edits bits.
    """
    odd = np.bincount(points & np.uint32(63), minlength=64) & 1
    return int(np.packbits(odd.astype(np.uint8)).view(">u8")[0])


def pair_parities(points: np.ndarray) -> np.ndarray:
    """The same for 128 classes of adjacent code points, as two numbers; an edit turns four bits at most."""
    adjacent = points[:-1].astype(np.uint64) * np.uint64(0x110000) + points[1:]
    odd = np.bincount((words.mix(adjacent) >> np.uint64(57)).astype(np.int64), minlength=128) & 1
    return np.packbits(odd.astype(np.uint8)).view(">i8")


def _texts(batches):
    for batch in batches:
        for texts in words.slices(batch.column("text")):
            for i in range(texts.count):
                yield texts.raw(i)


def _unseen(batches, least: int, seen_limit: int = _SEEN, wanted=None):
    """Key and normal form of (wanted) lines that this task has not met lately."""
    seen: set[int] = set()
    for text in _texts(batches):
        for _, key, normal in normal_lines(text):
            if key not in seen and len(normal) >= least and (wanted is None or wanted(key)):
                if len(seen) >= seen_limit:
                    seen.clear()
                seen.add(key)
                yield key, normal


def _code_points(normal: bytes) -> np.ndarray:
    return np.frombuffer(normal.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)


def _seed_lists(buckets: int, edits: int, min_chars: int):
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=np.uint64)

    def flush(keys, lines):
        keys = np.array(keys, dtype=np.int64)
        hashes, number, side = seeds(lines, edits)
        marks_of = np.array([parities(x) for x in lines], dtype=np.uint64)
        order = np.argsort(hashes)
        hashes, owner = hashes[order], (number[order].astype(np.uint32) << np.uint32(1)) | side[order]
        cuts = [0, *np.searchsorted(hashes, edges), len(hashes)]
        rows = []
        for bucket in range(buckets):
            a, b = cuts[bucket], cuts[bucket + 1]
            if b > a:
                used, index = np.unique(owner[a:b] >> np.uint32(1), return_inverse=True)
                marks = (index.astype(np.uint32) << np.uint32(1)) | (owner[a:b] & np.uint32(1))
                rows.append((bucket, packed.pack_sorted(hashes[a:b]), packed.pack(marks), packed.pack(keys[used]), packed.pack(marks_of[used])))
        types = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["bucket", "hashes", "owners", "lines", "parities"]
        )

    def run(batches):
        keys, lines, held = [], [], 0
        for key, normal in _unseen(batches, min_chars):
            points = _code_points(normal)
            if len(points) < min_chars:
                continue
            keys.append(key)
            lines.append(points)
            held += len(points)
            if held >= _FLUSH_CHARS:
                yield flush(keys, lines)
                keys, lines, held = [], [], 0
        if keys:
            yield flush(keys, lines)

    return run


def _meetings(table: pa.Table) -> pa.Table:
    """Seeds on both sides of which different lines stand, with those lines."""
    hashes, lines, sides, odd = [], [], [], []
    for h, o, k, p in zip(*(table.column(c).to_pylist() for c in ("hashes", "owners", "lines", "parities"))):
        owner = packed.unpack(o, np.uint32)
        odd.append(packed.unpack(p, np.int64)[owner >> np.uint32(1)])
        hashes.append(packed.unpack_sorted(h))
        lines.append(packed.unpack(k, np.int64)[owner >> np.uint32(1)])
        sides.append((owner & np.uint32(1)).astype(np.int32))
    hashes, lines, sides, odd = (np.concatenate(x) for x in (hashes, lines, sides, odd))
    order = np.lexsort((lines, hashes))
    hashes, lines, sides, odd = hashes[order], lines[order], sides[order], odd[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    size = np.diff(np.concatenate((first, [len(hashes)])))
    several = lines[first] != lines[first + size - 1]
    ones = np.add.reduceat(sides, first)
    several &= (ones > 0) & (ones < size)
    pick = np.repeat(several, size)
    return pa.table(
        {"seed": hashes[pick].view(np.int64), "line": lines[pick], "side": sides[pick], "parities": odd[pick]}
    )


def _bitmap(lines: DataFrame) -> tuple[bytes, int]:
    """Bits set at the lowest bits of the keys of these lines, and the number of bits.

    Spark sets them, in pieces of 4096 bytes; no more than `_MOST_BITS` bits reach the driver.
    """
    count = lines.agg(F.approx_count_distinct("line")).first()[0]
    bits = min(_MOST_BITS, max(_PIECE_BITS, 1 << (_BITS_PER_LINE * count).bit_length()))
    place = F.col("line").bitwiseAND(F.lit(bits - 1).cast("long"))
    pieces = (
        lines.groupBy(F.shiftright(place, _PIECE_BITS.bit_length() - 1).cast("int").alias("piece"))
        .agg(F.bitmap_construct_agg((place % _PIECE_BITS).cast("long")).alias("bits"))
        .collect()
    )
    whole = bytearray(bits // 8)
    for piece, part in pieces:
        whole[piece * _PIECE_BITS // 8 : (piece + 1) * _PIECE_BITS // 8] = part
    return bytes(whole), bits


def _fetch(min_chars: int, bitmap, bits: int):
    """Lines whose place in the bitmap is set: all that are wanted, and a few others."""

    def run(batches):
        marks = bitmap.value
        keys, texts, held = [], [], 0
        for key, normal in _unseen(batches, min_chars, wanted=lambda k: marks[(k & (bits - 1)) >> 3] >> (k & 7) & 1):
            keys.append(key)
            texts.append(normal.decode("utf-8", "replace"))
            held += len(normal)
            if held >= _FLUSH_CHARS:
                yield pa.RecordBatch.from_pydict({"line": pa.array(keys, pa.int64()), "normal": pa.array(texts, pa.string())})
                keys, texts, held = [], [], 0
        yield pa.RecordBatch.from_pydict({"line": pa.array(keys, pa.int64()), "normal": pa.array(texts, pa.string())})

    return run


def _sign(batches):
    for batch in batches:
        marks = [pair_parities(_code_points(x.encode())) for x in batch.column("normal").to_pylist()]
        sides = [pa.array([int(m[k]) for m in marks], pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *sides], ["line", "normal", "pairs_0", "pairs_1"])


def _verify(edits: int):
    def run(batches):
        for batch in batches:
            good = []
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sides = [
                    [_code_points(x.encode()) for x in part.column(c).to_pylist()] for c in ("normal_a", "normal_b")
                ]
                good.append(within(*sides, edits))
            mask = pa.array(np.concatenate(good) if good else np.zeros(0, dtype=bool))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(mask)

    return run


def _near(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    normal = texts.select("line", "normal")
    joined = pairs.join(normal.toDF("a", "normal_a"), "a").join(normal.toDF("b", "normal_b"), "b")
    return stage(joined.mapInArrow(_verify(edits), "a long, b long"), "lines")


def line_classes(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, bucket_entries: int = BUCKET_ENTRIES
) -> DataFrame:
    """Label of every line that is near another one, from a frame with a text column."""
    _, size = frames.text_bytes(docs)
    seeds_per_byte = (edits + 1) * (edits + 2) / 100
    buckets = max(1, int(size * seeds_per_byte / bucket_entries) + 1)
    rows = docs.select(frames.plain_text(docs).alias("text"))
    lists = rows.mapInArrow(
        _seed_lists(buckets, edits, min_chars), "bucket int, hashes binary, owners binary, lines binary, parities binary"
    )
    met = stage(lists.groupBy("bucket").applyInArrow(_meetings, "seed long, line long, side int, parities long"), "lines")
    # A line is asked for if it met another; the texts of others stay where they are. The few that pass
    # the bitmap unasked cost their shuffle and meet nothing in the joins below.
    bitmap, bits = _bitmap(met.select("line"))
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    texts = rows.mapInArrow(_fetch(min_chars, sent, bits), "line long, normal string")
    signed = "line long, normal string, pairs_0 long, pairs_1 long"
    texts = stage(texts.dropDuplicates(["line"]).mapInArrow(_sign, signed), "lines")
    sent.destroy()

    def differing(name: str):
        return F.bit_count(F.col(f"{name}_a").bitwiseXOR(F.col(f"{name}_b")))

    alike = differing("parities") <= 2 * edits
    pivots = met.groupBy("seed").agg(F.min(F.struct("line", "parities")).alias("p"))
    pivots = pivots.select("seed", F.col("p.line").alias("a"), F.col("p.parities").alias("parities_a"))
    paired = met.withColumnRenamed("parities", "parities_b").join(pivots, "seed").where(alike)
    first = _near(paired.select("a", F.col("line").alias("b")), texts, edits)
    labels = links.components(first)
    named = met.join(labels.withColumnRenamed("node", "line"), "line", "left")
    named = named.withColumn("label", F.coalesce("label", "line"))
    open_seeds = named.groupBy("seed").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    named = named.join(open_seeds.where("low <> high").select("seed"), "seed")
    named = named.join(texts.drop("normal"), "line")
    columns = ("line", "label", "parities", "pairs_0", "pairs_1")
    segments, probes = (
        named.where(F.col("side") == k).select("seed", *[F.col(c).alias(f"{c}_{n}") for c in columns])
        for k, n in enumerate("ab")
    )
    alike &= differing("pairs_0") + differing("pairs_1") <= 4 * edits
    pairs = segments.join(probes, "seed").where(alike & (F.col("label_a") != F.col("label_b")))
    second = _near(pairs.select(F.col("line_a").alias("a"), F.col("line_b").alias("b")), texts, edits)
    classes = links.components(first.union(second)).withColumnRenamed("node", "line")
    discard(met, texts, first, second)
    return classes


def _list_lines(batches):
    for batch in batches:
        numbers, keys = [], []
        for text in _texts([batch]):
            found = [(n, k) for n, k, _ in normal_lines(text)]
            numbers.append([n for n, _ in found])
            keys.append([k for _, k in found])
        columns = {name: batch.column(name) for name in ("row", "kept_row")}
        columns["numbers"] = pa.array(numbers, pa.list_(pa.int32()))
        columns["keys"] = pa.array(keys, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_pydict(columns)


def _marked(docs: DataFrame, id_column: str, text_column: str, keep: list[str], edits: int, min_chars: int) -> DataFrame:
    """Documents (as kept_row) with their line numbers and those of the lines to remove."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        frames.plain_text(docs, text_column).alias("text"),
        F.struct(docs[id_column].alias("_id"), *[docs[c].alias(f"c_{c}") for c in keep]).alias("kept_row"),
    )
    schema = T.StructType([rows.schema["row"], rows.schema["kept_row"]])
    schema.add("numbers", T.ArrayType(T.IntegerType())).add("keys", T.ArrayType(T.LongType()))
    listed = stage(rows.mapInArrow(_list_lines, schema), "lines")
    labels = line_classes(docs.select(docs[text_column].alias("text")), edits, min_chars)
    lines = listed.select(
        "row", F.col("kept_row._id").alias("id"), F.explode(F.arrays_zip("numbers", "keys")).alias("l")
    ).select("row", "id", F.col("l.numbers").alias("number"), F.col("l.keys").alias("line"))
    lines = lines.join(labels, "line", "left").withColumn("label", F.coalesce("label", "line"))
    place = F.struct(F.col("id").isNull(), "id", "row", "number")
    firsts = lines.groupBy("label").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select("label", F.col("first.row").alias("first_row"), F.col("first.number").alias("first_number"))
    gone = (
        lines.join(firsts, "label")
        .where((F.col("row") != F.col("first_row")) | (F.col("number") != F.col("first_number")))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("number")).alias("removed_lines"))
    )
    empty = F.array().cast("array<int>")
    return listed.join(gone, "row", "left").withColumn("removed_lines", F.coalesce("removed_lines", empty))


def report(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """One row per document: lines with words, how many of them go, and their numbers from 0."""
    marked = _marked(docs, id_column, text_column, [], edits, min_chars)
    return marked.select(
        F.col("kept_row._id").alias("doc_id"),
        F.size("numbers").cast("long").alias("n_lines"),
        F.size("removed_lines").cast("long").alias("n_removed"),
        "removed_lines",
    )


def _cut(batches):
    for batch in batches:
        out = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("removed_lines").to_pylist()):
            if gone:
                gone = set(gone)
                text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("kept_row"), pa.array(out, pa.string())], ["kept_row", "text"])


def filtered(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """The documents without repeated lines; same columns."""
    marked = _marked(docs, id_column, text_column, docs.columns, edits, min_chars)
    left = marked.where((F.size("numbers") == 0) | (F.size("removed_lines") < F.size("numbers")))
    rows = left.select("kept_row", F.col("kept_row")[f"c_{text_column}"].cast("string").alias("text"), "removed_lines")
    schema = T.StructType([rows.schema["kept_row"], T.StructField("text", T.StringType())])
    cut = rows.mapInArrow(_cut, schema)
    return cut.select(
        *[F.col("text").alias(c) if c == text_column else F.col("kept_row")[f"c_{c}"].alias(c) for c in docs.columns]
    )
