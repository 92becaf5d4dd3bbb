"""Byte-level BPE encoding and decoding with overlapping chunks.

Texts of up to `chunk_chars` are one chunk. Longer ones are cut into chunks that overlap the next
one by `overlap_chars`, and the chunks are pre-tokenised apart from each other, in any task. Two
neighbours agree from the first place in their overlap where both begin a pre-token and no white
space stands before it: the pattern looks one character ahead at most and never back, so from
there on both see the same pre-tokens. Neighbours that disagree in the overlap (a word longer than it) are
compared once more over the whole of the second chunk, where the text is the same from the first
shared beginning on. The pieces between such places are encoded apart from each other and joined in
order. Only a word that fills a whole chunk, so that its neighbour agrees nowhere, is put together with
all that follows in that text: which of the chunks behind it is right cannot be told from neighbours
alone. The result is exact for every text.

Decoding concatenates the bytes of the ids, piece by piece.

Edge cases. A missing text is empty and has no ids; an empty table gives no rows; repeated rows
are encoded apart; strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames
from tallymark.operators.staging import stage

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
_SPAN = 4096

_loaded: dict[tuple[str, str], tuple[tiktoken.Encoding, list[bytes]]] = {}


def load(path: str, pattern: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """Encoding and decimal ids of a rank file, once per process."""
    if (path, pattern) not in _loaded:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _loaded[path, pattern] = encoding, [b"%d" % i for i in range(max(ranks.values()) + 1)]
    return _loaded[path, pattern]


class Digest:
    """Running digests of the ids of one text and of the bytes that they decode to."""

    def __init__(self) -> None:
        self.ids, self.bytes, self.count = hashlib.sha256(), hashlib.sha256(), 0

    def add(self, ids: list[int], encoding: tiktoken.Encoding, decimal: list[bytes]) -> None:
        for at in range(0, len(ids), _SPAN):
            part = ids[at : at + _SPAN]
            self.ids.update((b" " if self.count else b"") + b" ".join([decimal[i] for i in part]))
            self.bytes.update(encoding.decode_bytes(part))
            self.count += len(part)

    def row(self) -> tuple[int, str, str]:
        return self.count, self.ids.hexdigest(), self.bytes.hexdigest()


def boundaries(text: str, pattern: regex.Pattern, low: int, high: int) -> list[int]:
    """Beginnings of pre-tokens in [low, high) that have no white space before them."""
    return [m.start() for m in pattern.finditer(text) if low <= m.start() < high and not (m.start() and text[m.start() - 1].isspace())]


def split(text: str, size: int, overlap: int) -> Iterator[tuple[int, str]]:
    for number, at in enumerate(range(0, max(1, len(text)), size)):
        yield number, text[at : at + size + overlap]


def stitch(found: list[int | None], size: int) -> Iterator[tuple[int, int, int, int]]:
    """Chunk, piece, begin and end of the parts of each chunk's first `size` characters.

    found has, for each chunk but the last, where its successor agrees with it, counted in the
    successor, or None. Behind the first None all is one piece.
    """
    piece = 0
    yield 0, 0, 0, size
    for chunk, begin in enumerate(found, 1):
        if begin is None or piece < chunk - 1:
            yield chunk, piece, 0, size
        else:
            if begin:
                yield chunk, piece, 0, begin
            piece = chunk
            yield chunk, piece, begin, size


def _encode_whole(path: str, pattern: str):
    def run(batches):
        encoding, decimal = load(path, pattern)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                digest = Digest()
                digest.add(encoding.encode_ordinary(text.as_py()), encoding, decimal)
                rows.append(digest.row())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES))], _NAMES
            )

    return run


_NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
_TYPES = (pa.int64(), pa.string(), pa.string())


def _chunk(pattern: str, size: int, overlap: int):
    def run(batches):
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                rows = list(split(text.as_py(), size, overlap))
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array([one.column("row")[0].as_py()] * len(rows), pa.int64()),
                        "doc_id": pa.array([one.column("doc_id")[0].as_py()] * len(rows), one.schema.field("doc_id").type),
                        "chunk": pa.array([n for n, _ in rows], pa.int32()),
                        "text": pa.array([t for _, t in rows], pa.string()),
                    }
                )

    return run


def _pretokenise(pattern: str, size: int, overlap: int):
    def run(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for text in batch.column("text"):
                found = boundaries(text.as_py(), compiled, 0, len(text.as_py()))
                heads.append([p for p in found if p < overlap])
                tails.append([p for p in found if p >= size])
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"),
                    "chunk": batch.column("chunk"),
                    "head": pa.array(heads, pa.list_(pa.int32())),
                    "tail": pa.array(tails, pa.list_(pa.int32())),
                }
            )

    return run


def _compare_whole(pattern: str, size: int):
    """Where the second of two chunks agrees with the first, looked for in all of the second."""

    def run(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            found = []
            for one, two in zip(batch.column("text").to_pylist(), batch.column("next").to_pylist()):
                own = {p - size for p in boundaries(one[:size] + two, compiled, size, 2 * size)}
                found.append(min(own.intersection(boundaries(two, compiled, 0, size)), default=None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(found, pa.int32())], ["row", "chunk", "later"]
            )

    return run


def _stitched(size: int):
    def run(table: pa.Table) -> pa.Table:
        found = [f for _, f in sorted(zip(table.column("chunk").to_pylist(), table.column("found").to_pylist()))]
        parts = list(stitch(found[:-1], size))
        columns = [pa.array([p[i] for p in parts], pa.int32()) for i in range(4)]
        row = pa.array([table.column("row")[0].as_py()] * len(parts), pa.int64())
        return pa.table([row, *columns], names=["row", "chunk", "piece", "begins", "ends"])

    return run


def _runs(batches, keys: tuple[str, ...]):
    """Rows of sorted batches with a mark where a new key begins."""
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            yield key != last, row
            last = key


def _encode_pieces(path: str, pattern: str):
    def run(batches):
        encoding, _ = load(path, pattern)

        def made(row, text):
            ids = pa.array(encoding.encode_ordinary(text), pa.int32())
            return pa.RecordBatch.from_pydict(
                {
                    "row": pa.array([row["row"]], pa.int64()),
                    "doc_id": pa.array([row["doc_id"]], id_type),
                    "piece": pa.array([row["piece"]], pa.int32()),
                    "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                }
            )

        parts, open_row, id_type = [], None, None

        def typed():
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("doc_id").type
                yield batch

        for new, row in _runs(typed(), ("row", "piece")):
            if new and open_row:
                yield made(open_row, "".join(parts))
                parts = []
            open_row = row
            parts.append(row["text"])
        if open_row:
            yield made(open_row, "".join(parts))

    return run


def _join_pieces(path: str, pattern: str):
    def run(batches):
        encoding, decimal = load(path, pattern)
        digest = owner = id_type = None

        def made():
            return pa.RecordBatch.from_arrays(
                [pa.array([owner], id_type), *(pa.array([v], t) for v, t in zip(digest.row(), _TYPES))], _NAMES
            )

        last = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for k in range(batch.num_rows):
                row = batch.column("row")[k].as_py()
                if row != last:
                    if digest:
                        yield made()
                    digest, owner, last = Digest(), batch.column("doc_id")[k].as_py(), row
                digest.add(batch.column("ids")[k].values.to_pylist(), encoding, decimal)
        if digest:
            yield made()

    return run


def encode_texts(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Number of ids per text, digest of the ids, digest of the bytes they decode to."""
    if not 0 < overlap_chars < chunk_chars:
        raise ValueError("the overlap must be shorter than a chunk")
    rows = docs.select(docs[id_column].alias("doc_id"), frames.plain_text(docs, text_column).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    result = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType())])
    result.add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())
    long = F.length("text") > chunk_chars
    whole = rows.where(~long).mapInArrow(_encode_whole(path, pattern), result)

    chunk_schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", id_type)])
    chunk_schema.add("chunk", T.IntegerType()).add("text", T.StringType())
    chunks = stage(
        rows.where(long)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(_chunk(pattern, chunk_chars, overlap_chars), chunk_schema),
        "bpe",
    )
    bounds = chunks.select("row", "chunk", "text").mapInArrow(
        _pretokenise(pattern, chunk_chars, overlap_chars), "row long, chunk int, head array<int>, tail array<int>"
    )
    in_order = Window.partitionBy("row").orderBy("chunk")
    head = F.lead("head").over(in_order)
    shared = F.array_min(F.array_intersect(F.transform("tail", lambda p: p - chunk_chars), head))
    pairs = stage(bounds.select("row", "chunk", shared.alias("found"), head.isNull().alias("last")), "bpe")
    # Few pairs are open. As a table of its own their list is known to be small before the texts are
    # planned, so that only the texts on it are shuffled.
    open_pairs = stage(pairs.where("found is null and not last").select("row", "chunk"), "bpe")
    sides = open_pairs.select("row", F.col("chunk").alias("first"), F.explode(F.array("chunk", F.col("chunk") + 1)).alias("chunk"))
    own = F.col("chunk") == F.col("first")
    later = (
        chunks.select("row", "chunk", "text")
        .join(sides, ["row", "chunk"])
        .groupBy("row", F.col("first").alias("chunk"))
        .agg(F.max(F.when(own, F.col("text"))).alias("text"), F.max(F.when(~own, F.col("text"))).alias("next"))
        .mapInArrow(_compare_whole(pattern, chunk_chars), "row long, chunk int, later int")
    )
    pieces = (
        pairs.join(later, ["row", "chunk"], "left")
        .select("row", "chunk", F.coalesce("found", "later").alias("found"))
        .groupBy("row")
        .applyInArrow(_stitched(chunk_chars), "row long, chunk int, piece int, begins int, ends int")
    )
    piece_schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", id_type)])
    piece_schema.add("piece", T.IntegerType()).add("ids", T.ArrayType(T.IntegerType()))
    encoded = (
        chunks.join(pieces, ["row", "chunk"])
        .select("row", "doc_id", "piece", "chunk", F.expr("substring(text, begins + 1, ends - begins)").alias("text"))
        .repartition("row", "piece")
        .sortWithinPartitions("row", "piece", "chunk")
        .mapInArrow(_encode_pieces(path, pattern), piece_schema)
    )
    joined = (
        encoded.repartition("row").sortWithinPartitions("row", "piece").mapInArrow(_join_pieces(path, pattern), result)
    )
    return whole.union(joined)
