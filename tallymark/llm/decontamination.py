"""Benchmark decontamination with spaced seeds.

A mask is a fixed pattern of token positions, some of which it ignores. The tokens under a mask are
hashed at every position of the benchmark items and of the documents; equal hashes put an item
beside a document at one offset, whatever stands at the ignored positions. Around each such hit
the tokens of both are compared along the offset: the stretch with the best sum of +1 per equal and
-2 per other token is the overlap, so scattered substitutions are tolerated. The masks are light enough
that substitutions scattered over such an overlap leave a hit. An item leaks into a
document if the overlap has at least `min_share` of its tokens, or `enough_tokens` of them.

How it is spread. One pass over the whole texts, no shuffle. The hashes of the items are broadcast;
their size is checked first, and beyond `slice_bytes` of item text the items are taken in slices of
that size, each with its own pass, so memory stays bounded for any benchmark.

Edge cases. Items shorter than the masks are matched whole; items without words match nothing; equal
items are searched once and reported each; a missing text has no words; empty tables give no rows;
repeated rows are reported each; hits of long and repetitive texts are expanded and compared in steps of
bounded size; other columns pass through `clean` untouched and do not reach `contaminated`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames, packed, words

#: Token positions that count (1) and that are ignored (0).
MASKS = ("1111", "111011", "11011011")
MIN_SHARE = 0.7
ENOUGH_TOKENS = 40
SLICE_BYTES = 4 << 20
_MISS = -2
_FILTER_BITS = 22
_EXPAND = 1 << 20  # hits or places in memory at a time
_STEP = np.uint64(0xA0761D6478BD642F)


def _seed(mask: str) -> tuple[np.ndarray, np.uint64]:
    return np.flatnonzero(np.frombuffer(mask.encode(), np.uint8) == ord("1")), np.uint64(len(mask) * 2654435761 + int(mask, 2))


def masked(hashes: np.ndarray, text: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens under the mask at every place inside one text, and the places."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(text[:n] == text[len(mask) - 1 :])
    places, salt = _seed(mask)
    total = np.full(len(at), salt)
    for k in places:
        total = total * _STEP + hashes[at + k]
    return words.mix(total), at


@dataclass
class Index:
    """Seeds of a slice of items, sorted, with the item and the place that each comes from."""

    tokens: np.ndarray
    firsts: np.ndarray
    lengths: np.ndarray
    masks: list[str]
    seeds: np.ndarray
    items: np.ndarray
    places: np.ndarray
    filter: np.ndarray

    @staticmethod
    def build(texts: list[str]) -> Index:
        (part,) = words.slices(pa.array(texts, pa.string()), 1 << 62)
        w = words.words(part, lower=True)
        longest = min(map(len, MASKS))
        short = sorted({int(n) for n in w.counts if 0 < n < longest})
        masks = [*MASKS, *("1" * n for n in short)]
        parts = []
        for mask in masks:
            seeds, at = masked(w.hashes, w.text, mask)
            if len(mask) < longest:  # whole items only
                whole = w.counts[w.text[at]] == len(mask)
                seeds, at = seeds[whole], at[whole]
            parts.append((seeds, w.text[at], at - w.firsts[w.text[at]]))
        seeds, items, places = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(seeds, kind="stable")
        bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
        bits[seeds >> np.uint64(64 - _FILTER_BITS)] = True
        return Index(w.hashes, w.firsts, w.counts, masks, seeds[order], items[order], places[order], bits)

    def hits(self, w: words.Words) -> np.ndarray:
        """Distinct rows of text number, item number, offset of the item in the text.

        Seeds that many places share are expanded in steps of bounded size, each made distinct.
        """
        longest = int(self.lengths.max(initial=0))
        span = longest + int(w.counts.max(initial=0)) + 1
        found = np.zeros(0, np.int64)
        for mask in self.masks:
            seeds, at = masked(w.hashes, w.text, mask)
            maybe = self.filter[seeds >> np.uint64(64 - _FILTER_BITS)]
            seeds, at = seeds[maybe], at[maybe]
            low = np.searchsorted(self.seeds, seeds, "left")
            closes = np.cumsum(np.searchsorted(self.seeds, seeds, "right") - low)
            opens = np.concatenate(([0], closes[:-1])) if len(closes) else closes
            for first in range(0, int(closes[-1]) if len(closes) else 0, _EXPAND):
                number = np.arange(first, min(first + _EXPAND, int(closes[-1])))
                seed = np.searchsorted(closes, number, "right")
                entry = low[seed] + number - opens[seed]
                text = w.text[at[seed]]
                offset = at[seed] - w.firsts[text] - self.places[entry]
                codes = (text.astype(np.int64) * len(self.lengths) + self.items[entry]) * span + offset + longest
                found = np.union1d(found, codes)
        pair, offset = np.divmod(found, span)
        return np.stack((*np.divmod(pair, max(1, len(self.lengths))), offset - longest), 1)

    def overlaps(self, w: words.Words, hits: np.ndarray) -> np.ndarray:
        """For each hit the equal tokens, first word in the text and length of the best stretch at its offset."""
        out = np.zeros((len(hits), 3), np.int64)
        order = np.argsort(hits[:, 1], kind="stable")
        cuts = np.flatnonzero(np.diff(hits[order, 1], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            item = int(hits[order[a], 1])
            m = int(self.lengths[item])
            tokens = self.tokens[self.firsts[item] : self.firsts[item] + m]
            step = max(1, _EXPAND // m)
            for first in range(a, b, step):
                rows = order[first : min(first + step, b)]
                out[rows] = _best(w, tokens, hits[rows, 0], hits[rows, 2])
        return out

    def overlap(self, w: words.Words, text: int, item: int, offset: int) -> tuple[int, int, int]:
        """The same of one hit."""
        return tuple(self.overlaps(w, np.array([[text, item, offset]]))[0].tolist())


def _best(w: words.Words, tokens: np.ndarray, text: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Best stretches of an item's tokens laid over texts at offsets; places outside a text are unequal."""
    place = offset[:, None] + np.arange(len(tokens))
    inside = (place >= 0) & (place < w.counts[text][:, None])
    same = inside & (w.hashes[np.where(inside, w.firsts[text][:, None] + place, 0)] == tokens)
    gain = np.zeros((len(text), len(tokens) + 1), np.int32)
    np.cumsum(np.where(same, 1, _MISS), axis=1, out=gain[:, 1:])
    floor = np.minimum.accumulate(gain, axis=1)
    end = np.argmax(gain - floor, axis=1)
    column, row = np.arange(len(tokens) + 1), np.arange(len(text))
    low = (gain == floor[row, end][:, None]) & (column <= end[:, None])
    begin = len(tokens) - np.argmax(low[:, ::-1], axis=1)
    misses = ((end - begin) - (gain[row, end] - gain[row, begin])) // (1 - _MISS)
    return np.stack((end - begin - misses, offset + begin, end - begin), 1)


def leaks(index: Index, texts: words.Texts, min_share: float, enough: int) -> list[tuple[int, int, int, int, int]]:
    """Per text and item that leaks into it: text, item, first word, length, equal tokens of the best overlap."""
    w = words.words(texts, lower=True)
    hits = index.hits(w)
    found = index.overlaps(w, hits)
    good = found[:, 0] >= np.minimum(min_share * index.lengths[hits[:, 1]], enough)
    text, item = hits[good, :2].T
    equal, first, length = found[good].T
    order = np.lexsort((-length, first, -equal, item, text))  # the best of each text and item comes first
    keys = np.stack((text, item), 1)[order]
    head = np.flatnonzero(np.any(np.diff(keys, axis=0, prepend=-1), axis=1))
    return np.stack((text, item, first, length, equal), 1)[order[head]].tolist()


def _slices(items: DataFrame, id_column: str, text_column: str, slice_bytes: int):
    """Broadcasts of an index and of the ids of each distinct text, one per slice of the items."""
    spark = items.sparkSession
    rows = items.select(items[id_column].alias("item_id"), frames.plain_text(items, text_column).alias("text"))
    _, size = frames.text_bytes(rows)
    slices = max(1, -(-size // slice_bytes))
    for k in range(slices):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == k).collect()
        by_text: dict[str, list] = {}
        for row in part:
            by_text.setdefault(row["text"], []).append(row["item_id"])
        if by_text:
            yield spark.sparkContext.broadcast((Index.build(list(by_text)), list(by_text.values())))


def _report(shared, min_share: float, enough: int, item_type: pa.DataType):
    def run(batches):
        index, ids = shared.value
        for batch in batches:
            for texts in words.slices(batch.column("text")):
                found = leaks(index, texts, min_share, enough)
                rows = [(texts.first + t, i, int(index.lengths[k]), a, b, c) for t, k, a, b, c in found for i in ids[k]]
                take = pa.array([r[0] for r in rows], pa.int64())
                types = (item_type, pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), *(pa.array([r[i + 1] for r in rows], t) for i, t in enumerate(types))],
                    ["doc_id", "item_id", "item_words", "first_word", "overlap_words", "equal_words"],
                )

    return run


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    min_share: float = MIN_SHARE,
    enough_tokens: int = ENOUGH_TOKENS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per document and item that leaks into it, with the best overlap."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(docs[id_column].alias("doc_id"), frames.plain_text(docs, text_column).alias("text"))
    item_type = items.schema[item_column].dataType
    schema = T.StructType([rows.schema["doc_id"], T.StructField("item_id", item_type)])
    for name in ("item_words", "first_word", "overlap_words", "equal_words"):
        schema.add(name, T.LongType())
    result = docs.sparkSession.createDataFrame([], schema)
    for shared in _slices(items, item_column, item_text_column, slice_bytes):
        result = result.union(
            rows.mapInArrow(_report(shared, min_share, enough_tokens, to_arrow_type(item_type)), schema)
        )
    return result


def _keep(shared, text_column: str, min_share: float, enough: int):
    def run(batches):
        index, _ = shared.value
        for batch in batches:
            good = np.ones(batch.num_rows, dtype=bool)
            for texts in words.slices(batch.column(text_column)):
                for row in leaks(index, texts, min_share, enough):
                    good[texts.first + row[0]] = False
            yield batch.filter(pa.array(good))

    return run


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    min_share: float = MIN_SHARE,
    enough_tokens: int = ENOUGH_TOKENS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The documents that no item leaks into; same columns."""
    for shared in _slices(items, item_column, item_text_column, slice_bytes):
        docs = docs.mapInArrow(_keep(shared, text_column, min_share, enough_tokens), docs.schema)
    return docs
