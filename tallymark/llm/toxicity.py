"""Toxicity by compression distance.

Two zstandard dictionaries of one size are trained on a bounded sample of labelled texts, one on the
windows of ordinary texts, one on those of toxic texts. By themselves they find few toxic texts, as
most of a toxic text is ordinary. So a third one, the marked dictionary, holds the bytes of the
ordinary one at the same distance and, in front, the passages that mark toxic texts: pieces of words
that are common in toxic texts and all but absent from ordinary ones, taken greedily, each explaining
words that no earlier one explains, and lengthened as long as the texts agree on what follows. A
window that gets shorter under it than under the ordinary one repeats a toxic passage.

Every window of `window_words` words (half overlapping, to the end of the text) is compressed with
all three. A text has three figures: the sum of the gains of the marked dictionary over the ordinary
one, the largest of these, and the mean difference between the two trained dictionaries, which does
not grow with length. A logistic curve fitted on the sample, weighted to the share of toxic labels,
turns them into a score between 0 and 1. The mean differences of the sample come from dictionaries
trained on its other half, as a dictionary knows its own texts too well. Without marking passages
the trained dictionaries decide alone.

How it is spread. The sample is the `sample_rows` ids of each label with the smallest hash, texts of up to
`sample_bytes` only. Ids and lengths are joined with the labels, and only the texts of the chosen ids (at most
2 x `sample_rows` x `sample_bytes`) reach the driver; no other text is shuffled. Scoring is one pass over all
whole texts without any shuffle, and the dictionaries (about 200 KB) travel with the tasks.

Edge cases. A missing or empty text has no gain and gets the score of texts without gain. Repeated
labels count as often as they stand in the share of toxic labels; an id with several texts gives the least
one to the sample. If the sample lacks toxic or ordinary texts, every score is the
share of toxic labels (0 without labels). Empty tables give no rows; other columns are no inputs.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames, words

WINDOW_WORDS = 24
DICTIONARY_BYTES = 65_536
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 20_000
LEVEL = 9
THRESHOLD = 0.3
_PIECES = (5, 6, 7, 8, 10)
_MIN_SHARE = 0.05
_MIN_ODDS = 3.0
_LONGEST = 24


def windows(text: bytes, size: int):
    """Half overlapping runs of size words, the last one ending with the text."""
    found = words.LOWER[np.frombuffer(text, dtype=np.uint8)].tobytes().split()
    at = 0
    while found:
        yield b" " + b" ".join(found[at : at + size]) + b" "
        if at + size >= len(found):
            return
        at = min(at + size // 2, len(found) - size)


def _document_counts(texts: list[bytes]) -> Counter:
    return Counter(w for t in set(texts) for w in set(words.LOWER[np.frombuffer(t, dtype=np.uint8)].tobytes().split()))


def toxic_passages(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Pieces of words that mark toxic texts, the most telling first."""
    in_toxic, in_ordinary = _document_counts(toxic), _document_counts(ordinary)
    n, m = len(set(toxic)), len(set(ordinary))

    def gain(a: int, b: int) -> float:
        odds = math.log((a + 0.5) / n) - math.log((b + 0.5) / m)
        return a * odds if odds > _MIN_ODDS and a >= max(8, _MIN_SHARE * n) else 0.0

    counts: dict[bytes, list[int]] = defaultdict(lambda: [0, 0])
    holders: dict[bytes, list[bytes]] = defaultdict(list)
    for side, found in enumerate((in_toxic, in_ordinary)):
        for word, k in found.items():
            framed = b" " + word + b" "
            for piece in {framed[i : i + s] for s in _PIECES for i in range(len(framed) - s + 1)}:
                if side == 0 or piece in counts:
                    counts[piece][side] += k
                    if side == 0:
                        holders[piece].append(word)
    heap = [(-gain(*c), p) for p, c in counts.items() if gain(*c) > 0]
    heapq.heapify(heap)
    left, chosen = dict(in_toxic), []
    while heap:
        _, piece = heapq.heappop(heap)
        now = gain(sum(left.get(w, 0) for w in holders[piece]), counts[piece][1])
        if now <= 0:
            continue
        if heap and -now > heap[0][0]:
            heapq.heappush(heap, (-now, piece))
            continue
        for word in holders[piece]:
            left.pop(word, None)
        chosen.append(_lengthened(piece, holders[piece], in_toxic))
    return chosen


def _lengthened(piece: bytes, holders: list[bytes], counts: Counter) -> bytes:
    while len(piece) < _LONGEST:
        following = Counter()
        for word in holders:
            framed = b" " + word + b" "
            at = framed.find(piece)
            if at >= 0 and at + len(piece) < len(framed):
                following[framed[at + len(piece)]] += counts[word]
        if not following or max(following.values()) < 0.8 * following.total():
            break
        piece += bytes([following.most_common(1)[0][0]])
    return piece


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    if not dictionary:
        return zstandard.ZstdCompressor(compression_params=parameters)
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=parameters)


def _trained(texts: list[bytes], window: int) -> bytes:
    """Dictionary trained by zstandard on the windows of texts."""
    samples = [w for t in texts for w in windows(t, window)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=6, level=3).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from: take it all
        return b"".join(samples)[-DICTIONARY_BYTES:]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    marked: bytes
    weights: tuple[float, ...]
    window: int = WINDOW_WORDS

    def figures(self, texts: list[bytes]) -> np.ndarray:
        """Sum of the gains and largest gain by passages, and mean difference of the trained dictionaries."""
        plain, toxic, marked = (_compressor(d) for d in (self.ordinary, self.toxic, self.marked))
        out = np.zeros((len(texts), 3))
        for i, text in enumerate(texts):
            total = most = apart = n = 0
            for window in windows(text, self.window):
                size = len(plain.compress(window))
                saved = size - len(marked.compress(window))
                if saved > 0:
                    total, most = total + saved, max(most, saved)
                apart, n = apart + size - len(toxic.compress(window)), n + 1
            out[i] = math.log1p(total), most, apart / max(n, 1)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        bias, *slopes = self.weights
        if not any(slopes):
            return np.full(len(texts), 1 / (1 + math.exp(-bias)))
        return 1 / (1 + np.exp(-np.clip(bias + self.figures(texts) @ np.array(slopes), -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-3 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def fit(toxic: list[bytes], ordinary: list[bytes], share: float, window: int = WINDOW_WORDS) -> Model:
    """Fit dictionaries and curve; share is the part of toxic labels to calibrate to."""
    share = min(max(share, 1e-9), 1 - 1e-9)
    flat = (math.log(share / (1 - share)), 0.0, 0.0, 0.0)
    if not toxic or not ordinary:
        return Model(b"", b"", b"", flat, window)
    base = _trained(ordinary, window)
    passages = b"".join(reversed(toxic_passages(toxic, ordinary)))
    model = Model(base, _trained(toxic, window), passages + base, flat, window)
    texts = toxic + ordinary
    figures = model.figures(texts)
    figures[:, 2] = _apart(toxic, ordinary, window)
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    weight = np.where(y > 0, share / len(toxic), (1 - share) / len(ordinary)) * len(texts)
    model.weights = _logistic(figures, y, weight)
    return model


def _apart(toxic: list[bytes], ordinary: list[bytes], window: int) -> np.ndarray:
    """Mean differences of texts by dictionaries trained on the other half of the sample."""
    half = np.concatenate((np.arange(len(toxic)) % 2, np.arange(len(ordinary)) % 2))
    texts, out = toxic + ordinary, np.zeros(len(half))
    for k in (0, 1):
        base = _trained(ordinary[1 - k :: 2], window)
        model = Model(base, _trained(toxic[1 - k :: 2], window), base, (), window)
        out[half == k] = model.figures([t for t, h in zip(texts, half) if h == k])[:, 2]
    return out


def _sample(rows: DataFrame, known: DataFrame, count: int, most_bytes: int) -> tuple[list[bytes], list[bytes]]:
    """Texts of the rows of either label with the smallest hash of their id, toxic ones first.

    Rows are chosen by id and length alone; of each partition at most `count` ids a label are compared with
    those of others, and only the texts of the chosen ids are fetched.
    """
    sized = rows.select("doc_id", F.octet_length("text").alias("size")).where(F.col("size").between(1, most_bytes))
    labelled = sized.select("doc_id").distinct().join(known.distinct(), "doc_id").withColumn("h", F.xxhash64("doc_id"))
    chosen = [labelled.where(F.col("toxic") == label).orderBy("h", "doc_id").limit(count) for label in (1, 0)]
    ids = F.broadcast(chosen[0].select("doc_id", "toxic").union(chosen[1].select("doc_id", "toxic")))  # 2 x count rows
    texts = rows.where(F.octet_length("text").between(1, most_bytes)).join(ids, "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # one text of an id that repeats
    found = sorted(((r["toxic"], str(r["doc_id"]), r["text"].encode()) for r in texts.collect()), key=lambda t: t[:2])
    return [t for label, _, t in found if label], [t for label, _, t in found if not label]


def _score(model: Model):
    def run(batches):
        for batch in batches:
            scores = [
                model.score([texts.raw(i) for i in range(texts.count)]) for texts in words.slices(batch.column("text"))
            ]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "score"],
            )

    return run


def score_texts(
    docs: DataFrame,
    labels: DataFrame,
    held_out,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Learn from labelled rows where held_out (a column expression on doc_id) is false; score all."""
    rows = docs.select(docs[id_column].alias("doc_id"), frames.plain_text(docs, text_column).alias("text"))
    rows = rows.withColumn("held_out", held_out)
    known = labels.select(labels[id_column].alias("doc_id"), labels[label_column].cast("int").alias("toxic"))
    learned = known.where("toxic in (0, 1)").where(~held_out)
    count, positive = learned.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    toxic, ordinary = _sample(rows.where(~F.col("held_out")), learned, sample_rows, sample_bytes) if count else ([], [])
    model = fit(toxic, ordinary, positive / count if count else 0.0)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(_score(model), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
