"""Language-model scoring with a weighted backoff automaton.

States are word histories, arcs carry smoothed n-gram log-probabilities, and a failure arc leads
from each history to the empty one and carries its backoff weight. A text is read once from left
to right; the state is the word just read if training saw it, else the empty history.

Smoothing. One word: absolute discounting, D = n1 / (n1 + 2 n2) from the counts of counts
(0.5 if n1 or n2 is 0, so no word gets probability 0); the mass D V / N goes to one class of unknown words. Two words: a Dirichlet prior of `prior` words
distributed as the one-word model, so p(w | u) = (c(uw) + prior p(w)) / (c(u) + prior) and the
failure arc of u weighs prior / (c(u) + prior). All n-grams of the training texts are kept.

How it is spread. Texts are dealt into blocks of about `block_bytes`, and the number of blocks
grows with the input. Each block lists its distinct n-grams with their training counts, sorted
and packed, for buckets of hash values; the number of buckets grows too. A bucket adds the
counts up and answers each block only where the total differs from the block's own count. With
the answers a block builds the part of the automaton that its texts can reach and scores them.
A frequent n-gram costs one entry per block, so no key is hot, and no task holds the model.

Edge cases. A missing text is empty: its only token is the end. Repeated rows are counted and
scored as often as they stand. An empty table gives no rows. Without any training text the score
is the base. Columns other than the id and the text are ignored. A missing id counts as
empty text for the training split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import frames, packed, words

BLOCK_BYTES = 8 << 20
BUCKET_ENTRIES = 2_000_000
PRIOR = 8.0
_END = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0xA0761D6478BD642F)

_ENTRIES = "bucket int, kind int, block int, keys binary, counts binary"
_ANSWERS = "block int, kind int, keys binary, counts binary, stats array<double>"
_SCORES = (
    "doc_id {id}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _tokens(texts: words.Texts):
    """Token hashes of a slice, each text closed by the end token; pair hashes; text numbers."""
    w = words.words(texts, lower=True)
    counts = w.counts + 1
    ends = np.cumsum(counts) - 1
    tokens = np.empty(len(w.hashes) + texts.count, dtype=np.uint64)
    inner = np.ones(len(tokens), dtype=bool)
    inner[ends] = False
    tokens[inner] = w.hashes
    tokens[ends] = _END
    history = np.empty_like(tokens)
    history[1:] = tokens[:-1]
    history[0] = _END  # what stands before a text is the end of another
    pairs = words.mix(history * _PAIR + tokens)
    return tokens, history, pairs, np.repeat(np.arange(texts.count), counts)


def _count(parts: list[np.ndarray], trained: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate(trained), minlength=len(keys)).astype(np.uint32)


def _block_counts(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct n-grams of a block, by order, with their counts in training texts."""
    held = table.column("held_out").to_numpy()
    merged = [[], []]
    for texts in words.slices(table.column("text")):
        tokens, _, pairs, text = _tokens(texts)
        weight = ~held[texts.first + text]
        for k, keys in enumerate((tokens, pairs)):
            merged[k].append(_count([keys], [weight]))
    return [
        _count([m[0] for m in part], [m[1] for m in part])
        if part
        else (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        for part in merged
    ]


def _emit(buckets: int):
    def emit(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        rows = []
        edges = np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=np.uint64)
        for kind, (keys, counts) in enumerate(_block_counts(table)):
            cuts = [0, *np.searchsorted(keys, edges), len(keys)]
            for bucket in range(buckets):
                a, b = cuts[bucket], cuts[bucket + 1]
                if b > a:
                    rows.append((bucket, kind, block, packed.pack_sorted(keys[a:b]), packed.pack(counts[a:b])))
        return pa.table(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            names=["bucket", "kind", "block", "keys", "counts"],
        )

    return emit


def _answer(blocks: int):
    def answer(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        owner = table.column("block").to_pylist()
        lists = [packed.unpack_sorted(x) for x in table.column("keys").to_pylist()]
        own = [packed.unpack(x, np.uint32) for x in table.column("counts").to_pylist()]
        keys, inverse = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(own), minlength=len(keys)).astype(np.uint64)
        out, at = [], 0
        for block, k, c in zip(owner, lists, own):
            all_of = total[inverse[at : at + len(k)]]
            at += len(k)
            other = all_of != c
            if other.any():
                out.append((block, kind, packed.pack_sorted(k[other]), packed.pack(all_of[other]), None))
        if kind == 0:  # every block learns the few sums of every bucket
            sums = [float((total > 0).sum()), float(total.sum()), float((total == 1).sum()), float((total == 2).sum())]
            out += [(block, kind, None, None, sums) for block in range(blocks)]
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64()))
        names = ["block", "kind", "keys", "counts", "stats"]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    return answer


class Automaton:
    """The states and arcs that the texts of one block can reach."""

    def __init__(self, unigrams, bigrams, distinct: float, total: float, ones: float, twos: float, prior: float):
        (self.keys, self.counts), (self.pairs, self.pair_counts) = unigrams, bigrams
        self.distinct, self.total, self.prior = distinct, total, prior
        self.discount = ones / (ones + 2 * twos) if ones and twos else 0.5

    def read(self, tokens: np.ndarray, history: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each token after the state before it; whether it is known."""
        seen = self.counts[packed.lookup(self.keys, tokens)].astype(float)
        if not self.total:
            return np.full(len(tokens), -np.log10(self.distinct + 1)), seen > 0
        state = self.counts[packed.lookup(self.keys, history)].astype(float)
        arc = self.pair_counts[packed.lookup(self.pairs, pairs)].astype(float)
        unknown = self.discount * self.distinct / self.total
        empty = np.where(seen > 0, (seen - self.discount) / self.total, unknown)
        failure = np.log10(self.prior / (state + self.prior)) + np.log10(empty)
        return np.where(arc > 0, np.log10((arc + self.prior * empty) / (state + self.prior)), failure), seen > 0


def _score(prior: float):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        counts = _block_counts(docs)  # of a block without texts: two empty lists
        stats = np.zeros(4)
        for kind, keys, totals, sums in zip(*(answers.column(c).to_pylist() for c in ("kind", "keys", "counts", "stats"))):
            if sums is not None:
                stats += sums
            else:
                own, mine = counts[kind]
                mine = mine.astype(np.uint64) if mine.dtype != np.uint64 else mine
                mine[packed.lookup(own, packed.unpack_sorted(keys))] = packed.unpack(totals)
                counts[kind] = own, mine
        model = Automaton(*counts, *stats, prior)
        distinct, total = stats[:2]
        columns: list[list[np.ndarray]] = [[np.zeros(0)] for _ in range(4)]
        for texts in words.slices(docs.column("text")):
            tokens, history, pairs, text = _tokens(texts)
            log, known = model.read(tokens, history, pairs)
            seen = model.counts[packed.lookup(model.keys, tokens)].astype(float)
            base = np.log10((seen + 1) / (total + (distinct + 1)))
            n = texts.count
            for column, value in zip(columns, (np.ones(len(tokens)), known, base, log)):
                column.append(np.bincount(text, weights=value, minlength=n))
        n_tokens, n_known, base, log = (np.concatenate(c) for c in columns)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": n_tokens.astype(np.int64),
                "n_known": n_known.astype(np.int64),
                "train_tokens": np.full(len(log), int(total), dtype=np.int64),
                "base_score": base,
                "score": log,
            }
        )

    return score


def score_texts(
    docs: DataFrame,
    held_out,
    id_column: str = "doc_id",
    text_column: str = "text",
    prior: float = PRIOR,
    block_bytes: int = BLOCK_BYTES,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """Train on the rows where held_out (a column expression) is false and score all rows."""
    rows = docs.select(
        docs[id_column].alias("doc_id"), frames.plain_text(docs, text_column).alias("text"), held_out.alias("held_out")
    )
    _, size = frames.text_bytes(rows)
    blocks = max(1, -(-size // block_bytes))
    buckets = max(1, -(-size // (6 * bucket_entries)) * 2)
    key = F.xxhash64("doc_id", "text")
    dealt = rows.withColumn("block", F.pmod(key, F.lit(blocks)).cast("int")).repartition(blocks, "block")
    entries = dealt.groupBy("block").applyInArrow(_emit(buckets), _ENTRIES)
    answers = entries.groupBy("bucket", "kind").applyInArrow(_answer(blocks), _ANSWERS)
    schema = _SCORES.format(id=rows.schema["doc_id"].dataType.simpleString())
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(prior), schema)
