"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space to one space) and hashed. A line is boilerplate
on a host if more than `max_documents` distinct documents of the host hold it, and more than the
part `min_host_share` of the host's distinct documents. Documents with the same sequence of
normalised lines are copies and count as one, so copies of a document do not make its lines
boilerplate; they are left to the near-duplicate operators. Boilerplate lines are removed, from
copies too, and a document is rejected as depleted if fewer than `min_left_words` words or less
than `min_left_share` of its words remain.

Base rules reject documents under 50 words, or with more than half of the words in repeated
three-word windows.

How it is spread. One Python pass over the texts makes a row of figures and line hashes per
document, which is written to the shared folder. Everything after is DataFrame work on hashes:
distinct documents per host and line (copies are combined first, then partial sums, so a common
line is one row per task), then a join of the lines with the few that are boilerplate, which skew handling can split.

Edge cases. A missing text has no words and fails the base rules; a missing host is a host of its
own; an empty table gives no rows; repeated rows are judged one by one
and count as one document of the host. Other columns pass through `filtered` untouched and do not reach `assess`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames, words
from tallymark.operators.staging import stage

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_TEXT = np.uint64(0x9E3779B97F4A7C15)

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_documents: int = 30
    min_host_share: float = 0.001
    min_left_words: int = 10
    min_left_share: float = 0.3


def line_hashes(texts: words.Texts, w: words.Words):
    """Normalised hash and word count of each line, with the number of its text and its span."""
    starts, ends, text = words.lines(texts)
    owner = np.searchsorted(starts, w.starts, "right") - 1
    counts = np.bincount(owner, minlength=len(starts))
    first = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
    full = counts > 0
    hashes = np.zeros(len(starts), dtype=np.uint64)
    hashes[full] = words.hash_runs(w.hashes, first[full], (first + counts)[full])
    return hashes, counts, text, starts, ends


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks keys that occur twice or more, and keys that occurred before."""
    _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    again = np.ones(len(keys), dtype=bool)
    again[first] = False
    return counts[inverse] > 1, again


def _figures(texts: words.Texts) -> dict[str, pa.Array]:
    n = texts.count
    w = words.words(texts)
    begin, end = texts.offsets[:-1], texts.offsets[1:]
    solid = words.code_points(texts.data) & ~words.IS_SPACE[texts.data]

    window, at = words.windows(w.hashes, w.text, 3)
    many, _ = _repeated(words.mix(window + w.text[at].astype(np.uint64) * _TEXT))
    cover = np.zeros(len(w.text), dtype=bool)
    for k in range(3):
        cover[at[many] + k] = True

    low = words.words(texts, lower=True)
    hashes, counts, text, starts, ends = line_hashes(texts, low)
    full = np.flatnonzero(counts)
    raw = words.hash_spans(texts.data, starts[full], ends[full])
    hashes, counts, text = hashes[full], counts[full], text[full]
    salt = text.astype(np.uint64) * _TEXT
    _, again = _repeated(words.mix(raw + salt))

    closes = np.cumsum(np.bincount(text, minlength=n))
    filled = np.flatnonzero(np.diff(closes, prepend=0))
    sequence = np.zeros(n, dtype=np.uint64)
    sequence[filled] = words.hash_runs(hashes, np.concatenate(([0], closes[filled[:-1]])), closes[filled])
    _, first, inverse = np.unique(words.mix(hashes + salt), return_index=True, return_inverse=True)
    total = np.bincount(inverse, weights=counts, minlength=len(first))
    order = np.argsort(first)
    pick, total = first[order], total[order]
    per_text = np.bincount(text[pick], minlength=n)
    return {
        "n_words": pa.array(w.counts, pa.int64()),
        "word_chars": pa.array(words.sums_between(solid, begin, end), pa.int64()),
        "n_symbols": pa.array(words.sums_between(_SYMBOL[texts.data], begin, end), pa.int64()),
        "n_dup_lines": pa.array(np.bincount(text[again], minlength=n), pa.int64()),
        "n_repeat_words": pa.array(np.bincount(w.text[cover], minlength=n), pa.int64()),
        "sequence": pa.array(sequence.view(np.int64), pa.int64()),
        "lines": words.as_lists(hashes[pick].view(np.int64), per_text, pa.int64()),
        "line_words": words.as_lists(total.astype(np.int64), per_text, pa.int64()),
    }


def _measure(batches):
    for batch in batches:
        for texts in words.slices(batch.column("_text")):
            part = batch.slice(texts.first, texts.count)
            columns = {name: part.column(name) for name in part.schema.names if name != "_text"}
            yield pa.RecordBatch.from_pydict(columns | _figures(texts))


def _host(docs: DataFrame, host_column: str) -> Column:
    return F.coalesce(docs[host_column].cast("string"), F.lit(""))


def _content(docs: DataFrame, text_column: str, host_column: str) -> Column:
    """Digest of host and text, on which alone a verdict depends."""
    host = _host(docs, host_column)
    return F.unhex(F.md5(F.concat(F.length(host).cast("string"), F.lit(":"), host, frames.plain_text(docs, text_column)).cast("binary")))


def _measured(docs: DataFrame, text_column: str, host_column: str, kept: Column) -> DataFrame:
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        _host(docs, host_column).alias("_host"),
        frames.plain_text(docs, text_column).alias("_text"),
        kept.alias("_kept"),
    )
    schema = T.StructType([f for f in rows.schema.fields if f.name != "_text"])
    for name in (*FIGURES, "sequence"):
        schema.add(name, T.LongType())
    for name in ("lines", "line_words"):
        schema.add(name, T.ArrayType(T.LongType()))
    return stage(rows.mapInArrow(_measure, schema), "quality")


def boilerplate(lines: DataFrame, rows: DataFrame, rules: Rules) -> DataFrame:
    """Lines above the limits, from frames of _host, line and sequence, and of _host and sequence of all documents."""
    distinct = lines.select("_host", "line", "sequence").distinct()
    found = distinct.groupBy("_host", "line").agg(F.count("*").alias("documents"))
    sizes = rows.select("_host", "sequence").distinct().groupBy("_host").agg(F.count("*").alias("all_documents"))
    return (
        found.where(F.col("documents") > rules.max_documents)
        .join(sizes, "_host")
        .where(F.col("documents") > rules.min_host_share * F.col("all_documents"))
        .select("_host", "line")
    )


def _judged(docs: DataFrame, rules: Rules, text_column: str, host_column: str, kept: Column) -> DataFrame:
    rows = _measured(docs, text_column, host_column, kept)
    lines = rows.select("_row", "_host", "sequence", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select(
        "_row", "_host", "sequence", F.col("l.lines").alias("line"), "l.line_words"
    )
    removed = (
        lines.join(boilerplate(lines, rows, rules), ["_host", "line"])
        .groupBy("_row")
        .agg(F.sum("line_words").alias("removed_words"), F.collect_list("line").alias("removed_lines"))
    )
    left = F.col("n_words") - F.col("removed_words")
    base = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    return (
        rows.select("_row", "_kept", *FIGURES)
        .join(removed, "_row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .withColumn("base_failed", base)
        .withColumn(
            "kept",
            ~(F.col("base_failed") | (left < rules.min_left_words) | (left < rules.min_left_share * F.col("n_words"))),
        )
    )


def assess(
    docs: DataFrame,
    rules: Rules = Rules(),
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
) -> DataFrame:
    """One row per document: figures, base_failed, kept, removed_words."""
    judged = _judged(docs, rules, text_column, host_column, docs[id_column])
    return judged.select(F.col("_kept").alias("doc_id"), *FIGURES, "base_failed", "kept", "removed_words")


def _cut(batches):
    for batch in batches:
        out = []
        gone = batch.column("removed_lines").to_pylist()
        for texts in words.slices(batch.column("text")):
            hashes, counts, text, starts, ends = line_hashes(texts, words.words(texts, lower=True))
            hashes = hashes.view(np.int64)
            cuts = np.searchsorted(text, np.arange(texts.count + 1))
            for i in range(texts.count):
                drop = gone[texts.first + i]
                if not drop:
                    out.append(texts.raw(i).decode())
                    continue
                span = range(cuts[i], cuts[i + 1])
                drop = set(drop)
                keep = [k for k in span if not counts[k] or int(hashes[k]) not in drop]
                out.append(b"\n".join(texts.data[starts[k] : ends[k]].tobytes() for k in keep).decode())
        yield pa.RecordBatch.from_pydict({"kept_row": batch.column("kept_row"), "text": pa.array(out, pa.string())})


def filtered(
    docs: DataFrame, rules: Rules = Rules(), text_column: str = "text", host_column: str = "source"
) -> DataFrame:
    """Documents that pass, without their boilerplate lines; same columns.

    Verdicts are staged without texts and come back by the digest of host and text.
    """
    key = _content(docs, text_column, host_column)
    judged = _judged(docs, rules, text_column, host_column, key).where("kept")
    verdicts = judged.select(F.col("_kept").alias("key"), "removed_lines").dropDuplicates(["key"])
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("kept_row"), key.alias("key"))
    rows = whole.join(verdicts, "key").select(
        "kept_row", F.col("kept_row")[text_column].alias("text"), "removed_lines"
    )
    schema = T.StructType([rows.schema["kept_row"], T.StructField("text", T.StringType())])
    cut = rows.mapInArrow(_cut, schema)
    return cut.select(
        *[F.col("text").alias(c) if c == text_column else F.col("kept_row")[c].alias(c) for c in docs.columns]
    )
