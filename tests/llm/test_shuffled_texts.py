"""Operators that shuffle only the texts that they need."""

import random
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tallymark.llm import bpe, line_dedup
from tallymark.llm.queries import RANKS


def lines_of(seed, count):
    g = random.Random(seed)
    return ["".join(g.choice("abcdefgh ") for _ in range(g.randint(30, 60))).strip() + f" {k:05d}" for k in range(count)]


@pytest.mark.parametrize("most", [1 << 26, 1 << 15])
def test_bitmap_lets_wanted_lines_pass(spark, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "_MOST_BITS", most)
    lines = [line.encode() for line in lines_of(0, 6000)]
    keys = [key for _, key, _ in line_dedup.normal_lines(b"\n".join(lines))]
    bitmap, bits = line_dedup._bitmap(spark.createDataFrame([(k,) for k in keys[:3000]], "line long"))
    assert 8 * len(bitmap) == bits <= most
    assert bits == most or 16 * 2900 < bits < 64 * 3100
    rows = pa.RecordBatch.from_pydict({"text": pa.array([b"\n".join(lines).decode()])})
    found = [k for b in line_dedup._fetch(24, SimpleNamespace(value=bitmap), bits)([rows]) for k in b.column("line").to_pylist()]
    assert set(keys[:3000]) <= set(found)
    assert bits == most or len(found) < 3000 + 300


@pytest.mark.parametrize("most", [1 << 26, 1 << 15])
def test_texts_of_lines_that_met_nothing_are_not_staged(spark, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "_MOST_BITS", most)
    staged = []
    stage = line_dedup.stage
    monkeypatch.setattr(line_dedup, "stage", lambda df, *label: staged.append(df.columns) or counts.append(len(df.collect())) or stage(df, *label))
    counts = []
    lines = lines_of(1, 400)
    docs = [(k, line) for k, line in enumerate(lines)]
    docs += [(400 + k, line[:10] + "#" + line[11:]) for k, line in enumerate(lines[:20])]
    found = line_dedup.line_classes(spark.createDataFrame(docs, "doc_id long, text string").select("text"))
    assert found.groupBy("label").count().count() == 20
    (texts,) = [n for n, columns in zip(counts, staged) if "normal" in columns]
    assert 40 <= texts < 100


def test_texts_are_not_shuffled_to_compare_pairs_that_agree(spark):
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    g = random.Random(2)
    texts = [" ".join(g.choice(["one", "two's", "33", "vier,"]) for _ in range(9000)) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        found = bpe.encode_texts(docs, path, pattern, chunk_chars=40, overlap_chars=20)
        plan = found._jdf.queryExecution().executedPlan().toString()
        counts = {r["doc_id"]: r["n_tokens"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # two sides of pieces are joined by sorting, the list of open pairs is sent to the chunks
    assert "BroadcastHashJoin [row" in plan
    encoding, _ = bpe.load(path, pattern)
    assert isinstance(encoding, tiktoken.Encoding)
    assert counts == {k: len(encoding.encode_ordinary(t)) for k, t in enumerate(texts)}
