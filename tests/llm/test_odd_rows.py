"""Long, repetitive and repeated rows, and columns named like helpers."""

import random
import time
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tallymark.llm import decontamination, html_extraction, sharding, warc, words
from tallymark.llm.shipping import ship


def best_stretch(text, item, offset):
    """Equal words, begin and length of the stretch of largest value, the first end and the latest begin winning."""
    best = (0, 0, 0, 0)
    for end in range(len(item) + 1):
        for begin in range(end, -1, -1):
            span = [k + offset for k in range(begin, end)]
            if span and (span[0] < 0 or span[-1] >= len(text)):
                continue
            equal = sum(text[p] == item[p - offset] for p in span)
            value = equal - 2 * (len(span) - equal)
            if value > best[0]:
                best = (value, equal, offset + begin, len(span))
    return best[1:]


def test_leaks_against_every_offset():
    g = random.Random(11)
    items = [[g.choice("abcdefgh") + str(g.randint(0, 3)) for _ in range(g.randint(1, 14))] for _ in range(12)]
    items += [["same"] * 9, ["same", "other"] * 5]
    texts = [[g.choice("abcdefgh") + str(g.randint(0, 3)) for _ in range(g.randint(0, 30))] for _ in range(70)]
    for text in texts[:60]:
        item = [w if g.random() > 0.1 else "changed" for w in g.choice(items)]
        text[len(text) // 2 : len(text) // 2] = item
    texts += [["same"] * 50, ["same", "other"] * 20, ["x"]]
    index = decontamination.Index.build([" ".join(i) for i in items])
    (part,) = words.slices(pa.array([" ".join(t) for t in texts]))
    found = {(t, i): equal for t, i, _, _, equal in decontamination.leaks(index, part, 0.7, 40)}
    expected = {}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            if len(item) < 4:  # shorter than every mask: whole items
                spans = [text[k : k + len(item)] for k in range(len(text))]
                equal = len(item) if item in spans else 0
            else:
                equal = max(best_stretch(text, item, k)[0] for k in range(-len(item), len(text) + 1))
            if equal >= 0.7 * len(item) and equal:
                expected[t, i] = equal
    long = {k: v for k, v in expected.items() if len(items[k[1]]) >= 8}
    assert {k: v for k, v in found.items() if k in long} == long and len(long) > 20
    assert set(found.items()) <= set(expected.items())


def test_a_long_text_of_one_word():
    index = decontamination.Index.build([" ".join(["word"] * 59), "some other item of the benchmark here"])
    (part,) = words.slices(pa.array([" ".join(["word"] * 100_000)]))
    begin = time.monotonic()
    found = decontamination.leaks(index, part, 0.7, 40)
    assert found == [[0, 0, 0, 59, 59]]
    assert time.monotonic() - begin < 30


@pytest.mark.parametrize("tag", ["div", "p", "ul><li", "table><tr><td", "span"])
def test_deep_pages_take_time_by_length(tag):
    seconds = {}
    for n in (4000, 32000):
        begin = time.monotonic()
        root = html_extraction.parse(f"<html><body>{f'<{tag}>' * n}deep text")
        assert html_extraction.main_text(root, set()) == "deep text"
        seconds[n] = time.monotonic() - begin
    assert seconds[32000] < 30 * seconds[4000] + 1


def test_equal_rows_are_spread(spark):
    schema = "doc_id long, source string, lang string, text string, tie long, node int, dims string"
    rows = [(7, "a", "en", "ten bytes.", 1, 2, "x")] * 2000 + [(8, "b", "en", None, 1, 2, "x")]
    found = sharding.shard_texts(spark.createDataFrame(rows, schema).repartition(5), slot_rows=50).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 6 * 11
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_ids_with_line_breaks_come_back(spark):
    ship(spark)
    ids = ["1\r\nX: y", "100%", "a b+c", "é ", "\r\n\r\n", "plain", ""]
    pages = spark.createDataFrame([(i, "u", "x" * 1200, "extra") for i in ids], "page_id string, url string, html string, digest string")
    found = warc.read_archives(warc.write_archives(pages), T.StringType()).collect()
    assert sorted(r.page_id for r in found) == sorted(ids)
    assert {r.refers_to for r in found if r.record_type == "revisit"} == {max(ids)}
