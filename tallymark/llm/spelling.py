"""Spelling variants by a relational trie frontier.

Words are the runs of letters of whole texts, and every word looks for the words that differ from it
by one code point. The trie of all words is a table of edges (node, label, child), and a search is a
state (word, position, node, edits). All states of a level are joined with the edges of their nodes:
an exact step follows the edge that continues the word; a state without edits may also replace the next
code point by that of another edge, insert that of another edge, or leave the next one out. A state with
its edit spent that ends on the end of a word makes that word a neighbour. The frontier is written level
by level and the search ends when it is empty.

Four things keep the frontier small.
- One edit leaves half of a word untouched. A trie of words is entered at the node of a word's first half
  and finds edits behind it; a trie of reversed words is entered at the second half and finds the others.
  So no search begins at the root, where every letter would branch.
- Two words part at a node where the trie branches or a word ends, and of the equivalent places of an
  edit (one of two equal letters left out) the place where they part is one. Nodes that neither branch nor
  end a word are joined into one edge with a longer label; levels count branches, not letters.
- After the edit a state must continue exactly, and few do.
- A node has a mask with a bit for what follows it in each word, chosen by six bits of its hash. A state with its
  edit spent is made only if the bit of its own rest is set; a missing bit proves that no word ends so.

Nodes are 64-bit hashes of their prefix and depth. Two prefixes with one hash would only add edges;
every neighbour is verified at the end, so a collision neither adds nor loses any.

How it is spread. Runs are counted with partial sums before the shuffle. Prefixes are counted as rows
(node, least and greatest next letter), which combine before the shuffle too. States are dealt by node
and meet at most one edge per letter; a frequent node's states are split by skew handling. No
task holds a trie, and the driver only sees how many states are left.

Edge cases. A missing or empty text has no words; a missing id counts as empty text in the hash that
deletes a code point. Repeated rows count as often as they stand. Of forms with equal counts the smallest in
code-point order is taken. A very long run is a word like any other. An empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import frames, words
from tallymark.operators.staging import discard, stage

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
DAMAGE = 31
_SHORTEST = MIN_LENGTH // 2  # no search enters a trie above this depth
_SEED = np.uint64(0x9E3779B97F4A7C15)


def word_counts(docs: DataFrame, id_column: str, text_column: str, min_length: int, min_count: int, damage: int) -> DataFrame:
    """word, n: distinct runs of enough letters after the deletions, with their occurrences."""
    long_run = RUN.replace("+", f"{{{min_length},}}")  # a deletion only shortens a run
    runs = docs.select(
        F.coalesce(docs[id_column].cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(frames.plain_text(docs, text_column), F.lit(long_run), F.lit(0))).alias("run"),
    )
    lowered = runs.select(F.translate("run", UPPER, LOWER).alias("run"), "id")
    hashed = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    rest = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.length("run")))
    word = F.when(F.col("h") % damage == 0, rest).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


class _Points:
    """Code points of some words one after the other, with the sums that hash any part of a word."""

    def __init__(self, texts: list[str]):
        self.points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        power, self.inverse = words._power_tables(len(self.points) + 1)
        self.sums = np.zeros(len(self.points) + 1, dtype=np.uint64)
        np.cumsum(words.mix((self.points.astype(np.uint64) + np.uint64(1)) * _SEED) * power[: len(self.points)], out=self.sums[1:])
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.inverse[begin]

    def rows(self, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Word and position of each place from a position to the end of its word."""
        rows = self.lengths - first + 1
        word = np.repeat(np.arange(len(rows)), rows)
        return word, np.arange(len(word)) - np.repeat(np.cumsum(rows) - rows, rows) + first

    def marks(self, word: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Six bits of the hash of what follows a place."""
        begin = self.starts[word] + position
        return (words.mix(self.hashes(begin, (self.starts + self.lengths)[word]) + _SEED) >> np.uint64(58)).astype(np.uint8)


def prefixes(texts: list[str], numbers: np.ndarray, side: int) -> pa.RecordBatch:
    """Rows (side, number, position, node, next, mark) of the words' beginnings; a whole word has no next.

    Rows hold the word's number instead of its letters, so a long word makes many rows but no long ones.
    """
    p = _Points(texts)
    word, position = p.rows(_SHORTEST)
    first = p.starts[word]
    node = p.hashes(first, first + position) + (position.astype(np.uint64) * np.uint64(2) + np.uint64(side)) * _SEED
    following = np.append(p.points, np.uint32(0))[first + position].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(word), side, dtype=np.int32)),
            pa.array(numbers[word]),
            pa.array(position.astype(np.int32)),
            pa.array(words.mix(node).view(np.int64)),
            pa.array(following, mask=position == p.lengths[word]),
            pa.array(p.marks(word, position).astype(np.int32)),
        ],
        ["side", "number", "position", "node", "next", "mark"],
    )


def _spelled(texts: list[str], numbers: np.ndarray, side: int) -> pa.RecordBatch:
    """Rows (side, number, word, marks): one character for what follows each place of the word."""
    p = _Points(texts)
    marks = (p.marks(*p.rows(0)) + 48).tobytes().decode("ascii")
    cuts = np.cumsum(p.lengths + 1)
    marks = [marks[a:b] for a, b in zip(cuts - p.lengths - 1, cuts)]
    columns = [pa.array(np.full(len(texts), side, dtype=np.int32)), pa.array(numbers), pa.array(texts, pa.string()), pa.array(marks, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["side", "number", "word", "marks"])


def _both_sides(make):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                texts = batch.column("word").slice(at, 2048).to_pylist()
                numbers = batch.column("number").slice(at, 2048).to_numpy()
                yield make(texts, numbers, 0)
                yield make([t[::-1] for t in texts], numbers, 1)

    return run


def trie(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words' own nodes (side, word, marks, places) and the edges of the tries; counted has a number per word."""
    numbered = counted.select("number", "word")
    beginnings = numbered.mapInArrow(_both_sides(prefixes), "side int, number long, position int, node long, next int, mark int")
    kinds = beginnings.groupBy("node").agg(
        F.min("next").alias("least"),
        F.max("next").alias("most"),
        F.max(F.col("next").isNull()).alias("ends"),
        F.expr("bit_or(shiftleft(1L, mark))").alias("mask"),
    )
    kept = kinds.where("ends or least <> most").select("node", "ends", "mask")
    on_way = beginnings.join(kept, "node").select("side", "number", F.struct("position", "node", "ends", "mask").alias("place"))
    places = on_way.groupBy("side", "number").agg(F.sort_array(F.collect_list("place")).alias("places"))
    spelled = numbered.mapInArrow(_both_sides(_spelled), "side int, number long, word string, marks string")
    paths = stage(places.join(spelled, ["side", "number"]).select("side", "word", "marks", "places"), "trie")
    steps = paths.select("word", F.expr("explode(arrays_zip(slice(places, 1, size(places) - 1), slice(places, 2, size(places) - 1)))").alias("s"))
    edges = steps.select(
        F.col("s.0.node").alias("node"),
        F.expr("substring(word, s.`0`.position + 1, s.`1`.position - s.`0`.position)").alias("label"),
        F.col("s.1.node").alias("child"),
        F.col("s.1.ends").alias("child_ends"),
        F.col("s.1.mask").alias("mask"),
    )
    return paths, stage(edges.distinct(), "trie")


def _level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states that one step makes of others; `found` marks the ends of words, reached with one edit."""
    own = "here = left(label, 1) and substring(word, position + 1, length(label)) = label"
    other = "edits = 0 and here <> left(label, 1)"
    tail, size = "substring(label, 2)", "length(label)"

    def fits(position: str) -> str:
        """Whether some word below the edge goes on as this one does there; few others pass."""
        return f"shiftright(mask, ascii(substring(marks, {position} + 1, 1)) - 48) & 1 = 1"

    moves = {
        "own": (f"{own} and (edits = 0 or {fits(f'position + {size}')})", f"position + {size}", "edits"),
        "replaced": (
            f"{other} and here <> '' and substring(word, position + 2, {size} - 1) = {tail} and {fits(f'position + {size}')}",
            f"position + {size}",
            "1",
        ),
        "inserted": (
            f"{other} and substring(word, position + 1, {size} - 1) = {tail} and {fits(f'position + {size} - 1')}",
            f"position + {size} - 1",
            "1",
        ),
        "left_out": (
            f"{other} and here <> '' and substring(word, position + 2, {size}) = label and {fits(f'position + {size} + 1')}",
            f"position + {size} + 1",
            "1",
        ),
    }
    met = states.withColumn("here", F.expr("substring(word, position + 1, 1)")).join(edges, "node")
    met = met.where(" or ".join(f"({when})" for when, _, _ in moves.values()))
    made = ", ".join(f"if({when}, named_struct('position', {position}, 'edits', {edits}), null)" for when, position, edits in moves.values())
    made = met.select("side", "word", "marks", F.col("child").alias("node"), F.col("child_ends").alias("ends"), F.expr(f"explode(array({made}))").alias("m"))
    made = made.where("m is not null").select("side", "word", "marks", "node", "ends", "m.position", "m.edits")
    made = made.withColumn("found", F.expr("edits = 1 and ends and position = length(word)"))
    made = made.where("found or edits = 0 or position < length(word)")
    shortened = states.where("edits = 0 and position + 1 = length(word) and ends")  # its last letter left out
    return made.unionByName(shortened.withColumn("found", F.lit(True)).withColumn("edits", F.lit(1)))


def near_words(counted: DataFrame) -> DataFrame:
    """word, near: every pair of counted words one edit apart, in both directions."""
    paths, edges = trie(counted)
    half = F.when(F.col("side") == 0, F.floor(F.length("word") / 2)).otherwise(F.ceil(F.length("word") / 2))
    entry = F.element_at(F.filter("places", lambda x: x["position"] >= half), 1)
    states = paths.select("side", "word", "marks", entry.alias("e"), F.lit(0).alias("edits")).select("side", "word", "marks", "e.*", "edits").drop("mask")
    levels: list[DataFrame] = []
    while True:
        levels.append(stage(_level(states, edges), "frontier"))
        states = levels[-1].where("not found").drop("found")
        if not states.head(1):
            break
    ends = paths.select(F.col("word").alias("near"), F.element_at("places", -1)["node"].alias("node"))
    found = levels[0]
    for level in levels[1:]:
        found = found.union(level)
    pairs = found.where("found").select("word", "side", "node").distinct().join(ends, "node")
    forward = F.col("side") == 0
    pairs = pairs.select(*(F.when(forward, F.col(c)).otherwise(F.reverse(c)).alias(c) for c in ("word", "near")))
    pairs = stage(pairs.where(F.levenshtein("word", "near", 1) == 1).distinct(), "near")
    discard(paths, edges, *levels)
    return pairs


def _roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """word, root: forms followed to the last, doubling the distance in each join.

    A form is `ratio` times as frequent as its word, so chains are no longer than the logarithm of the
    largest count.
    """
    hops, n = 0, 1
    while n * ratio <= most:
        hops, n = hops + 1, n * ratio
    now, reach = forms.select("word", F.col("form").alias("root")), 1
    while reach < hops:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        reach *= 2
    return now


def variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    damage: int = DAMAGE,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"words of fewer than {MIN_LENGTH} code points are not supported")
    counted = word_counts(docs, id_column, text_column, min_length, min_count, damage)
    counted = stage(counted.withColumn("number", F.monotonically_increasing_id()), "words")
    most = counted.agg(F.max("n")).first()[0] or 0
    pairs = near_words(counted).join(counted.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best")
    )
    judged = counted.join(best, "word", "left").withColumn("form_n", -F.col("best.minus"))
    good = F.col("form_n") >= ratio * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(good, F.col("best.form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n"),
    )
    judged = stage(judged, "forms")
    roots = _roots(judged.where("form is not null"), most, ratio)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
