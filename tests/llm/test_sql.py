"""SQL of operators against Spark on rows that the general tables lack."""

import random

import duckdb
import pandas as pd

from tallymark.llm import jaccard_join, quality
from tallymark.llm.oracle import ORACLE
from tallymark.llm.shipping import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    g = random.Random(4)

    def words(n):
        return " ".join(f"w{g.randint(0, 5000)}" for _ in range(n))

    footer = " ".join(f"f{k}" for k in range(45))
    texts = [(f"Common\tHeader LINE\n{words(60)}\n\ncommon header  line\n{words(8)} # | é\n{footer}", "hot") for _ in range(40)]
    texts += [(f"common header line\n{words(8)}\n{footer}", "hot"), (f"common header line\n{words(8)}\n{footer}", "s")]
    texts += [("\n".join(["common header line"] * 30 + [words(9)]), "hot"), ("", "hot"), (None, None), (" \n\t", "hot")]
    texts += [(f"rare line {k // 2}\n{words(55)}", None) for k in range(8)]
    texts += [texts[0]] * 5 + [("one two three four", "s"), ("One two\nthree four", "s"), ("a b c " * 30, "s")]
    base = words(80).split()
    texts += [(" ".join(base[:k] + ["changed"] + base[k + 1 :]), "s") for k in (3, 40, 77)]
    texts += [(" ".join(base[k : k + 70]), "t") for k in (0, 4, 8, 10)]
    return [(i, t, "en", s, 0) for i, (t, s) in enumerate(texts)]


def same_rows(spark, frame, name):
    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame(documents(), columns=[c.split()[0] for c in SCHEMA.split(", ")]))
    expected = connection.execute(ORACLE[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(frame.columns)
    found = sorted(tuple(r[n] for n in names) for r in frame.collect())
    assert found == sorted(expected.fetchall())
    return [dict(zip(names, r)) for r in found]


def test_quality_rules(spark):
    ship(spark)
    rows = same_rows(spark, quality.assess(spark.createDataFrame(documents(), SCHEMA)), "op6_quality_rules")
    assert {r["removed_words"] for r in rows} == {0, 48, 51, 90}
    assert any(r["removed_words"] and r["kept"] for r in rows) and any(not r["base_failed"] and not r["kept"] for r in rows)


def test_jaccard_components(spark):
    ship(spark)
    rows = same_rows(spark, jaccard_join.components(spark.createDataFrame(documents(), SCHEMA)), "op7_jaccard_join")
    assert len({r["component_id"] for r in rows}) < len(rows) - 8
