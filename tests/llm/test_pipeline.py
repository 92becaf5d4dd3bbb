"""The pipeline against brute-force versions of its stages, on a small table."""

import random
from collections import Counter

import corpus_pipeline
from tests.llm.test_operators import component_ids, removed_lines, words_of


def test_stages(spark, tmp_path):
    g = random.Random(21)

    def line(n=14):
        return " ".join(f"w{g.randint(0, 10**6)}" for _ in range(n))

    texts = ["\n".join(line() for _ in range(6)) for _ in range(12)]
    item = line(20)
    texts += [texts[0], texts[1].replace("w", "W", 1), texts[2] + "\n" + line(3), "too short", None, texts[3] + "\n" + item]
    texts += [" ".join(texts[4].split()[:-4] + ["q", "r", "s", "t"])]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    left = {i: t for i, t in enumerate(texts) if len(words_of(t)) >= 50}
    ids = sorted(left)
    gone = removed_lines([left[i] for i in ids])
    left = {i: "\n".join(x for n, x in enumerate(left[i].split("\n")) if n not in gone.get(k, [])) for k, i in enumerate(ids)}
    left = {i: t for i, t in left.items() if words_of(t)}
    ids = sorted(left)
    groups = component_ids([left[i] for i in ids])
    left = {i: left[i] for k, i in enumerate(ids) if groups[k][1] == k}
    left = {i: t for i, t in left.items() if " ".join(words_of(item)) not in " ".join(words_of(t))}

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "byte_bpe"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, function in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = function(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {r.doc_id: r.text for r in docs.collect()} == left
    found = Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert found == Counter(left.keys())
