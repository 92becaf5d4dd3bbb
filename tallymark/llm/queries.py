"""Registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import (
    bpe,
    decontamination,
    frames,
    html_extraction,
    jaccard_join,
    line_dedup,
    lm_scoring,
    maxscore,
    merkle,
    oracle,
    quality,
    sharding,
    spelling,
    toxicity,
    warc,
)
from tallymark.llm.shipping import ship

RANKS = "byte_bpe_50k.tiktoken"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(oracle.ORACLE)


def _registered(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_registered
def op1_lm_scoring(spark, sf_dir):
    return lm_scoring.score_texts(_table(spark, sf_dir, "documents"), frames.id_remainder(F.col("doc_id"), 7) == 2)


@_registered
def op2_decontamination(spark, sf_dir):
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_registered
def op3_line_dedup(spark, sf_dir):
    return line_dedup.report(_table(spark, sf_dir, "documents"))


@_registered
def op4_html_extraction(spark, sf_dir):
    return html_extraction.extract(_table(spark, sf_dir, "pages"))


@_registered
def op5_toxicity(spark, sf_dir):
    return toxicity.score_texts(
        _table(spark, sf_dir, "documents"),
        _table(spark, sf_dir, "labels"),
        frames.id_remainder(F.col("doc_id"), 4) == 2,
    )


@_registered
def op6_quality_rules(spark, sf_dir):
    return quality.assess(_table(spark, sf_dir, "documents"))


@_registered
def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.components(_table(spark, sf_dir, "documents"))


@_registered
def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.encode_texts(_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@_registered
def op9_warc(spark, sf_dir):
    return warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages")))


@_registered
def op10_kd_sharding(spark, sf_dir):
    return sharding.shard_texts(_table(spark, sf_dir, "documents"))


@_registered
def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest_of_documents(_table(spark, sf_dir, "documents"))


@_registered
def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"))


@_registered
def op13_maxscore_search(spark, sf_dir):
    return maxscore.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
