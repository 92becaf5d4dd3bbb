"""From raw documents to documents for training: five stages applied one after the other.

Each stage is written as Parquet and read again, so each works on what its predecessor kept and a
lost executor costs no more than its own stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import bpe, decontamination, jaccard_join, line_dedup, quality
from tallymark.llm.queries import RANKS
from tallymark.llm.shipping import ship
from tallymark.operators.staging import stage


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rejected documents and cut boilerplate lines from the others."""
    ship(spark)
    return quality.filtered(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of near-equal lines; documents left without words go."""
    ship(spark)
    return line_dedup.filtered(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    ship(spark)
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents into which benchmark items leak."""
    ship(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the documents and digest ids and decoded bytes."""
    ship(spark)
    return bpe.encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Encoding has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
