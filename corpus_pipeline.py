"""A training corpus from raw documents: five stages, each an operator of measure_rollup.llm.

Every stage works on all that the one before it kept. The first four return rows of
``documents`` with all their columns; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from measure_rollup.llm.exact_dedup import exact_dedup
from measure_rollup.llm.language_id import in_a_known_language
from measure_rollup.llm.mixing import mix
from measure_rollup.llm.near_dedup import near_dedup
from measure_rollup.llm.packing import pack_documents
from measure_rollup.llm.shipping import ship
from measure_rollup.sources import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out what is not in a language that the documents themselves teach."""
    ship(spark)
    return in_a_known_language(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar texts."""
    ship(spark)
    return near_dedup(docs)


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that sources, languages and topics meet their target weights."""
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the documents into pieces and places them in sequences of at most 2048 tokens."""
    ship(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", sample_mixture),
    ("packing", pack_sequences),
]

# Rank-order profiles, Order MinHash and differencing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
