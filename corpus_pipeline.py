"""Corpus pipeline over ``documents``: one operator of marketlens.llm per stage.

``run`` applies STAGES in order; each stage's result is written as Parquet to the shared folder
and reread as the next one's documents. All stages but the last return the columns of documents:
toxicity and quality rules drop rejected documents, line deduplication shortens texts (n_chars
follows) and drops documents of which nothing is left, SimHash keeps one document of each group
of near copies; packing returns the placement of every piece of the documents left.

Nulls, empty texts, repeated rows, empty tables and further columns: as each operator states.
"""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import common, line_dedup, packing, quality, simhash, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what a model trained on the labelled rows of ``docs`` scores below 0.5."""
    common.small_batches(spark)
    return toxicity.keep_ordinary(docs, toxicity.fit(docs, common.documents(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(spark, docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every kept document in sequences of at most 2048 tokens."""
    return packing.pack_documents(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("quality rules", drop_poor), ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_copies), ("best-fit packing", pack),
]

#: SQL cannot train dictionaries or tokenize; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = common.materialize(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
