"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL.

Each query applies its operator, with production parameters, to the whole table it is meant for.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, exact_dedup, html_extract, line_dedup, lm_scoring, merkle, packing, quality, ranked_search, simhash, token_counts,
               topk_search, toxicity)
from .common import documents, materialize, shared_dir, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(spark, documents(spark, sf_dir))


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


ORACLE["op2_line_dedup"] = line_dedup.SQL


@_query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark, documents(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@_query
def op4_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings")
    return topk_search.search(spark, rows, rows.where(F.col("vec_id") % topk_search.QUERY_EVERY == 0))


ORACLE["op4_exact_topk_search"] = topk_search.SQL


@_query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches: load of all documents, takedown of those labelled toxic, revision of those labelled
    poor (symbol runs become a space), and a replay of the load, which must count once.

    Every text, and what its revision would be where that differs, is counted once by each version; labels meet the counts. A document
    with several label rows is toxic if one says so, and poor if none calls it good."""
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    vocabularies = {"byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.json")}
    store = token_counts.Rollup(spark, f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/rollup-{uuid.uuid4().hex}", vocabularies=vocabularies)
    small_batches(spark)
    revised = F.regexp_replace("text", "[#*$%&|<>]+", " ")
    texts = docs.select("doc_id", "source", "lang", "text", F.when(F.col("text") != revised, revised).alias("revised"), (F.col("text") != revised).alias("differs"))
    counted = materialize(spark, token_counts.count_tokens(texts, {"text": "tokens", "revised": "new_tokens"}, vocabularies=vocabularies))
    verdict = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    marked = counted.join(verdict, "doc_id")
    load = counted.select(F.lit("insert").alias("op"), "source", "lang", "tokens")
    taken = marked.where("toxic = 1").select(F.lit("delete").alias("op"), "source", "lang", "tokens")
    change = marked.where("quality = 0 and toxic is distinct from 1").select(
        F.lit("revise").alias("op"), "source", "lang", F.when(F.col("differs"), F.col("new_tokens")).otherwise(F.col("tokens")).alias("tokens"),
        F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), F.col("tokens").alias("old_tokens"))
    for batch, changes in (("load", load), ("takedown", taken), ("revision", change), ("load", load)):
        store.commit(batch, changes)
    return store.totals()


@_query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@_query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark, documents(spark, sf_dir))


@_query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.encode_documents(spark, documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


@_query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(spark, documents(spark, sf_dir))


ORACLE["op11_exact_dedup"] = exact_dedup.SQL


@_query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(spark, documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


ORACLE["op12_ranked_search"] = ranked_search.SQL


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.manifest(spark, documents(spark, sf_dir)))
