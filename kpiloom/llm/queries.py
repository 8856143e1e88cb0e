"""The registered text queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import (
    collocations,
    decontam,
    hnsw,
    lexical_search,
    line_crf,
    mixing,
    ppm,
    quotes,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    training_order,
)
from kpiloom.llm.oracles import ORACLES  # noqa: F401  (registered beside the queries)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.identify(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", F.array_join("item_ids", ",").alias("items"))


def op7_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_replies(_table(spark, sf_dir, "conversations"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.training_order(_table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(sharding.shard(_table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = lexical_search.index(_table(spark, sf_dir, "documents"))
    return lexical_search.search(shards, _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_embedding_neardup,
        op3_mixing,
        op4_language_id,
        op5_quality,
        op6_decontamination,
        op7_chat_quotes,
        op8_suffix_dedup,
        op9_simhash_neardup,
        op10_training_order,
        op11_sharding,
        op12_collocations,
        op13_lexical_search,
        pipeline,
    )
}
