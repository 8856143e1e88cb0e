"""The corpus pipeline: raw documents to token ids in training order.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm import decontam, mixing, ppm, simhash, training_order
from kpiloom.session import cut


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: their best code is short enough.  Wordless and null texts go, columns of any name stay."""
    return ppm.known_language(docs)


def _numbered(docs: DataFrame) -> DataFrame:
    """The same columns as c0, c1, …, so that no name can clash with a stage's own."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def _named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"c{k}").alias(name) for k, name in enumerate(docs.columns)])


def simhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least doc_id.

    Rows that repeat an id are taken for copies of one document; rows without an
    id stay, as nothing can name their group's member.  The documents that go
    are joined, not those that stay: they are the fewer ones.
    """
    groups = cut(simhash.simhash_groups(docs, text_key=True).select("doc_id", "text_key", "component_id").where("doc_id is not null"))
    copies = groups.where("doc_id = component_id").groupBy("doc_id", "text_key").agg(F.count("*").alias("times"))
    kept = copies.groupBy("doc_id").agg(F.min(F.struct("text_key", "times")).alias("k")).select("doc_id", "k.*")
    kept = cut(kept)
    # Ids alone say which documents go; texts are asked for only where an id repeats with other texts or rows.
    gone = cut(groups.join(kept, "doc_id", "left_anti").select("doc_id").distinct())
    partly = groups.join(kept.select("doc_id"), "doc_id", "left_semi").join(kept, ["doc_id", "text_key"], "left_anti")
    partly = cut(partly.select("doc_id", "text_key").distinct())
    again = cut(kept.where("times > 1").select("doc_id", "text_key"))

    rows = _numbered(docs)
    ident, text = (rows[f"c{docs.columns.index(c)}"] for c in ("doc_id", "text"))
    rows = rows.withColumns({"own_id": ident, "own_key": F.xxhash64(text)})
    named = lambda keys: (rows["own_id"] == keys["doc_id"]) & (rows["own_key"] == keys["text_key"])
    rows = rows.join(gone, rows["own_id"] == gone["doc_id"], "left_anti")
    if partly.isEmpty() and again.isEmpty():
        return _named(rows, docs)
    once = rows.join(partly.union(again), named(partly), "left_anti")
    nth = F.row_number().over(Window.partitionBy("own_id", "own_key").orderBy("own_key"))
    first = rows.join(again, named(again), "left_semi").withColumn("nth", nth).where("nth = 1")
    return _named(once, docs).union(_named(first, docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts hold none, repeated rows fare alike."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; rows that repeat id and text are matched one to one."""
    taken = mixing.mix(docs, text_key=True).where("epochs > 0").select("doc_id", "text_key", F.col("epochs").cast("int").alias("epochs"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy(F.desc("epochs")))
    taken = taken.withColumn("nth", nth)
    rows = _numbered(docs)
    ident, text = (rows[f"c{docs.columns.index(c)}"] for c in ("doc_id", "text"))
    rows = rows.withColumns({"own_id": ident, "own_key": F.xxhash64(text)})
    rows = rows.withColumn("own_nth", F.row_number().over(Window.partitionBy("own_id", "own_key").orderBy("own_key")))
    same = rows["own_id"].eqNullSafe(taken["doc_id"]) & (rows["own_key"] == taken["text_key"]) & (rows["own_nth"] == taken["nth"])
    copies = rows.join(taken, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
    return _named(copies, docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in training order, a shard to a partition.

    Null and empty texts are one record with the end mark alone, repeated rows repeat their records.
    """
    return training_order.training_order(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_neardup", simhash_neardup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

ORACLE_SQL = None  # PPM, SimHash and the tokenizer are beyond SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
