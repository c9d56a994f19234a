"""Stages of the training-data pipeline: each applies one operator to all that the stage before kept.

All but the last return the columns of ``documents``. Nulls, repeated rows and empty tables are as the
operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.jaccard import near_duplicates
from siltstone.llm.packing import packed
from siltstone.llm.secrets import redacted
from siltstone.llm.shared import checked_broadcast, written
from siltstone.llm.tiling import decontaminated
from siltstone.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once; one without id only if none has one."""
    # A document is an id (or none) and a text: its hash stands for the id, so rows without id are told apart.
    node = F.xxhash64(F.col("doc_id").cast("long"), "text")
    found = near_duplicates(docs.select(node.alias("doc_id"), "text")).filter("n_shingles > 0")
    found = found.groupBy(F.col("doc_id").alias("node")).agg(F.min("component_id").alias("component"), F.count("*").alias("copies"))
    ids = docs.select(node.alias("node"), F.col("doc_id").cast("long").alias("id")).distinct()
    found = written(found.join(ids, "node"), "found")
    stay = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("lost"), "id", "node")).alias("least"))
    stay = written(stay.select(F.col("least.node").alias("node")), "stay")
    # Numbers of documents to drop, and of those to keep once: sent to all tasks only if they were counted to be few.
    gone = written(found.join(stay, "node", "left_anti").select(F.col("node").alias("gone_node")), "gone")
    again = written(found.filter("copies > 1").join(stay, "node", "left_semi").select(F.col("node").alias("gone_node")), "again")
    n_gone, n_again = gone.count(), again.count()
    kept = docs.join(checked_broadcast(gone, n_gone), node == F.col("gone_node"), "left_anti") if n_gone else docs
    if not n_again:
        return kept
    again = checked_broadcast(again, n_again)
    row = F.struct(*docs.columns)
    one = kept.join(again, node == F.col("gone_node"), "left_semi").groupBy(node.alias("node")).agg(F.min_by(row, F.to_json(row)).alias("row"))
    return kept.join(again, node == F.col("gone_node"), "left_anti").union(one.select("row.*"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which an item of the benchmark leaked go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes."""
    masked = redacted(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with their ids."""
    return packed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: The learned and tokenised stages can't be told in SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every result but the last is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
