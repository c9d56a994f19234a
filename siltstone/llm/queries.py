"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.jaccard import near_duplicates
from siltstone.llm.licenses import license_scan
from siltstone.llm.line_rules import line_rules
from siltstone.llm.packing import packed
from siltstone.llm.periodic import word_runs
from siltstone.llm.postings import nearest
from siltstone.llm.repair import repaired
from siltstone.llm.secrets import secret_scan
from siltstone.llm.sentences import without_repeated_spans
from siltstone.llm.style_tree import main_texts
from siltstone.llm.suffixes import without_repeated_bytes
from siltstone.llm.tiling import leaks
from siltstone.llm.toxicity import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_diagonal_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_table(spark, sf_dir, "pages"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that are left, and what was removed from them."""
    return without_repeated_spans(_table(spark, sf_dir, "documents"))


def op4_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_bytes(_table(spark, sf_dir, "documents"), kept=False)


def op5_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), with_ids=False)


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(_table(spark, sf_dir, "documents")).drop("removed_lines")


def op7_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_table(spark, sf_dir, "documents"))


def op8_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_partenum_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item of which it holds enough."""
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_four_russians_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(_table(spark, sf_dir, "conversations"))


def op12_balanced_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs(_table(spark, sf_dir, "documents"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op")}
