"""Counts of rows, tags, keywords and terms.

Every count is a plain two-phase hash aggregation: rows are pre-aggregated before the shuffle,
so one hot value costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.text import term_parts
from siltstone.session import scratch_path

# Fixed value: term buckets returned by one term aggregation.
TERM_BUCKETS = 10_000
#: Hashed counters of the first pass of ``frequent_term_count``; bounds the rows it shuffles per task and broadcasts.
HASHED_COUNTERS = 1 << 20


def row_count(df: DataFrame, name: str = "count") -> DataFrame:
    """One row with the number of rows; also valid on a stream in complete mode."""
    return df.groupBy().agg(F.count("*").alias(name))


def tag_count(df: DataFrame, tags: str = "tags") -> DataFrame:
    """Rows per tag. A tag twice in one row counts twice; empty and NULL arrays vanish."""
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("tag_post_count"))


def company_count(df: DataFrame, company: str = "company") -> DataFrame:
    """Rows per company."""
    return df.groupBy(F.col(company).alias("company")).agg(F.count("*").alias("company_post_count"))


def keyword_count(df: DataFrame, column: str) -> DataFrame:
    """Documents per exact, unanalysed value."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("term")).agg(F.count("*").alias("n"))


def candidates(counts: DataFrame, name: str, k: int) -> DataFrame:
    """The rows that can be among the k largest by a count.

    A top-k sends k rows of every task to the last one. A histogram of the counts, four bins a doubling,
    tells the bin in which the k-th largest lies; what is in a lower bin goes before. The shuffle of the
    counts serves both.
    """
    level = F.coalesce(F.floor(F.log2(name) * 4), F.lit(-1))
    falling = Window.partitionBy(F.lit(0)).orderBy(F.desc("level"))  # at most 253 rows
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows"))
    reached = levels.withColumn("above", F.sum("rows").over(falling)).where(F.col("above") >= k)
    return counts.where(level >= F.coalesce(reached.agg(F.max("level")).scalar(), F.lit(-1)))


def top_terms(counts: DataFrame, k: int = TERM_BUCKETS) -> DataFrame:
    """The k most frequent terms, ties by term."""
    return candidates(counts, "n", k).orderBy(F.desc("n"), F.asc("term")).limit(k)


def term_count(df: DataFrame, terms: Column, min_doc_count: int = 1, limit: int | None = None) -> DataFrame:
    """Documents per term: each row counts once for each of its distinct terms.

    Terms are made distinct inside the row, so nothing is shuffled by document. ``limit`` gives
    the bucket report (see ``TERM_BUCKETS``); without it all terms are returned.
    """
    each = df.select(F.explode(F.array_distinct(terms)).alias("term"))
    return _reported(each.groupBy("term").agg(F.count("*").alias("n")), min_doc_count, limit)


def text_term_count(df: DataFrame, text: Column | str, min_doc_count: int = 1, limit: int | None = None) -> DataFrame:
    """The same over the analysed terms of a text, whose rows are counted as they are analysed."""
    return _reported(term_parts(df, text).groupBy("term").agg(F.sum("n").alias("n")), min_doc_count, limit)


def _reported(counts: DataFrame, min_doc_count: int, limit: int | None) -> DataFrame:
    if min_doc_count > 1:
        counts = counts.where(F.col("n") >= min_doc_count)
    return counts if limit is None else top_terms(counts, limit)


def frequent_term_count(df: DataFrame, terms: Column, min_doc_count: int, counters: int = HASHED_COUNTERS) -> DataFrame:
    """Documents per term of the terms in at least ``min_doc_count`` rows, without shuffling most rare terms.

    A first pass counts terms by hash in ``counters`` counters: a counter is an upper bound of its terms' counts.
    Only terms whose counter reaches the minimum are shuffled and counted, exactly, in a second pass, so the
    result does not depend on ``counters``. What is saved is the shuffle of rare terms, as long as a counter has
    fewer than ``min_doc_count`` of them on average; the price is that the distinct terms of the rows are written to
    the scratch folder, as both passes need them and analysing costs more. Give more counters for more distinct
    terms. A NULL array has no terms; a NULL term counts like any other.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "terms")
    df.select(F.array_distinct(terms).alias("_terms")).write.option("compression", "zstd").parquet(path)
    bucket = F.pmod(F.xxhash64("term"), F.lit(counters))
    each = spark.read.parquet(path).select(F.explode("_terms").alias("term")).withColumn("_bucket", bucket)
    reached = each.groupBy("_bucket").agg(F.count("*").alias("_most")).where(F.col("_most") >= min_doc_count)
    # At most one number per counter.
    possible = each.join(F.broadcast(reached.select("_bucket")), "_bucket", "left_semi")
    return possible.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= min_doc_count)


def word_frequency(df: DataFrame, tokens: Column, stop_words: list[str] | None = None) -> DataFrame:
    """Occurrences per token, optionally without stop words."""
    words = df.select(F.explode(tokens).alias("term"))
    if stop_words:
        words = words.where(~F.col("term").isin(stop_words))
    return words.groupBy("term").agg(F.count("*").alias("n"))


def most_frequent(counts: DataFrame) -> DataFrame:
    """The one most frequent term, the smallest one on ties."""
    return top_terms(counts, 1)


def frequency_map(counts: DataFrame, key: str, value: str, shards: int = 1) -> DataFrame:
    """Key to count mappings, one per shard by key hash; give as many shards as the keys need tasks."""
    return (
        counts.groupBy(F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard"))
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value).cast("long")))).alias("frequency"))
    )
