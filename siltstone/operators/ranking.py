"""Frequency tables with running numbers and relative weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.counts import top_terms
from siltstone.session import scratch_path

# Header and line format of the printed table, and the words a word cloud shows.
TABLE_HEADER = "Id |Term           |Count|"
TABLE_FORMAT = '%3d|"%-15s"|%-5d|'
CLOUD_WORDS = 200


def number_rows(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """Running number 1, 2, ... over the whole table in the given total order.

    No task sees more than one range of the order: rows are range-partitioned, written once with
    their range number, counted per range, and numbered inside the range on top of the offset of
    the ranges before it. The written table keeps the ranges fixed when executors are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)

    # One row per range, so this window is as small as the number of partitions.
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.withColumn("_inside", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
        .select((F.col("_before") + F.col("_inside")).alias(name), *df.columns)
    )


def frequency_table(counts: DataFrame, limit: int | None = None) -> DataFrame:
    """Terms by falling count with their number and printed line.

    With ``limit`` the table is a top-k report and is numbered in one bounded window; without it
    the whole table is numbered in a distributed way.
    """
    order = [F.desc("n"), F.asc("term")]
    if limit is None:
        table = number_rows(counts.select("term", "n"), order)
    else:
        rows = Window.partitionBy(F.lit(0)).orderBy(*order)
        table = top_terms(counts, limit).select(F.row_number().over(rows).cast("long").alias("id"), "term", "n")
    return table.withColumn("line", F.format_string(TABLE_FORMAT, "id", "term", "n"))


def print_frequency_table(counts: DataFrame, limit: int = CLOUD_WORDS) -> None:
    """Print the top of the table."""
    print(TABLE_HEADER)
    print("-" * len(TABLE_HEADER))
    for row in frequency_table(counts, limit).orderBy("id").collect():
        print(row["line"])


def relative_weights(counts: DataFrame, words: int | None = None) -> DataFrame:
    """All words, or the most frequent ones, with their count relative to the largest one."""
    largest = counts.agg(F.max("n").alias("n")).scalar()
    rows = counts if words is None else top_terms(counts, words)
    return rows.select("term", "n", (F.col("n") / largest).alias("weight"))
