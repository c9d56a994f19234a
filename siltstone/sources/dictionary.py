"""The tag dictionary: a text file with one entry per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import right_strip


def dictionary_lines(lines: DataFrame, line: str | Column = "value") -> DataFrame:
    """Entries from a column of lines, right-stripped."""
    return lines.select(right_strip(line).alias("term"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a dictionary file. The file is only read, never rewritten."""
    return dictionary_lines(spark.read.text(path))


def duplicate_entries(entries: DataFrame) -> DataFrame:
    """Entries listed more than once, with their number."""
    return entries.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def sorted_entries(entries: DataFrame) -> DataFrame:
    """Entries by code point."""
    return entries.orderBy("term")
