"""Weighted term points over several fields and their classification with a dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.predicates import is_admissible
from siltstone.functions.text import term_parts
from siltstone.operators.counts import candidates
from siltstone.session import scratch_path

TAG, NOT_TAG, IGNORED = "TAG", "NOT_TAG", "IGNORED"


@dataclass(frozen=True)
class Field:
    """A scored field: points per document and the least number of documents that counts."""

    name: str
    weight: int = 1
    min_doc_count: int = 1


# Weights and minima of the posting fields, in the usual and in the strict form.
POSTING_FIELDS = [
    Field("tags", 6, 1), Field("overview", 1, 3), Field("requirement", 1, 3), Field("benefit", 1, 3),
]
POSTING_FIELDS_STRICT = [
    Field("tags", 6, 1), Field("overview", 1, 10), Field("requirement", 1, 10), Field("benefit", 1, 10),
]


def field_terms(df: DataFrame, terms: dict[str, Column]) -> DataFrame:
    """Rows (field, term): the distinct terms of every named field of every row, in one scan."""
    fields = F.array(*[
        F.struct(F.lit(name).alias("field"), F.array_distinct(column).alias("terms"))
        for name, column in terms.items()
    ])
    return df.select(F.inline(fields)).select("field", F.explode("terms").alias("term"))


def field_parts(df: DataFrame, field: str, text: Column | str) -> DataFrame:
    """Rows (field, term, n) of one text field: partial numbers of rows with the term, see :func:`term_parts`."""
    return term_parts(df, text).select(F.lit(field).alias("field"), "term", "n")


def field_counts(terms: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Documents per term, one column per field, zero below the field's minimum.

    All fields share one shuffle on the term. A row counts once, or ``n`` times where there is such a column.
    """
    times = F.col("n") if "n" in terms.columns else F.lit(1).cast("long")
    counts = terms.groupBy("term").agg(
        *[F.sum(F.when(F.col("field") == field.name, times).otherwise(0)).alias(field.name) for field in fields]
    )
    return counts.select("term", *[
        F.when(F.col(field.name) >= field.min_doc_count, F.col(field.name)).otherwise(F.lit(0)).alias(field.name)
        for field in fields
    ])


def limit_buckets(counts: DataFrame, fields: Sequence[Field], buckets: int) -> DataFrame:
    """Keep, for each field, only the counts of its ``buckets`` most frequent terms.

    The counts are written to the scratch folder first: each field takes its own top from them.
    """
    spark = counts.sparkSession
    path = scratch_path(spark, "buckets")
    counts.write.parquet(path)
    written = spark.read.parquet(path)
    tops = [
        candidates(written.where(F.col(field.name) > 0), field.name, buckets)
        .orderBy(F.desc(field.name), F.asc("term"))
        .limit(buckets)
        .select("term", *[
            (F.col(other.name) if other is field else F.lit(0).cast("long")).alias(other.name) for other in fields
        ])
        for field in fields
    ]
    return reduce(DataFrame.unionByName, tops).groupBy("term").agg(
        *[F.max(field.name).alias(field.name) for field in fields]
    )


def weighted_points(
    terms: DataFrame, fields: Sequence[Field], tag_field: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Points per term: the sum over the fields of weight times document count.

    ``terms`` has the rows of :func:`field_terms` or :func:`field_parts`. With ``tag_field`` a flag ``is_tag`` tells
    whether the term is a bucket of that field. ``buckets`` restricts each field to its most
    frequent terms first, as a bucket report does; by default all terms are scored.
    """
    counts = field_counts(terms, fields)
    if buckets is not None:
        counts = limit_buckets(counts, fields, buckets)
    points = reduce(lambda total, part: total + part, [F.col(field.name) * field.weight for field in fields])
    scored = counts.select(
        "term",
        points.cast("long").alias("points"),
        *([(F.col(tag_field) > 0).alias("is_tag")] if tag_field else []),
    )
    return scored.where(F.col("points") > 0)


def classify(points: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``class``: TAG, NOT_TAG or IGNORED.

    A term is a TAG when it is a bucket of the tag field or an admissible dictionary entry,
    NOT_TAG when it is admissible and neither, else IGNORED. The dictionary is joined without a
    hint: below the broadcast threshold Spark ships it, a larger one is shuffled on the term.
    """
    entries = dictionary.select("term").distinct().withColumn("listed", F.lit(True))
    admissible = is_admissible(F.col("term"))
    listed = F.coalesce(F.col("listed"), F.lit(False))
    return points.join(entries, "term", "left").select(
        *points.columns,
        F.when(F.col("is_tag") | (admissible & listed), TAG)
        .when(admissible, NOT_TAG)
        .otherwise(IGNORED)
        .alias("class"),
    )


def tag_points(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("class") == TAG).select("term", "points")


def other_points(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("class") == NOT_TAG).select("term", "points")


def allowed_terms(terms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct admissible terms that the dictionary lists."""
    return terms.where(is_admissible(F.col("term"))).select("term").distinct().join(dictionary, "term", "left_semi")


def dropped_terms(terms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct admissible terms that the dictionary does not list."""
    return terms.where(is_admissible(F.col("term"))).select("term").distinct().join(dictionary, "term", "left_anti")
