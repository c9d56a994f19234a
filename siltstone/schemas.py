"""Row shapes of the record stream and of the tables built from it."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])

BRONZE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("collect_id", T.IntegerType()),
])

POSTING_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("overview", T.StringType()),
    T.StructField("requirement", T.StringType()),
    T.StructField("benefit", T.StringType()),
    T.StructField("company", T.StringType()),
])

SILVER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("collect_id", T.IntegerType()),
    *POSTING_SCHEMA.fields,
])

GOLD_TAG_SCHEMA = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("tag_post_count", T.LongType()),
])

GOLD_COMPANY_SCHEMA = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("company_post_count", T.LongType()),
])

# The plain index holds the silver row; the analysed index adds a term array per text field.
INDEX_SCHEMA = SILVER_SCHEMA
ANALYSED_FIELDS = ("overview", "requirement", "benefit")
ANALYSED_INDEX_SCHEMA = T.StructType([
    *INDEX_SCHEMA.fields,
    T.StructField("tags_terms", T.ArrayType(T.StringType())),
    *[T.StructField(f"{name}_terms", T.ArrayType(T.StringType())) for name in ANALYSED_FIELDS],
])
