"""The record stream: Kafka source and sink, and the same record shape read from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.records import encode_payload, header, header_text
from siltstone.schemas import RECORD_SCHEMA


def read_kafka_stream(
    spark: SparkSession, bootstrap_servers: str, topic: str, offsets_per_batch: int | None = None
) -> DataFrame:
    """One topic from its beginning, headers included. Needs Spark's Kafka connector.

    ``offsets_per_batch`` cuts a long backlog into batches.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", True)
    )
    return (reader.option("maxOffsetsPerTrigger", offsets_per_batch) if offsets_per_batch else reader).load()


def read_record_files(
    spark: SparkSession, path: str, file_format: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A stream of records stored as files, in the column layout of a Kafka source."""
    reader = spark.readStream.format(file_format).schema(RECORD_SCHEMA)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def to_messages(
    df: DataFrame, message: Column, headers: dict[str, Column], key: Column | None = None, topic: str | None = None
) -> DataFrame:
    """Columns key, value, headers (and topic) of outgoing messages; the value is JSON text."""
    return df.select(
        (F.lit(None) if key is None else key).cast("binary").alias("key"),
        encode_payload(message).cast("binary").alias("value"),
        F.array(*[header(name, value) for name, value in headers.items()]).alias("headers"),
        *([F.lit(topic).alias("topic")] if topic else []),
    )


def write_kafka(messages: DataFrame, bootstrap_servers: str, topic: str | None = None) -> None:
    """Send messages; ``topic`` is the default one. Needs Spark's Kafka connector."""
    writer = (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("includeHeaders", True)
    )
    (writer.option("topic", topic) if topic else writer).save()


def value_text(records: DataFrame) -> DataFrame:
    """The raw stream's value as text."""
    return records.select(F.col("value").cast("string").alias("value"))


def to_bronze(records: DataFrame) -> DataFrame:
    """Record stream to bronze rows: payload text, position, and the two provenance headers."""
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.col("partition").cast("long").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        "timestamp",
        "timestampType",
        header_text(F.col("headers"), "source", 1).alias("source"),
        header_text(F.col("headers"), "collect_id", 2).try_cast("int").alias("collect_id"),
    )
