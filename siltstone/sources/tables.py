"""Path-addressed tables: descriptor, batch and stream reads, batch writes, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File formats of Spark itself; delta needs its connector on the classpath.
FORMATS = ("parquet", "orc", "json", "delta")


@dataclass(frozen=True)
class TableSpec:
    """A table below a base path, with its stream checkpoint beside the data.

    Plain files need ``schema`` for stream reads; delta tables carry their own.
    """

    base_path: str
    file_format: str = "parquet"
    schema: T.StructType | None = None

    def __post_init__(self):
        check_format(self.file_format)

    @property
    def data_path(self) -> str:
        return f"{self.base_path.rstrip('/')}/data"

    @property
    def checkpoint_path(self) -> str:
        return f"{self.base_path.rstrip('/')}/checkpoint"


def check_format(file_format: str) -> None:
    if file_format not in FORMATS:
        raise NotImplementedError(f"file format {file_format!r} is not one of {', '.join(FORMATS)}")


def read_files(
    spark: SparkSession, path: str, file_format: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Batch read of files in one of the known formats."""
    check_format(file_format)
    reader = spark.read.format(file_format)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_table(spark: SparkSession, table: TableSpec) -> DataFrame:
    return read_files(spark, table.data_path, table.file_format, table.schema)


def read_table_stream(spark: SparkSession, table: TableSpec, files_per_batch: int | None = None) -> DataFrame:
    """Incremental read of a table; ``files_per_batch`` cuts a long backlog into batches."""
    reader = spark.readStream.format(table.file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (reader.schema(table.schema) if table.schema is not None else reader).load(table.data_path)


def write_table(df: DataFrame, table: TableSpec, mode: str = "overwrite") -> None:
    df.write.format(table.file_format).mode(mode).save(table.data_path)


def table_report(df: DataFrame) -> DataFrame:
    """One row: number of non-empty partitions and of rows."""
    return (
        df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
        .agg(F.count("*").alias("partitions"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
    )


def counted(df: DataFrame, action: Callable[[DataFrame], object]) -> int:
    """Run an action that reads all rows once, and give their number, counted in the same pass.

    For reports: if a lost executor's rows are computed again before a shuffle, they may count twice.
    """
    seen = Observation()
    action(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


#: Bits of a row's number inside its partition, in ``monotonically_increasing_id``.
ROW_BITS = 33


def first_and_total(df: DataFrame, n: int = 20) -> tuple[list[Row], int]:
    """The first rows and the number of all rows, by one job. A task sends at most ``n`` rows to the last one."""
    place, first = "_place", []

    def take(rows: DataFrame) -> None:
        # The explode hides a small known size: the planner would drop the limit then and sort whole, reading twice.
        placed = rows.withColumn(place, F.explode(F.array(F.monotonically_increasing_id())))
        heads = placed.where(F.col(place).bitwiseAND((1 << ROW_BITS) - 1) < n)
        first.extend(heads.orderBy(place).limit(n).drop(place).collect())

    total = counted(df, take)
    return first, total


def show_table(df: DataFrame, truncate: bool = True) -> None:
    """Print the first rows and the total count, from one pass."""
    first, total = first_and_total(df)
    df.sparkSession.createDataFrame(first, df.schema).show(truncate=truncate)
    print(f"rows: {total}")


def show_table_info(
    spark: SparkSession, table: TableSpec | None = None, path: str | None = None, file_format: str = "parquet"
) -> None:
    """Print the partition count, the first rows and the total of a table or of a base path."""
    if table is None:
        if not path:
            raise ValueError("give a table, or a path and a format")
        table = TableSpec(path, file_format)
    df = read_table(spark, table)
    print(f"number of partitions: {df.rdd.getNumPartitions()}")
    show_table(df)
