"""One pass over a stream to several sinks, under one batch number.

Every batch is computed once and held while its sinks are written one after the other. Each sink that is done
leaves a row in a commit table, and the batch leaves one last row when all are. A run that dies between two
sinks is given the same batch again: sinks with a row are passed over and the others are written. A sink that
died before its row came is written again, so sinks are functions of (batch, batch number) that may be called
twice: those here replace the folder of that number, or look into the log of their keyed table first.

A batch is held in memory and on disk; what a lost executor held is computed again from the source. Bound the
batches at the source (``files_per_batch``). The commit table has a folder per batch; a batch reads only its own.
Tables of plain files only. An empty batch commits like any other; NULL keys are keys like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.incremental import latest_per_key
from siltstone.sources import keyed
from siltstone.sources.tables import TableSpec, counted, read_table

#: Writes a batch under its number and gives the rows it took, or None if that batch was there already.
Sink = Callable[[DataFrame, int], int | None]

#: Name in the commit row that is written when all sinks of a batch are done.
WHOLE = "*"
COMMIT = "sink string, row_count long, at timestamp"


def fan_out(df: DataFrame, commits: TableSpec, sinks: dict[str, Sink], wait: bool = True) -> StreamingQuery:
    """Write what is new in a stream to all sinks, in their order. Progress is kept beside the commit table."""
    if not sinks or WHOLE in sinks:
        raise ValueError(f"give sinks with names other than {WHOLE!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, commits, sinks)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", commits.checkpoint_path)
    query = writer.trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def write_batch(batch: DataFrame, batch_id: int, commits: TableSpec, sinks: dict[str, Sink]) -> None:
    """Write one batch to the sinks that have not committed it."""
    spark = batch.sparkSession
    done = committed_sinks(spark, commits, batch_id)
    if WHOLE in done:
        return
    held = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, sink in sinks.items():
            if name not in done:
                _commit(spark, commits, batch_id, name, sink(held, batch_id))
        _commit(spark, commits, batch_id, WHOLE, None)
    finally:
        held.unpersist()


def _commit(spark: SparkSession, commits: TableSpec, batch_id: int, sink: str, rows: int | None) -> None:
    row = spark.range(1).select(F.lit(sink).alias("sink"), F.lit(rows).cast("long").alias("row_count"), F.current_timestamp().alias("at"))
    row.coalesce(1).write.mode("append").format(commits.file_format).save(f"{commits.data_path}/batch={batch_id}")


def committed_sinks(spark: SparkSession, commits: TableSpec, batch_id: int) -> set[str]:
    """The sinks that have committed a batch; ``WHOLE`` is among them if all have."""
    try:
        rows = spark.read.schema(COMMIT).format(commits.file_format).load(f"{commits.data_path}/batch={batch_id}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {row.sink for row in rows.select("sink").distinct().collect()}


def read_commits(spark: SparkSession, commits: TableSpec) -> DataFrame:
    """All commit rows: batch, sink, row_count, at."""
    return read_table(spark, replace(commits, schema=_batched(T.StructType.fromDDL(COMMIT))))


def _batched(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType())])


def read_batches(spark: SparkSession, table: TableSpec, commits: TableSpec) -> DataFrame:
    """The rows of an :func:`append_batch` table, of whole batches only; others may be half written."""
    rows = read_table(spark, table if table.schema is None else replace(table, schema=_batched(table.schema)))
    # Batches come one after the other, so all before a whole one are whole.
    last = read_commits(spark, commits).where(F.col("sink") == WHOLE).agg(F.max("batch").alias("batch")).scalar()
    return rows.where(F.col("batch") <= last).drop("batch")


# Sinks -----------------------------------------------------------------------------------------


def append_batch(table: TableSpec) -> Sink:
    """Add the rows as a folder of that batch; given again, it is replaced."""

    def write(batch: DataFrame, batch_id: int) -> int:
        path = f"{table.data_path}/batch={batch_id}"
        return counted(batch, lambda rows: rows.write.format(table.file_format).mode("overwrite").save(path))

    return write


def upsert_batch(table: TableSpec, key: str, order: Sequence[str]) -> Sink:
    """Put the last row of every key into a keyed table; read it with ``read_keyed_table``."""

    def write(batch: DataFrame, batch_id: int) -> int | None:
        state = keyed.state_of(batch.sparkSession, table)
        if _is_in(state, batch_id):
            return None
        return counted(latest_per_key(batch, key, order), lambda rows: keyed.put_batch(rows, table, key, batch_id, state=state))

    return write


def add_counts(table: TableSpec, key: str, count: str, count_rows: Callable[[DataFrame], DataFrame]) -> Sink:
    """Add the counts of the batch to those of a keyed table, and store the keys that changed.

    ``count_rows`` makes (key, count) rows of a batch, one a key. The join with the counts so far is on the
    key, and the planner ships the side that it measures to be small.
    """

    def write(batch: DataFrame, batch_id: int) -> int | None:
        state = keyed.state_of(batch.sparkSession, table)
        if _is_in(state, batch_id):
            return None
        fresh = count_rows(batch).select(key, count)
        # Only if some batch had keys: a table without any has no files yet.
        if state.changed:
            before = keyed.read_current(batch.sparkSession, table, key, state=state).select(F.col(key).alias("_key"), F.col(count).alias("_before"))
            fresh = fresh.join(before, F.col(key).eqNullSafe(F.col("_key")), "left").select(
                key, (F.col(count) + F.coalesce("_before", F.lit(0))).alias(count)
            )
        return counted(fresh, lambda rows: keyed.put_batch(rows, table, key, batch_id, state=state))

    return write


def _is_in(state: keyed.State, batch_id: int) -> bool:
    """Whether the log of a keyed table has this batch: then it died between its own log and its commit row."""
    return state.committed is not None and state.committed >= batch_id
