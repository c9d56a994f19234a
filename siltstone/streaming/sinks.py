"""One-shot incremental sinks: append, complete, keyed upsert, keyed update, console and running count.

Each call processes what is new since the last one and commits its progress to a checkpoint. It
returns when it is done, or at once with ``wait=False``; it gives the streaming query either way.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from siltstone.operators.counts import row_count
from siltstone.operators.incremental import latest_per_key
from siltstone.sources import keyed
from siltstone.sources.tables import TableSpec, read_table


def _run(writer: DataStreamWriter, wait: bool) -> StreamingQuery:
    query = writer.trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def append_to_table(
    df: DataFrame, table: TableSpec, output_mode: str = "append", wait: bool = True
) -> StreamingQuery:
    """Append new rows; exactly once with the file sink."""
    writer = (
        df.writeStream.format(table.file_format)
        .outputMode(output_mode)
        .option("path", table.data_path)
        .option("checkpointLocation", table.checkpoint_path)
    )
    return _run(writer, wait)


def _run_batches(
    df: DataFrame, table: TableSpec, output_mode: str, write: Callable[[DataFrame, int], None], wait: bool
) -> StreamingQuery:
    writer = (
        df.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", table.checkpoint_path)
    )
    return _run(writer, wait)


def complete_to_table(df: DataFrame, table: TableSpec, wait: bool = True) -> StreamingQuery:
    """Replace a table by the full result of a streaming aggregate after every batch.

    Delta tables do this themselves. In plain files two copies alternate, so a run that dies
    while writing one leaves the other whole. Read the table with :func:`read_complete_table`.
    """
    if table.file_format == "delta":
        return append_to_table(df, table, "complete", wait)

    def write(result: DataFrame, batch_id: int) -> None:
        (
            result.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.format(table.file_format).mode("overwrite").save(f"{table.data_path}/copy={batch_id % 2}")
        )

    return _run_batches(df, table, "complete", write, wait)


def read_complete_table(spark: SparkSession, table: TableSpec) -> DataFrame:
    """The newest copy written by :func:`complete_to_table`."""
    if table.file_format == "delta":
        return read_table(spark, table)
    copies = read_table(spark, _with_columns(table, "batch_id", "copy"))
    newest = copies.agg(F.max("batch_id").alias("batch_id")).scalar()
    return copies.where(F.col("batch_id") == newest).drop("batch_id", "copy")


def upsert_to_table(
    df: DataFrame, table: TableSpec, key: str, order: Sequence[str], wait: bool = True
) -> StreamingQuery:
    """Keyed append: a later row with the same key replaces the earlier one.

    A batch is reduced to its last row per key and stored under its batch number (see
    :mod:`siltstone.sources.keyed`), so writing costs as much as the batch and not as much as the
    table, and a replayed batch overwrites itself. Batches go on counting from the checkpoint beside
    the table; whoever deletes that deletes the table with it.
    """
    return _run_batches(df, table, "append", lambda batch, batch_id: _store(latest_per_key(batch, key, order), table, key, batch_id), wait)


def update_to_table(df: DataFrame, table: TableSpec, key: str, wait: bool = True) -> StreamingQuery:
    """Follow a streaming aggregate in update mode: each batch stores only the keys whose result changed.

    The aggregate has one row per ``key``. Read the table with :func:`read_keyed_table`.
    """
    return _run_batches(df, table, "update", lambda batch, batch_id: _store(batch, table, key, batch_id), wait)


def _store(rows: DataFrame, table: TableSpec, key: str, batch_id: int) -> None:
    if table.file_format == "delta":
        (
            rows.withColumn("batch", F.lit(batch_id).cast("long"))
            .write.format("delta").mode("overwrite").option("replaceWhere", f"batch = {batch_id}")
            .save(table.data_path)
        )
    else:
        keyed.put_batch(rows, table, key, batch_id)


def read_keyed_table(
    spark: SparkSession, table: TableSpec, key: str, values: Sequence | None = None, columns: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key: the one of the newest batch that has the key; with ``values`` only of these keys.

    With ``columns`` it has the key and these columns, made before versions are shuffled by key.
    """
    if table.file_format == "delta":
        versions = read_table(spark, _with_columns(table, "batch"))
        versions = versions if columns is None else versions.select(key, *columns, "batch")
        rows = latest_per_key(versions, key, ["batch"]).drop("batch")
        return rows if values is None else rows.where(F.col(key).isin(*values))
    return keyed.read_current(spark, table, key, values, columns)


def compact_keyed_table(spark: SparkSession, table: TableSpec, key: str, retention_seconds: float | None = None) -> list[int]:
    """Merge the buckets that changed since their last merge, then delete what older merges replaced.

    A merge counts once it is in the log, which is written last: a run that dies before is without
    effect. Files are deleted only if ``retention_seconds`` is given, and only those replaced by a
    merge at least that old.
    """
    merged = keyed.merge_buckets(spark, table, key)
    if retention_seconds is not None:
        keyed.vacuum(spark, table, retention_seconds)
    return merged


def _with_columns(table: TableSpec, *names: str) -> TableSpec:
    """The table with the columns a sink adds, where its schema is given."""
    if table.schema is None:
        return table
    added = [T.StructField(name, T.LongType()) for name in names]
    return replace(table, schema=T.StructType(table.schema.fields + added))


class _Progress(StreamingQueryListener):
    """Collects what every batch of a query observed; ``ended`` is set after the last of them."""

    def __init__(self, name: str):
        self.name, self.rows, self.ended = name, {}, {}

    def end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is not None:
            self.rows.setdefault(str(progress.runId), {})[progress.batchId] = seen["rows"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


def counted_stream(df: DataFrame, start: Callable[[DataFrame], StreamingQuery], seconds: float = 60.0) -> dict[int, int]:
    """Run a one-shot stream and give the rows of each of its batches, counted in the same pass.

    ``start`` starts the query over the stream it is given and may wait for its end. Progress is told after
    the fact, so this waits up to ``seconds`` for the last of it once the query has ended. A batch without new
    rows may be missing. A query that fails raises its error here.
    """
    progress = _Progress(f"rows_{uuid.uuid4().hex}")
    streams = df.sparkSession.streams
    streams.addListener(progress)
    try:
        query = start(df.observe(progress.name, F.count(F.lit(1)).alias("rows")))
        query.awaitTermination()
        run = str(query.runId)
        if not progress.end_of(run).wait(seconds):
            raise TimeoutError("the progress of the stream has not been told")
        return progress.rows.get(run, {})
    finally:
        streams.removeListener(progress)


def show_stream(df: DataFrame, description: str = "", with_count: bool = True, output_mode: str = "append") -> None:
    """Print a stream once and, if asked, its total row count, both from one query.

    In complete mode the count is that of the last result, else of all rows given.
    """
    print(f"console: {description}")

    def start(rows: DataFrame) -> StreamingQuery:
        return _run(rows.writeStream.format("console").outputMode(output_mode), wait=True)

    if not with_count:
        start(df)
        return
    rows = counted_stream(df, start)
    total = rows.get(max(rows), 0) if rows and output_mode == "complete" else sum(rows.values())
    print(f"rows: {total}")


def count_to_table(df: DataFrame, table: TableSpec, wait: bool = True) -> StreamingQuery:
    """Running total of a stream, kept in a complete table."""
    return complete_to_table(row_count(df, "row_count"), table, wait)
