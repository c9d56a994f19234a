"""Keyed tables in plain files: a later row replaces the earlier one of its key.

Layout below the table's data folder: ``level=0`` has the rows of each batch as they came, ``level=1`` the
current rows of a bucket as of a batch; then ``version`` (the batch number) and ``bucket`` (by key hash).
Writing costs as much as the batch. A merge writes only buckets that changed since their last one. A read
takes, per bucket, its last merge and the batches after it; a read of given keys takes their buckets only.

The log beside the data says which batches and merges count. Its entry is written last, so what a killed
write leaves behind is never read and is overwritten by the next try. Replaced files stay until
:func:`vacuum` finds their merge older than the retention time, for the sake of readers still at them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.incremental import latest_per_key
from siltstone.sources.tables import TableSpec, read_table

#: Buckets of a new table; an existing one keeps its own.
BUCKETS = 16
BATCH, MERGE, VACUUM = "batch", "merge", "vacuum"
PLACE = [T.StructField("level", T.IntegerType()), T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())]
LOG = "kind string, bucket int, version long, buckets int, at timestamp"


@dataclass
class State:
    """What the log says: the last whole batch, the last one deleted, and per bucket its last change and merge."""

    committed: int | None = None
    buckets: int | None = None
    vacuumed: int = -1
    changed: dict[int, int] = field(default_factory=dict)
    merged: dict[int, int] = field(default_factory=dict)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _log(spark: SparkSession, table: TableSpec) -> DataFrame | None:
    try:
        return spark.read.schema(LOG).parquet(f"{table.base_path.rstrip('/')}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _append_log(spark: SparkSession, table: TableSpec, kind: str, version: int, places: Iterable[int], buckets: int) -> None:
    row = spark.range(1).select(
        F.lit(kind).alias("kind"), F.explode(F.array(*[F.lit(b) for b in list(places) or [-1]])).alias("bucket"),
        F.lit(version).cast("long").alias("version"), F.lit(buckets).alias("buckets"), F.current_timestamp().alias("at"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{table.base_path.rstrip('/')}/log")


def state_of(spark: SparkSession, table: TableSpec) -> State:
    """The log in one row per kind and bucket."""
    log = _log(spark, table)
    if log is None:
        return State()
    state = State()
    for row in log.groupBy("kind", "bucket").agg(F.max("version").alias("version"), F.max("buckets").alias("buckets")).collect():
        state.buckets = row.buckets
        if row.kind == BATCH:
            state.committed = max(row.version, -1 if state.committed is None else state.committed)
            state.changed[row.bucket] = row.version
        elif row.kind == MERGE:
            state.merged[row.bucket] = row.version
        else:
            state.vacuumed = row.version
    state.changed.pop(-1, None)
    return state


def _with_place(table: TableSpec) -> TableSpec:
    return table if table.schema is None else replace(table, schema=T.StructType(table.schema.fields + PLACE))


def _write(
    rows: DataFrame, table: TableSpec, level: int, version: int, key: str, buckets: int,
    widen: Callable[[DataFrame], DataFrame] = lambda placed: placed,
) -> None:
    placed = rows.withColumns({"level": F.lit(level), "version": F.lit(version).cast("long"), "bucket": bucket_of(F.col(key), buckets)})
    # By bucket, so that a bucket gets few files; one with very many rows is cut by the planner.
    widen(placed.hint("rebalance", "bucket")).write.format(table.file_format).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("level", "version", "bucket").save(table.data_path)


def put_batch(
    rows: DataFrame, table: TableSpec, key: str, version: int, buckets: int = BUCKETS,
    widen: Callable[[DataFrame], DataFrame] = lambda placed: placed, state: State | None = None,
) -> None:
    """Store a batch with one row per key. A batch given again overwrites itself.

    ``widen`` adds columns made of a row alone after the shuffle to the buckets, which so does not carry them.
    A caller that has the ``state`` of the table gives it, and the log is not read again.
    """
    spark = rows.sparkSession
    buckets = (state or state_of(spark, table)).buckets or buckets
    _delete(spark, f"{table.data_path}/level=0/version={version}")
    _write(rows, table, 0, version, key, buckets, widen)
    places = [int(name.split("=")[1]) for name in _folders(spark, f"{table.data_path}/level=0/version={version}")]
    _append_log(spark, table, BATCH, version, places, buckets)


def _visible(state: State) -> tuple[Column, Column]:
    """Conditions on level, version and bucket: what is merged, and what came after."""
    by_merge: dict[int, list[int]] = {}
    for bucket, version in state.merged.items():
        by_merge.setdefault(version, []).append(bucket)
    bucket, version = F.col("bucket"), F.col("version")
    merged = [bucket.isin(buckets) & (version == upto) for upto, buckets in sorted(by_merge.items())]
    later = [bucket.isin(buckets) & (version > upto) for upto, buckets in sorted(by_merge.items())]
    if state.merged:
        later.append(~bucket.isin(list(state.merged)))
    either = lambda parts: reduce(lambda a, b: a | b, parts, F.lit(False)) if parts else F.lit(False)
    later = either(later) if state.merged else F.lit(True)
    return (F.col("level") == 1) & either(merged), (F.col("level") == 0) & (version <= state.committed) & later


def _current(
    spark: SparkSession, table: TableSpec, key: str, state: State, where: Column | None = None, columns: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key; merged rows are read as they are and only lose the keys that changed since."""
    versions = read_table(spark, _with_place(table))
    if columns is not None:
        versions = versions.select(key, *columns, "level", "version", "bucket")
    names = [name for name in versions.columns if name not in ("level", "version", "bucket")]
    if where is not None:
        versions = versions.where(where)
    merged, later = _visible(state) if state.committed is not None else (F.lit(False), F.lit(False))
    fresh = latest_per_key(versions.where(later).select(*names, "version"), key, ["version"]).select(*names)
    if not state.merged:
        return fresh
    changed = versions.where(later).select(F.col(key).alias("_changed")).distinct()
    kept = versions.where(merged).join(changed, F.col(key).eqNullSafe(F.col("_changed")), "left_anti")
    return kept.select(*names).unionByName(fresh)


def read_current(
    spark: SparkSession, table: TableSpec, key: str, values: Sequence | None = None, columns: Sequence[Column] | None = None,
    state: State | None = None,
) -> DataFrame:
    """The current rows; with ``values`` those of these keys, read from their buckets alone.

    With ``columns`` the key and these columns of a row, made before versions are shuffled by key. With ``state``
    the rows as of then, and the log is not read.
    """
    state = state or state_of(spark, table)
    where = None
    if values is not None and state.buckets:
        kind = read_table(spark, _with_place(table)).schema[key].dataType
        wanted = [F.lit(v).cast(kind) for v in values]
        buckets = [bucket_of(v, state.buckets) for v in wanted]
        where = F.col("bucket").isin(buckets) & reduce(lambda a, b: a | b, [F.col(key).eqNullSafe(v) for v in wanted], F.lit(False))
    return _current(spark, table, key, state, where, columns)


def changes_after(spark: SparkSession, table: TableSpec, key: str, version: int | None) -> tuple[DataFrame, int | None]:
    """The change feed: the last row of every key stored by batches after one, and the last batch.

    If some of these batches were deleted, it gives all current rows instead.
    """
    state = state_of(spark, table)
    if version is None or version < state.vacuumed:
        return _current(spark, table, key, state), state.committed
    versions = read_table(spark, _with_place(table))
    names = [name for name in versions.columns if name not in ("level", "version", "bucket")]
    upto = -1 if state.committed is None else state.committed
    rows = versions.where((F.col("level") == 0) & (F.col("version") > version) & (F.col("version") <= upto))
    return latest_per_key(rows.select(*names, "version"), key, ["version"]).select(*names), state.committed


def merge_buckets(spark: SparkSession, table: TableSpec, key: str) -> list[int]:
    """Write the current rows of every bucket that changed since its last merge; gives these buckets."""
    state = state_of(spark, table)
    changed = sorted(b for b, version in state.changed.items() if version > state.merged.get(b, -1))
    if changed:
        rows = _current(spark, table, key, state, F.col("bucket").isin(changed))
        _write(rows, table, 1, state.committed, key, state.buckets)
        _append_log(spark, table, MERGE, state.committed, changed, state.buckets)
    return changed


def vacuum(spark: SparkSession, table: TableSpec, retention_seconds: float = 86_400.0) -> int:
    """Delete files that a merge older than the retention time replaced; gives the number of folders."""
    log = _log(spark, table)
    if log is None:
        return 0
    old = log.where((F.col("kind") == MERGE) & (F.col("at") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(retention_seconds))))
    upto = {row.bucket: row.version for row in old.groupBy("bucket").agg(F.max("version").alias("version")).collect()}
    deleted = 0
    for level in (0, 1):
        for name in _folders(spark, f"{table.data_path}/level={level}"):
            folder, version = f"{table.data_path}/level={level}/{name}", int(name.split("=")[1])
            inside = _folders(spark, folder)
            gone = [b for b in inside if version <= upto.get(int(b.split("=")[1]), -1) - level]
            for bucket in gone:
                deleted += _delete(spark, f"{folder}/{bucket}")
            if len(gone) == len(inside):
                _delete(spark, folder)
    if deleted:
        _append_log(spark, table, VACUUM, max(upto.values()), [], state_of(spark, table).buckets)
    return deleted


# Folders, by the file system of the path ----------------------------------------------------------


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> list[str]:
    path, store = _path(spark, path)
    if not store.exists(path):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(path) if status.isDirectory() and "=" in status.getPath().getName())


def _delete(spark: SparkSession, path: str) -> bool:
    path, store = _path(spark, path)
    return store.exists(path) and store.delete(path, True)
