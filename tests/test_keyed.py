"""Keyed tables: buckets, merges, replays, kills, point reads, change feed, update mode."""

import os

import pytest
from pyspark.sql import functions as F

from siltstone.operators.counts import tag_count
from siltstone.plans import medallion
from siltstone.sources import keyed
from siltstone.sources.tables import TableSpec, read_table_stream, write_table
from siltstone.streaming import sinks

SCHEMA = "id bigint, v string"


def rows(spark, *found):
    return spark.createDataFrame(found, SCHEMA)


def current(spark, table, values=None):
    return {tuple(r) for r in keyed.read_current(spark, table, "id", values).collect()}


def folders(table, level):
    top = f"{table.data_path}/level={level}"
    return sorted(f"{v}/{b}" for v in os.listdir(top) if "=" in v for b in os.listdir(f"{top}/{v}") if "=" in b) if os.path.isdir(top) else []


@pytest.fixture(params=[None, SCHEMA])
def table(spark, path, request):
    schema = None if request.param is None else rows(spark).schema
    return TableSpec(f"{path}/t", schema=schema)


def test_merge_touches_changed_buckets_and_vacuum_deletes(spark, table):
    keyed.put_batch(spark.range(200).select("id", F.lit("a").alias("v")), table, "id", 0, buckets=8)
    assert keyed.merge_buckets(spark, table, "id") == list(range(8))
    keyed.put_batch(rows(spark, (3, "b"), (1000, "n"), (None, "null key")), table, "id", 1)
    expected = {(k, "b" if k == 3 else "a") for k in range(200)} | {(1000, "n"), (None, "null key")}
    assert current(spark, table) == expected
    changed = {r[0] for r in rows(spark, (3, ""), (1000, ""), (None, "")).select(keyed.bucket_of(F.col("id"), 8)).collect()}
    assert keyed.merge_buckets(spark, table, "id") == sorted(changed)
    assert len([f for f in folders(table, 1) if f.startswith("version=1/")]) == len(changed)
    assert current(spark, table) == expected and keyed.merge_buckets(spark, table, "id") == []
    assert keyed.vacuum(spark, table, 3600) == 0  # too young
    assert keyed.vacuum(spark, table, 0) == 8 + len(changed) + len(changed)
    assert folders(table, 0) == [] and len(folders(table, 1)) == 8
    assert current(spark, table) == expected


def test_point_read_scans_one_bucket(spark, table):
    keyed.put_batch(spark.range(500).select("id", F.lit("a").alias("v")), table, "id", 0, buckets=8)
    keyed.merge_buckets(spark, table, "id")
    keyed.put_batch(rows(spark, (7, "b")), table, "id", 1)
    read = keyed.read_current(spark, table, "id", [7])
    assert {tuple(r) for r in read.collect()} == {(7, "b")}
    scanned = {p.split("bucket=")[1].split("/")[0] for p in keyed.read_current(spark, table, "id", [8]).inputFiles()}
    plan = keyed.read_current(spark, table, "id", [8])._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:400] and scanned
    metrics = spark.read.parquet(table.data_path).where(F.col("bucket") == keyed.bucket_of(F.lit(8).cast("long"), 8))
    assert metrics.select("bucket").distinct().count() == 1
    assert current(spark, table, [8, 10**6]) == {(8, "a")} and current(spark, table, [None]) == set()


def test_replay_and_killed_writes(spark, table, monkeypatch):
    keyed.put_batch(rows(spark, (1, "a"), (2, "a")), table, "id", 0)
    keyed.put_batch(rows(spark, (2, "b")), table, "id", 1)
    keyed.put_batch(rows(spark, (2, "b")), table, "id", 1)
    assert current(spark, table) == {(1, "a"), (2, "b")}
    with monkeypatch.context() as m:
        m.setattr(keyed, "_append_log", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        for step in (lambda: keyed.merge_buckets(spark, table, "id"), lambda: keyed.put_batch(rows(spark, (1, "half"), (5, "half")), table, "id", 2)):
            with pytest.raises(RuntimeError):
                step()
    assert folders(table, 1) and current(spark, table) == {(1, "a"), (2, "b")}
    keyed.put_batch(rows(spark, (1, "c")), table, "id", 2)
    assert current(spark, table) == {(1, "c"), (2, "b")}
    keyed.merge_buckets(spark, table, "id")
    assert current(spark, table) == {(1, "c"), (2, "b")}


def test_empty_batches(spark, table):
    keyed.put_batch(rows(spark), table, "id", 0)
    keyed.put_batch(rows(spark, (1, "a")), table, "id", 1)
    keyed.put_batch(rows(spark), table, "id", 2)
    assert current(spark, table) == {(1, "a")} and keyed.state_of(spark, table).committed == 2


def test_update_mode_writes_changed_keys_only(spark, path):
    schema = "id bigint, tags array<string>"
    source, gold = TableSpec(f"{path}/in", schema=spark.createDataFrame([], schema).schema), TableSpec(f"{path}/gold")

    def run(df):
        write_table(df.coalesce(1), source, "append")
        sinks.update_to_table(tag_count(read_table_stream(spark, source)), gold, "tag")
        return {r["tag"]: r["tag_post_count"] for r in sinks.read_keyed_table(spark, gold, "tag").collect()}

    many = spark.range(3000).select("id", F.array(F.concat(F.lit("t"), "id")).alias("tags"))
    assert len(run(many)) == 3000
    found = run(spark.createDataFrame([(1, ["t1", "new"]), (2, ["new", "x"]), (3, None)], schema))
    assert len(found) == 3002 and found["t1"] == 2 and found["new"] == 2 and found["x"] == found["t2"] == 1
    written = spark.read.parquet(gold.data_path).groupBy("version").count()
    assert {r["version"]: r["count"] for r in written.collect()} == {0: 3000, 1: 3}
    assert sinks.compact_keyed_table(spark, gold, "tag", retention_seconds=0)
    assert sinks.read_keyed_table(spark, gold, "tag").count() == 3002


def test_change_feed_and_refreshed_copy(spark, path):
    index, copy = TableSpec(f"{path}/index"), TableSpec(f"{path}/copy")
    schema = "id bigint, overview string, tags array<string>"

    def refresh():
        changed = medallion.refresh_analysed_copy(spark, index, copy, text_fields=("overview",))
        return {r["id"] for r in changed.collect()}

    def whole():
        read = lambda df: {r["id"]: (r["overview"], r["overview_terms"], r["tags_terms"]) for r in df.collect()}
        full = medallion.analysed_copy(keyed.read_current(spark, index, "id"), ("overview",))
        return read(sinks.read_keyed_table(spark, copy, "id")) == read(full)

    keyed.put_batch(spark.createDataFrame([(k, f"text {k}", ["sql"]) for k in range(50)], schema), index, "id", 0)
    assert refresh() == set(range(50)) and whole()
    keyed.put_batch(spark.createDataFrame([(3, "other java", ["c#"]), (60, "new", None)], schema), index, "id", 1)
    keyed.put_batch(spark.createDataFrame([(3, "last java", ["c#"])], schema), index, "id", 2)
    assert refresh() == {3, 60} and whole()
    assert refresh() == set() and whole()
    # Batches that were deleted before the copy saw them: all current rows are analysed.
    keyed.put_batch(spark.createDataFrame([(4, "java", None)], schema), index, "id", 3)
    sinks.compact_keyed_table(spark, index, "id", retention_seconds=0)
    assert len(refresh()) == 51 and whole()


def test_term_arrays_are_not_shuffled(spark, path):
    index, copy = TableSpec(f"{path}/index"), TableSpec(f"{path}/copy")
    texts = spark.createDataFrame([(1, "red blue", "long"), (2, "old", "long"), (None, "x y", None)], "id long, text string, other string")
    plans = []
    widened = medallion.analysed_copy
    keyed.put_batch(texts, index, "id", 0)
    with pytest.MonkeyPatch.context() as patch:
        def seen(rows, *args, **kwargs):
            plans.append(rows._jdf.queryExecution().analyzed().toString())
            return widened(rows, *args, **kwargs)

        patch.setattr(medallion, "analysed_copy", seen)
        medallion.refresh_analysed_copy(spark, index, copy, "id", text_fields=("text",), tags=None)
    assert any("RebalancePartitions" in plan or "rebalance" in plan for plan in plans)
    keyed.put_batch(texts.where("id = 2").withColumn("text", F.lit("new words")), index, "id", 1)
    medallion.refresh_analysed_copy(spark, index, copy, "id", text_fields=("text",), tags=None)
    read = sinks.read_keyed_table(spark, copy, "id", columns=[F.size("text_terms").alias("terms")])
    assert read.columns == ["id", "terms"]
    whole = sinks.read_keyed_table(spark, copy, "id").select("id", F.size("text_terms"))
    assert {tuple(r) for r in read.collect()} == {tuple(r) for r in whole.collect()} == {(1, 3), (2, 3), (None, 3)}
    shuffled = read._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(line for line in shuffled.splitlines() if "Aggregate" in line)
    assert "text_terms" not in aggregate and "other" not in aggregate
