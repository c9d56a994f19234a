import pytest

from siltstone.operators.counts import tag_count
from siltstone.sources.tables import TableSpec, read_table, read_table_stream, write_table
from siltstone.streaming import sinks

SCHEMA = "id bigint, v string, tags array<string>"


@pytest.fixture
def source(spark, path):
    """A table that grows by appends, and a function that appends to it."""
    schema = spark.createDataFrame([], SCHEMA).schema
    table = TableSpec(f"{path}/in", schema=schema)

    def add(*rows):
        write_table(spark.createDataFrame(rows, SCHEMA).coalesce(1), table, "append")

    return table, add


def test_append_processes_only_new_rows(spark, path, source):
    table, add = source
    out = TableSpec(f"{path}/out", schema=table.schema)
    add((1, "a", []), (2, "b", None))
    for expected, extra in [(2, (3, "c", [])), (3, None), (3, None)]:
        sinks.append_to_table(read_table_stream(spark, table), out)
        assert read_table(spark, out).count() == expected
        if extra:
            add(extra)


def test_backlog_in_batches(spark, path, source):
    table, add = source
    out = TableSpec(f"{path}/out")
    for i in range(3):
        add((i, "a", ["sql"]))
    query = sinks.complete_to_table(tag_count(read_table_stream(spark, table, files_per_batch=1)), out)
    assert [progress["batchId"] for progress in query.recentProgress if progress["numInputRows"]] == [0, 1, 2]
    assert sinks.read_complete_table(spark, out).first()["tag_post_count"] == 3


def test_complete_counts_grow_over_runs(spark, path, source):
    table, add = source
    out = TableSpec(f"{path}/out")

    def run():
        sinks.complete_to_table(tag_count(read_table_stream(spark, table)), out)
        return {row["tag"]: row["tag_post_count"] for row in sinks.read_complete_table(spark, out).collect()}

    add((1, "a", ["sql", "c"]), (2, "b", ["sql"]))
    assert run() == {"sql": 2, "c": 1}
    add((3, "c", ["c", "java"]), (4, "d", None))
    assert run() == {"sql": 2, "c": 2, "java": 1}
    assert run() == {"sql": 2, "c": 2, "java": 1}
    add((5, "e", ["java"]))
    assert run() == {"sql": 2, "c": 2, "java": 2}


def test_upsert_replaces_by_key(spark, path, source):
    table, add = source
    out = TableSpec(f"{path}/out", schema=table.schema)

    def run():
        sinks.upsert_to_table(read_table_stream(spark, table), out, "id", ["v"])
        return {tuple(row)[:2] for row in sinks.read_keyed_table(spark, out, "id").collect()}

    add((1, "a", []), (1, "c", []), (1, "b", []), (2, "a", []))
    assert run() == {(1, "c"), (2, "a")}
    add((2, "0", []), (3, "x", []))
    assert run() == {(1, "c"), (2, "0"), (3, "x")}
    assert run() == {(1, "c"), (2, "0"), (3, "x")}


def test_compaction_keeps_the_rows(spark, path, source):
    table, add = source
    out = TableSpec(f"{path}/out", schema=table.schema)

    def run(compact):
        sinks.upsert_to_table(read_table_stream(spark, table), out, "id", ["v"])
        if compact:
            sinks.compact_keyed_table(spark, out, "id")
        rows = sinks.read_keyed_table(spark, out, "id")
        return {tuple(row)[:2] for row in rows.collect()}

    add((1, "a", []), (2, "a", []))
    assert run(True) == {(1, "a"), (2, "a")}
    add((2, "0", []), (3, "x", []))
    assert run(False) == {(1, "a"), (2, "0"), (3, "x")}
    assert run(True) == run(True) == {(1, "a"), (2, "0"), (3, "x")}
    add((1, "z", []))
    assert run(False) == {(1, "z"), (2, "0"), (3, "x")}


@pytest.mark.parametrize("sink", ["upsert", "complete"])
def test_replayed_batch_overwrites_itself(spark, path, monkeypatch, sink):
    out = TableSpec(f"{path}/out")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")

    def replay(df, table, output_mode, write, wait):
        for batch_id in (0, 1, 1):
            write(batch, batch_id)

    monkeypatch.setattr(sinks, "_run_batches", replay)
    if sink == "upsert":
        sinks.upsert_to_table(batch, out, "id", ["v"])
        assert read_table(spark, out).count() == 4
        assert sinks.read_keyed_table(spark, out, "id").count() == 2
    else:
        sinks.complete_to_table(batch, out)
        assert sinks.read_complete_table(spark, out).count() == 2


def test_running_count_and_console(spark, path, source):
    table, add = source
    total = TableSpec(f"{path}/total")
    for i, expected in [(1, 1), (2, 2)]:
        add((i, "a", []))
        sinks.count_to_table(read_table_stream(spark, table), total)
        assert sinks.read_complete_table(spark, total).first()["row_count"] == expected
    sinks.show_stream(read_table_stream(spark, table), "rows")


def test_side_by_side(spark, path, source):
    table, add = source
    add((1, "a", ["sql"]))
    outs = [TableSpec(f"{path}/o{i}") for i in range(2)]
    queries = [sinks.append_to_table(read_table_stream(spark, table), out, wait=False) for out in outs]
    for query in queries:
        query.awaitTermination()
    assert [read_table(spark, out).count() for out in outs] == [1, 1]
