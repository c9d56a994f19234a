from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siltstone.operators.counts import tag_count
from siltstone.plans import medallion
from siltstone.schemas import GOLD_TAG_SCHEMA
from siltstone.sources import keyed
from siltstone.sources.records import read_record_files
from siltstone.sources.tables import TableSpec, counted, first_and_total, read_table_stream, show_table, write_table
from siltstone.streaming import sinks
from siltstone.streaming.fanout import add_counts, append_batch, fan_out, read_batches, read_commits, upsert_batch, write_batch
from tests.test_medallion import PAGES, records

SCHEMA = "id bigint, v string, tags array<string>"


class Tables:
    def __init__(self, spark, path):
        self.spark = spark
        schema = spark.createDataFrame([], SCHEMA).schema
        self.source = TableSpec(f"{path}/in", schema=schema)
        self.rows, self.index = TableSpec(f"{path}/rows", schema=schema), TableSpec(f"{path}/index", schema=schema)
        self.counts, self.commits = TableSpec(f"{path}/counts", schema=GOLD_TAG_SCHEMA), TableSpec(f"{path}/commits")
        self.sinks = {
            "rows": append_batch(self.rows),
            "index": upsert_batch(self.index, "id", ["v"]),
            "counts": add_counts(self.counts, "tag", "tag_post_count", tag_count),
        }

    def add(self, *rows):
        write_table(self.spark.createDataFrame(rows, SCHEMA).coalesce(1), self.source, "append")

    def run(self, **changed):
        return fan_out(read_table_stream(self.spark, self.source, 1), self.commits, {**self.sinks, **changed})

    def state(self):
        return (
            sorted(tuple(row)[:2] for row in read_batches(self.spark, self.rows, self.commits).collect()),
            sorted(tuple(row)[:2] for row in sinks.read_keyed_table(self.spark, self.index, "id").collect()),
            {row.tag: row.tag_post_count for row in sinks.read_keyed_table(self.spark, self.counts, "tag").collect()},
        )


@pytest.fixture
def tables(spark, path):
    return Tables(spark, path)


def test_all_sinks_follow(tables):
    tables.add((1, "a", ["sql", "c"]), (1, "b", ["sql"]), (2, "a", None))
    tables.run()
    tables.add((2, "c", ["c", None]), (3, None, []))
    tables.add()
    tables.run()
    expected = (
        [(1, "a"), (1, "b"), (2, "a"), (2, "c")], [(1, "b"), (2, "c")], {"sql": 2, "c": 2, None: 1},
    )
    rows, index, counts = tables.state()
    assert (3, None) in rows and (3, None) in index
    assert ([r for r in rows if r[0] != 3], [r for r in index if r[0] != 3], counts) == expected
    tables.run()
    assert tables.state()[2] == counts
    done = {(row.batch, row.sink): row.row_count for row in read_commits(tables.spark, tables.commits).collect()}
    assert done[0, "rows"] == 3 and done[0, "index"] == 2 and done[0, "counts"] == 2
    assert done[1, "rows"] == 2 and done[1, "counts"] == 2 and (1, "*") in done


@pytest.fixture
def dying():
    """Makes a sink that dies before, or after, it has written."""

    def make(sink, after):
        def write(batch, batch_id):
            if after:
                sink(batch, batch_id)
            raise ConnectionError("killed")

        return write

    return make


@pytest.mark.parametrize("name, after", [("rows", True), ("index", False), ("counts", True)])
def test_killed_between_two_sinks(spark, tables, dying, name, after):
    batches = [
        spark.createDataFrame(rows, SCHEMA)
        for rows in ([(1, "a", ["sql"])], [(1, "b", ["sql", "c"]), (2, "a", ["c"])])
    ]
    write_batch(batches[0], 0, tables.commits, tables.sinks)
    with pytest.raises(ConnectionError, match="killed"):
        write_batch(batches[1], 1, tables.commits, {**tables.sinks, name: dying(tables.sinks[name], after)})
    # What is there in part is not given as whole.
    assert [tuple(row)[:2] for row in read_batches(spark, tables.rows, tables.commits).collect()] == [(1, "a")]
    called = []

    def noted(sink_name):
        return lambda batch, batch_id: called.append(sink_name) or tables.sinks[sink_name](batch, batch_id)

    write_batch(batches[1], 1, tables.commits, {sink_name: noted(sink_name) for sink_name in tables.sinks})
    assert tables.state() == ([(1, "a"), (1, "b"), (2, "a")], [(1, "b"), (2, "a")], {"sql": 2, "c": 2})
    # Only the sinks that lacked the batch were written.
    names = list(tables.sinks)
    assert called == names[names.index(name):]


def test_a_killed_stream_is_finished_by_the_next_run(tables, dying):
    tables.add((1, "b", ["sql", "c"]), (2, "a", ["c"]))
    with pytest.raises(Exception, match="killed"):
        tables.run(index=dying(tables.sinks["index"], True))
    tables.run()
    assert tables.state() == ([(1, "b"), (2, "a")], [(1, "b"), (2, "a")], {"sql": 1, "c": 2})


def test_batch_is_computed_once(spark, tables):
    read = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(i, "a", ["sql"]) for i in range(50)], SCHEMA).mapInArrow(note, SCHEMA)
    write_batch(rows, 0, tables.commits, tables.sinks)
    assert read.value == 50 and tables.state()[2] == {"sql": 50}
    write_batch(rows, 0, tables.commits, tables.sinks)
    assert read.value == 50 and tables.state()[2] == {"sql": 50}


def test_merged_counts_are_not_added_twice(spark, tables, dying):
    rows = spark.createDataFrame([(1, "a", ["sql"])], SCHEMA)
    write_batch(rows, 0, tables.commits, tables.sinks)
    with pytest.raises(ConnectionError):
        write_batch(rows, 1, tables.commits, {**tables.sinks, "counts": dying(tables.sinks["counts"], True)})
    sinks.compact_keyed_table(spark, tables.counts, "tag", retention_seconds=0)
    write_batch(rows, 1, tables.commits, tables.sinks)
    write_batch(rows, 2, tables.commits, tables.sinks)
    assert tables.state()[2] == {"sql": 3}


@settings(max_examples=2, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(1, 4), st.sampled_from("abc"), st.lists(st.sampled_from(["x", "y", "z"]), max_size=3)), max_size=5), min_size=1, max_size=3))
def test_against_plain_sums(spark, tmp_path_factory, batches):
    tables = Tables(spark, str(tmp_path_factory.mktemp("t")))
    index, counts = {}, Counter()
    for number, rows in enumerate(batches):
        write_batch(spark.createDataFrame(rows, SCHEMA), number, tables.commits, tables.sinks)
        last = {}
        for key, value, tags in rows:
            last[key] = max(value, last.get(key, ""))
            counts.update(tags)
        index.update(last)
    assert tables.state() == (sorted((k, v) for rows in batches for k, v, _ in rows), sorted(index.items()), dict(counts))


def test_sinks_need_names(spark, tables):
    tables.add((1, "a", []))
    for wrong in ({}, {"*": append_batch(tables.rows)}):
        with pytest.raises(ValueError):
            fan_out(read_table_stream(spark, tables.source), tables.commits, wrong)


def test_processing_together_gives_the_same(spark, path):
    lakes = [medallion.Lakehouse(f"{path}/{name}") for name in ("apart", "together")]
    for lake, processing in zip(lakes, (medallion.run_processing, medallion.run_processing_together)):
        for start in range(3):
            write_table(records(spark, [PAGES[start]], start=start), lake.records, "append")
        weights = medallion.run_stages(spark, lake, read_record_files(spark, lake.records.data_path), files_per_batch=1, processing=processing)
        assert {tuple(row) for row in weights.collect()} == {("SQL", 2, 1.0), ("C#", 1, 0.5)}
    silver = [spark.read.schema(lakes[0].silver.schema).parquet(lakes[0].silver.data_path), read_batches(spark, lakes[1].silver_batches, lakes[1].commits)]
    index = [sinks.read_keyed_table(spark, lake.index, "id") for lake in lakes]
    for apart, together in (silver, index):
        assert apart.columns == together.columns
        assert sorted(map(str, apart.collect())) == sorted(map(str, together.collect()))


def test_a_batch_of_one_file_is_dealt_to_several_tasks(spark, path, monkeypatch):
    lake, read = medallion.Lakehouse(path), []
    write_table(records(spark, PAGES * 5).coalesce(1), lake.records)
    medallion.run_storage(read_record_files(spark, lake.records.data_path), lake.bronze)
    assert len(spark.read.parquet(lake.bronze.data_path).inputFiles()) == 1
    state_of = keyed.state_of
    monkeypatch.setattr(keyed, "state_of", lambda spark, table: read.append(table) or state_of(spark, table))
    silver = medallion.run_processing_together(spark, lake, files_per_batch=1)
    assert silver.count() == 5 * len(PAGES) and len(silver.inputFiles()) > 1
    # Each keyed sink reads its log once a batch.
    assert read == [lake.index, lake.gold_tags]


# Counts in the same pass -----------------------------------------------------------------------


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("rows, parts, n", [(1000, 7, 5), (3, 7, 5), (0, 1, 5), (40, 1, 20)])
def test_first_rows_and_total_in_one_job(spark, rows, parts, n):
    df = spark.range(0, rows, 1, parts)
    (first, total), jobs = jobs_of(spark, f"report-{rows}-{parts}", lambda: first_and_total(df, n))
    assert [row.id for row in first] == list(range(min(n, rows))) and total == rows and jobs <= 1


def test_counted_write(spark, path):
    df = spark.range(123)
    assert counted(df, lambda rows: write_table(rows, TableSpec(path))) == 123
    assert counted(df.where("id < 0"), lambda rows: rows.collect()) == 0


def test_show_table_prints_the_total(spark, capsys):
    show_table(spark.createDataFrame([(i, None) for i in range(30)], "id int, tags array<string>"))
    out = capsys.readouterr().out
    assert "rows: 30" in out and "|  0|NULL|" in out and "| 19|NULL|" in out and "| 20|" not in out


def test_stream_counts_come_from_the_same_query(spark, tables, capsys):
    for i in range(3):
        tables.add((i, "a", []), (i, "b", []))
    stream = read_table_stream(spark, tables.source, files_per_batch=1)
    copy = TableSpec(f"{tables.rows.base_path}/copy")
    rows = sinks.counted_stream(stream, lambda df: sinks.append_to_table(df, copy))
    assert rows == {0: 2, 1: 2, 2: 2}
    assert sinks.counted_stream(stream, lambda df: sinks.append_to_table(df, copy, wait=False)) == {}
    sinks.show_stream(stream, "all rows")
    assert "rows: 6" in capsys.readouterr().out


def test_counted_stream_raises_its_error(spark, tables):
    tables.add((1, "a", []))

    def write(batch, batch_id):
        raise ConnectionError("no room")

    with pytest.raises(Exception, match="no room"):
        sinks.counted_stream(
            read_table_stream(spark, tables.source), lambda df: df.writeStream.foreachBatch(write).trigger(availableNow=True).start()
        )
