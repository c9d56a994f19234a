import pytest
from pyspark.sql import functions as F

from siltstone.sources import records, tables
from siltstone.sources.dictionary import duplicate_entries, read_dictionary, sorted_entries
from siltstone.sources.tables import TableSpec


def test_table_spec(path):
    spec = TableSpec(path + "/")
    assert (spec.data_path, spec.checkpoint_path, spec.file_format) == (f"{path}/data", f"{path}/checkpoint", "parquet")
    with pytest.raises(NotImplementedError):
        TableSpec(path, "excel")


@pytest.mark.parametrize("file_format", ["parquet", "orc", "json"])
def test_write_and_read(spark, path, file_format):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    spec = TableSpec(path, file_format, df.schema)
    tables.write_table(df, spec)
    assert {tuple(row) for row in tables.read_table(spark, spec).collect()} == {(1, "a"), (2, "b")}
    assert tables.read_files(spark, spec.data_path, file_format).count() == 2
    tables.write_table(df, spec, "append")
    assert tables.read_table(spark, spec).count() == 4


def test_read_files_rejects_unknown_format(spark, path):
    with pytest.raises(NotImplementedError):
        tables.read_files(spark, path, "excel")


def test_reports(spark, path, capsys):
    df = spark.range(100).repartition(3)
    assert tuple(tables.table_report(df).first()) == (3, 100)
    assert tuple(tables.table_report(df.where("id < 0")).first()) == (0, 0)
    tables.write_table(df, TableSpec(path))
    tables.show_table_info(spark, path=path)
    out = capsys.readouterr().out
    assert "number of partitions" in out and "100" in out
    with pytest.raises(ValueError):
        tables.show_table_info(spark)


def test_dictionary(spark, path):
    with open(f"{path}/tags.txt", "w") as file:
        file.write("sql \nscrum\nC\nscrum\t\nci cd\nnhật bản\nscrum\n")
    entries = read_dictionary(spark, f"{path}/tags.txt")
    assert [row[0] for row in sorted_entries(entries).collect()] == [
        "C", "ci cd", "nhật bản", "scrum", "scrum", "scrum", "sql",
    ]
    assert [tuple(row) for row in duplicate_entries(entries).collect()] == [("scrum", 3)]


def test_kafka_needs_its_connector(spark):
    # Without the connector on the classpath Spark names the missing source; the options are ours.
    with pytest.raises(Exception, match="(?i)kafka"):
        records.read_kafka_stream(spark, "localhost:1", "jobs")
    messages = records.to_messages(spark.range(1).select(F.lit("x").alias("raw")), F.col("raw"), {"source": F.lit("s")})
    with pytest.raises(Exception, match="(?i)kafka"):
        records.write_kafka(messages, "localhost:1", "jobs")
