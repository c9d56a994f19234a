import json
import os

import pytest
from pyspark.sql import functions as F

from siltstone.functions.records import encode_payload, header
from siltstone.plans import medallion
from siltstone.plans.etl import run_etl
from siltstone.schemas import ANALYSED_INDEX_SCHEMA, GOLD_TAG_SCHEMA, SILVER_SCHEMA
from siltstone.sources.records import read_record_files
from siltstone.sources.tables import TableSpec, read_table, write_table
from siltstone.streaming.sinks import read_keyed_table


def page(title, company, tags, *paragraphs):
    return (
        f'<div class="job-details__title">{title}</div>\n<div class="job-details__sub-title">{company}</div>'
        f'<div class="job-details__tag-list">{"".join(f"<a>{tag}</a>" for tag in tags)}</div>'
        + "".join(f'<div class="job-details__paragraph">{text}</div>' for text in paragraphs)
    )


PAGES = [
    page("Data Engineer", "Acme", ["SQL", "C#"], "we use java", "java and sql", "nice &amp; warm"),
    page("Kỹ sư", "Công ty", ["SQL"], "java core", "java core", ""),
    page("Dev", "Acme", [], "java", "x", "y"),
]


def fetched(spark, pages=PAGES):
    return spark.createDataFrame([(1 + i // 2, i % 2, html) for i, html in enumerate(pages)], "page int, pos int, html string")


def records(spark, pages, start=0):
    df = spark.createDataFrame([(start + i, html) for i, html in enumerate(pages)], "n bigint, html string")
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        encode_payload(F.col("html")).cast("binary").alias("value"),
        F.lit("jobs").alias("topic"),
        F.lit(1).alias("partition"),
        F.col("n").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.array(header("source", F.lit("site")), header("collect_id", F.lit("7"))).alias("headers"),
    )


def test_run_etl_returns_the_transformed_frame(spark):
    loaded = []
    result = run_etl(lambda: spark.range(3), lambda df: df.where("id > 0"), loaded.append)
    assert result.count() == 2 and loaded == [result]


def test_integration(spark, path):
    postings = medallion.run_integration(fetched(spark), F.lit("site"), TableSpec(f"{path}/first"))
    rows = postings.orderBy("page", "pos").collect()
    assert [row["title"] for row in rows] == ["Data Engineer", "Kỹ sư", "Dev"]
    assert [row["abnormal"] for row in rows] == [False, True, False]
    assert all("\n" not in row["raw"] for row in rows) and len({row["id"] for row in rows}) == 3

    cut = medallion.run_integration(
        fetched(spark), F.lit("site"), TableSpec(f"{path}/second"), limit=1000, last_seen=rows[1]["digest"]
    )
    assert [row["title"] for row in cut.collect()] == ["Data Engineer"]
    message = medallion.posting_messages(cut, "run 1").first()
    assert json.loads(bytes(message["value"]).decode()) == PAGES[0].replace("\n", "")
    assert [(h["key"], bytes(h["value"]).decode()) for h in message["headers"]] == [
        ("source", "site"), ("message_group_id", "run 1"),
    ]


def test_stages_twice(spark, path):
    lake = medallion.Lakehouse(f"{path}/lake")
    arrivals = TableSpec(f"{path}/arrivals")

    write_table(records(spark, PAGES[:2]), arrivals, "append")
    weights = medallion.run_stages(spark, lake, read_record_files(spark, arrivals.data_path))
    assert {tuple(row) for row in weights.collect()} == {("SQL", 2, 1.0), ("C#", 1, 0.5)}

    write_table(records(spark, [*PAGES[2:], PAGES[0]], start=2), arrivals, "append")
    medallion.run_stages(spark, lake, read_record_files(spark, arrivals.data_path))
    gold = read_keyed_table(spark, lake.gold_tags, "tag")
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in GOLD_TAG_SCHEMA]
    assert {tuple(row) for row in gold.collect()} == {("SQL", 3), ("C#", 2)}

    silver = read_table(spark, lake.silver)
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]
    rows = {row["id"]: row for row in silver.collect()}
    assert sorted(rows) == [1_000_000_000 + i for i in range(4)]
    first = rows[1_000_000_000]
    assert tuple(first)[1:] == (
        "site", 7, "Data Engineer", ["SQL", "C#"], "we use java", "java and sql", "nice & warm", "Acme",
    )
    index = read_keyed_table(spark, lake.index, "id")
    assert {tuple(map(str, row)) for row in index.collect()} == {tuple(map(str, row)) for row in rows.values()}


def test_null_payload_is_kept_as_an_empty_row(spark):
    bronze = spark.createDataFrame(
        [(None, 0, 5, "site", None)], "value string, partition bigint, offset bigint, source string, collect_id int"
    )
    assert tuple(medallion.to_silver(bronze).first()) == (5, "site", None, None, None, None, None, None, None)


def test_chain_runs_only_for_new_postings(spark, path):
    lake = medallion.Lakehouse(f"{path}/lake")

    def run(pages, last_seen):
        def send(postings):
            rows = [row["raw"] for row in postings.orderBy("page", "pos").collect()]
            sent.extend(rows)
            write_table(records(spark, rows, start=len(sent)), lake.records, "append")

        weights = medallion.run_all(
            spark, lake, fetched(spark, pages), F.lit("site"), send,
            lambda: read_record_files(spark, lake.records.data_path), last_seen=last_seen,
        )
        marker = medallion.next_marker(spark, lake).first()["marker"]
        return weights and {tuple(row)[:2] for row in weights.collect()}, marker

    sent = []
    weights, marker = run(PAGES[1:], None)
    assert weights == {("SQL", 1)} and len(sent) == 2
    weights, again = run(PAGES[1:], marker)
    assert weights is None and again == marker and len(sent) == 2
    weights, newest = run(PAGES, marker)
    assert weights == {("SQL", 2), ("C#", 1)} and len(sent) == 3 and newest != marker


def test_record_stream_has_the_record_schema(spark, path):
    arrivals = TableSpec(path)
    write_table(records(spark, PAGES), arrivals)
    stream = read_record_files(spark, arrivals.data_path)
    assert stream.isStreaming and stream.columns == [
        "key", "value", "topic", "partition", "offset", "timestamp", "timestampType", "headers",
    ]


def test_analysed_copy(spark):
    silver = spark.createDataFrame(
        [(1, "s", 7, "t", ["C#", "Core Java"], "the java core", "2 java", "", "Acme")], SILVER_SCHEMA
    )
    copy = medallion.analysed_copy(silver)
    assert copy.columns == ANALYSED_INDEX_SCHEMA.names
    row = copy.first()
    assert row["tags_terms"] == ["c", "core", "java"]
    assert row["overview_terms"] == ["java", "java", "java core", "core"]
    assert row["requirement_terms"] == ["", "2 java", "java"] and row["benefit_terms"] == []


def test_postings_with_equal_short_ids_are_cut_apart(spark, path):
    page = """<p class="job-details__title">Data Engineer {}</p><p class="job-details__sub-title">Company Ltd</p>
        <p class="job-details__paragraph">same overview</p><p class="job-details__paragraph">same demand</p>
        <p class="job-details__paragraph">same benefit</p>"""
    pages = [page.format("one"), page.format("two"), page.format("three")]
    rows = medallion.run_integration(fetched(spark, pages), F.lit("site"), TableSpec(f"{path}/a")).orderBy("page", "pos").collect()
    assert len({row["id"] for row in rows}) == 1 and len({row["digest"] for row in rows}) == 3
    cut = medallion.run_integration(
        fetched(spark, pages), F.lit("site"), TableSpec(f"{path}/b"), last_seen=rows[2]["digest"]
    )
    assert cut.count() == 2


def test_marker_stays_when_sending_fails(spark, path):
    lake = medallion.Lakehouse(f"{path}/lake")
    write_table(spark.createDataFrame([("old", None)], "marker string, moved timestamp").withColumn("moved", F.current_timestamp()), lake.markers)

    def send(postings):
        raise ConnectionError("no broker")

    with pytest.raises(ConnectionError):
        medallion.run_all(spark, lake, fetched(spark), F.lit("site"), send, lambda: None)
    assert medallion.next_marker(spark, lake).first()["marker"] == "old"


def test_backlog_is_cut_into_batches(spark, path):
    lake = medallion.Lakehouse(f"{path}/lake")
    for start in range(3):
        write_table(records(spark, [PAGES[start]], start=start), lake.records, "append")
    medallion.run_storage(read_record_files(spark, lake.records.data_path), lake.bronze)
    bronze_files = len(spark.read.parquet(lake.bronze.data_path).inputFiles())
    medallion.run_processing(spark, lake, files_per_batch=1)
    commits = [n for n in os.listdir(f"{lake.silver.checkpoint_path}/commits") if n.isdigit()]
    assert len(commits) == bronze_files
