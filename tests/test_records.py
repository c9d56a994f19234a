import datetime
import hashlib
import json

from pyspark.sql import functions as F

from siltstone.functions import records
from siltstone.schemas import BRONZE_SCHEMA, RECORD_SCHEMA
from siltstone.sources.records import to_bronze, to_messages, value_text

NOW = datetime.datetime(2024, 1, 2, 3, 4, 5)
TEXTS = ['quote " and \\ and \n and \t', "Việt Nam", "😀 emoji", "", "<div class=\"a\">x</div>", None]


def record(offset, value, headers, partition=2):
    return (None, value, "jobs", partition, offset, NOW, 0, headers)


def test_payload_round_trip(spark):
    df = spark.createDataFrame([(text,) for text in TEXTS], "t string")
    rows = df.select("t", records.encode_payload(F.col("t")).alias("v")).select(
        "t", "v", records.decode_payload(F.col("v")).alias("d")
    ).collect()
    for row in rows:
        assert row["d"] == row["t"]
        assert row["t"] is None or json.loads(row["v"]) == row["t"]


def test_decode_reads_escapes_and_keeps_raw_values(spark):
    raw = ['<div>"x"</div>', '"a","b"', "plain Việt"]
    df = spark.createDataFrame([(json.dumps(text),) for text in TEXTS[:-1]] + [(text,) for text in raw], "v string")
    assert [row[0] for row in df.select(records.decode_payload(F.col("v"))).collect()] == TEXTS[:-1] + raw


def test_bronze_headers(spark):
    rows = [
        record(0, b'"x"', [("source", b"site"), ("collect_id", b"17")]),
        record(1, b'"x"', [("source", b"site"), ("message_group_id", b"Thu, Jan 4, 2024")]),
        record(2, b'"x"', [("source", b"site")]),
        record(3, b'"x"', []),
        record(4, None, None),
        record(5, b'"x"', [("a", b"site"), ("b", b"18")]),
    ]
    bronze = to_bronze(spark.createDataFrame(rows, RECORD_SCHEMA))
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in BRONZE_SCHEMA]
    got = {row["offset"]: (row["value"], row["source"], row["collect_id"]) for row in bronze.collect()}
    assert got == {
        0: ('"x"', "site", 17), 1: ('"x"', "site", None), 2: ('"x"', "site", None), 3: ('"x"', None, None),
        4: (None, None, None), 5: ('"x"', "site", 18),
    }
    assert value_text(spark.createDataFrame(rows, RECORD_SCHEMA)).first()[0] == '"x"'


def test_messages(spark):
    df = spark.createDataFrame([("<p>Việt</p>", "site")], "raw string, source string")
    keyed = to_messages(
        df, F.col("raw"), {"source": F.col("source"), "collect_id": F.lit("1")}, F.col("source"), "jobs"
    ).first()
    assert bytes(keyed["key"]) == b"site" and keyed["topic"] == "jobs"
    assert json.loads(bytes(keyed["value"]).decode()) == "<p>Việt</p>"
    assert [(h["key"], bytes(h["value"])) for h in keyed["headers"]] == [("source", b"site"), ("collect_id", b"1")]
    assert to_messages(df, F.col("raw"), {"source": F.col("source")}).first()["key"] is None


def test_record_id(spark):
    df = spark.createDataFrame([(0, 0), (3, 41), (12, 999_999_999)], "partition int, offset bigint")
    ids = [row[0] for row in df.select(records.record_id(F.col("partition"), F.col("offset"))).collect()]
    assert ids == [0, 3_000_000_041, 12_999_999_999]


def test_content_id(spark):
    fields = [("Data Engineer at", "Acme"), ("Kỹ sư dữ liệu", "Công ty"), ("", ""), (None, "x")]
    df = spark.createDataFrame(fields, "a string, b string")
    got = [row[0] for row in df.select(records.content_id(F.col("a"), F.col("b"))).collect()]
    expected = [
        0 if a is None else int(hashlib.sha1((a[:10] + b[:10]).encode()).hexdigest(), 16) % 10 ** 8 for a, b in fields
    ]
    assert got == expected


def test_label_newlines_and_defaults(spark):
    df = spark.createDataFrame([(42, "T" * 50, "Acme", None, None)], "i bigint, t string, c string, n string, a array<string>")
    row = df.select(
        records.row_label(F.col("i"), F.col("t"), F.col("c")),
        records.strip_newlines(F.lit("a\nb\n")),
        records.or_empty(F.col("n")),
        records.or_empty_array(F.col("a")),
    ).first()
    assert list(row) == [f"{42:8} | {'T' * 40:40} | {'Acme':20}", "ab", "", []]
