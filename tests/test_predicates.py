import pytest
from pyspark.sql import functions as F

from siltstone.functions import predicates, records, text
from siltstone.operators import counts, incremental

TERMS = [
    "", "a", "việt", "tiếng anh", "you know", "have", "c  d", " x", "x ", "12", "1 2", "①", "一", "½", "work", "workers",
    "c#", "12a",
]


def flags(spark, column):
    df = spark.createDataFrame([(i, term) for i, term in enumerate(TERMS)], "i int, term string")
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def single_non_ascii(term):
    return " " not in term and not term.isascii()


def drop_word(term):
    return not {"", "you", "have", "work"}.isdisjoint(term.split(" "))


def test_predicates_equal_plain_python(spark):
    term = F.col("term")
    assert flags(spark, predicates.is_single_non_ascii(term)) == [single_non_ascii(t) for t in TERMS]
    assert flags(spark, predicates.has_drop_word(term)) == [drop_word(t) for t in TERMS]
    # Number letters of CJK are no \p{N}; the composite drops them as non-ASCII words.
    assert flags(spark, predicates.is_numeric(term)) == [t.isnumeric() and t != "一" for t in TERMS]
    assert flags(spark, predicates.is_admissible(term)) == [
        not (single_non_ascii(t) or drop_word(t) or t.isnumeric()) for t in TERMS
    ]


def test_row_predicates(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", "", "c")], "x string, y string, z string")
    flagged = df.select(predicates.has_empty_section(F.col("x"), F.col("y"), F.col("z")))
    assert [row[0] for row in flagged.collect()] == [False, True]
    assert flags(spark, predicates.is_digits(F.col("term"))) == [t in ("12",) for t in TERMS]


def test_a_line_break_is_no_digit(spark):
    df = spark.createDataFrame([("12",), ("12\n",), ("99999999999",)], "t string")
    assert [r[0] for r in df.select(predicates.is_numeric(F.col("t"))).collect()] == [True, False, True]
    assert [r[0] for r in df.select(predicates.is_digits(F.col("t"))).collect()] == [True, False, True]
    assert incremental.page_max(df, F.col("t")).first()["page_num"] == 99999999999


def test_right_strip_takes_unicode_spaces(spark):
    df = spark.createDataFrame([("a\u00a0",), (" b\u3000\n",), ("c\x1f",)], "t string")
    assert [r[0] for r in df.select(text.right_strip("t")).collect()] == ["a", " b", "c"]


def test_payload_and_row_id_edges(spark):
    values = ['"x"', '"a","v":"b"', '"a","b"', "null", "plain"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(records.decode_payload(F.col("v"))).collect()] == ["x", *values[1:]]
    offsets = spark.createDataFrame([(0, 10 ** 9)], "p int, o bigint")
    with pytest.raises(Exception, match="offset beyond"):
        offsets.select(records.record_id(F.col("p"), F.col("o"))).collect()


def test_large_counts_stay(spark):
    df = spark.createDataFrame([("t", 3_000_000_000)], "tag string, n bigint")
    assert counts.frequency_map(df, "tag", "n").first()["frequency"] == {"t": 3_000_000_000}
