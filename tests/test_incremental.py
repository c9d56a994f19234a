import pytest
from pyspark.sql import functions as F

from siltstone.operators import incremental

ORDER = ["page", "pos"]
ROWS = [(1, 0, 50), (1, 1, 40), (2, 0, 30), (2, 1, 40), (3, 0, 10)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page int, pos int, id bigint").repartition(3)


def ids(df):
    return [row["id"] for row in df.orderBy(*ORDER).collect()]


@pytest.mark.parametrize("limit, marker, expected", [
    (None, None, [50, 40, 30, 40, 10]),
    (None, 0, [50, 40, 30, 40, 10]),
    (None, 40, [50]),
    (None, 50, []),
    (None, 10, [50, 40, 30, 40]),
    (None, 77, [50, 40, 30, 40, 10]),
    (2, None, [50, 40]),
    (2, 30, [50, 40]),
    (3, 30, [50, 40]),
    (0, None, [50, 40, 30, 40, 10]),
])
def test_new_rows(spark, limit, marker, expected):
    assert ids(incremental.new_rows(frame(spark), "id", ORDER, limit, marker)) == expected


def test_high_water_mark(spark):
    assert incremental.high_water_mark(frame(spark), "id", ORDER).first()["marker"] == 50


def test_marker_cut_has_no_cross_join(spark):
    plan = incremental.since_marker(frame(spark), "id", 40, ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_concat_and_page_max(spark):
    both = incremental.concat_batches([frame(spark, ROWS[:2]), frame(spark, ROWS[2:])])
    assert ids(both) == [50, 40, 30, 40, 10]
    labels = spark.createDataFrame([("1",), ("9",), ("10",), ("next",), ("",), (None,)], "label string")
    assert incremental.page_max(labels, F.col("label")).first()["page_num"] == 10


def test_when_any(spark):
    seen = []
    assert incremental.when_any(frame(spark), seen.append) and len(seen) == 1
    assert not incremental.when_any(frame(spark).where("id < 0"), seen.append) and len(seen) == 1


def test_upsert(spark):
    schema = "k int, v string, seq int"
    current = spark.createDataFrame([(1, "a", 9), (2, "b", 9), (4, None, 1)], schema)
    changes = spark.createDataFrame([(2, "c", 1), (2, None, 3), (2, "d", 2), (3, "e", 1)], schema)
    got = incremental.upsert(current, changes, "k", ["seq"])
    assert got.columns == ["k", "v", "seq"]
    assert {tuple(row) for row in got.collect()} == {(1, "a", 9), (2, None, 3), (3, "e", 1), (4, None, 1)}


def test_latest_per_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    latest = incremental.latest_per_key(df, "k", ["id"])
    assert latest.count() == 20_001
    assert latest.where("k = -1").first()["id"] == 29_997
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")
