import random

from pyspark.sql import functions as F

from siltstone.operators import ranking


def frame(spark, rows):
    return spark.createDataFrame(rows, "term string, n bigint")


def test_number_rows_is_a_global_order(spark):
    rng = random.Random(1)
    rows = [(f"t{i:04}", rng.choice([1, 1, 1, 1, 2, 5])) for i in range(2000)]
    got = ranking.frequency_table(frame(spark, rows).repartition(7)).orderBy("id").collect()
    expected = sorted(rows, key=lambda row: (-row[1], row[0]))
    assert [(row["id"], row["term"], row["n"]) for row in got] == [(i, t, n) for i, (t, n) in enumerate(expected, 1)]


def test_table_lines(spark, capsys):
    df = frame(spark, [("sql", 3), ("a" * 20, 7), ("c", 3)])
    expected = [f'{1:3}|"{"a" * 20}"|{7:<5}|', f'{2:3}|"{"c":15}"|{3:<5}|', f'{3:3}|"{"sql":15}"|{3:<5}|']
    for limit in (None, 10):
        assert [row["line"] for row in ranking.frequency_table(df, limit).orderBy("id").collect()] == expected
    ranking.print_frequency_table(df)
    assert capsys.readouterr().out.splitlines() == ["Id |Term           |Count|", "-" * 26, *expected]


def test_relative_weights(spark):
    df = frame(spark, [(f"t{i:03}", 1000 - i) for i in range(300)])
    got = ranking.relative_weights(df, 200).orderBy(F.desc("weight")).collect()
    assert len(got) == 200 and ranking.relative_weights(df).count() == 300
    assert got[0]["weight"] == 1.0 and abs(got[-1]["weight"] - 0.801) < 1e-12
