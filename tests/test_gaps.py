"""Limited runs over a growing listing collect every row once."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import incremental
from siltstone.plans import medallion
from siltstone.sources.tables import TableSpec, write_table

ORDER = ["page", "pos"]


def listing(spark, ids, per_page=4):
    rows = [(i // per_page, i % per_page, x, "payload") for i, x in enumerate(ids)]
    return spark.createDataFrame(rows, "page int, pos int, id string, raw string").repartition(3)


def run(spark, ids, gaps, n):
    df = listing(spark, ids)
    taken = [r["id"] for r in incremental.rows_in_gaps(df, "id", ORDER, gaps, n).orderBy(*ORDER).collect()]
    return taken, incremental.next_gaps(df, "id", ORDER, gaps, n)


@pytest.mark.parametrize("seed", range(2))
def test_every_row_once(spark, seed):
    rng = random.Random(seed)
    ids, gaps, collected = [], incremental.everything(spark), []
    for step in range(4):
        ids = [f"{step}-{k}" for k in range(rng.randint(0, 12))] + ids
        n = None if step == 3 else rng.choice([1, 3, 5])
        expected = [x for x in ids if x not in collected][:n]
        taken, gaps = run(spark, ids, gaps, n)
        assert taken == expected
        collected += taken
    assert sorted(collected) == sorted(ids)
    assert run(spark, ids, gaps, None)[0] == [] and gaps.count() == 1


def test_withdrawn_rows_and_bounds(spark):
    ids = [f"a{k}" for k in range(10)]
    _, gaps = run(spark, ids, incremental.everything(spark), 3)
    assert [(r["above"], r["below"]) for r in gaps.orderBy("gap").collect()] == [([], ["a0#1", "a1#1", "a2#1"]), (["a2#1", "a1#1", "a0#1"], [])]
    # The rows next to the gap are withdrawn: the next ones hold its place.
    left = ["b0", "a0", *ids[3:]]
    taken, gaps = run(spark, left, gaps, 4)
    assert taken == ["b0", "a3", "a4", "a5"]
    # All are withdrawn: what is left is taken again rather than lost.
    assert run(spark, ids[6:], gaps, None)[0] == ids[6:]


def test_repeated_and_missing_ids(spark):
    ids = ["x", "y", "x", None, "x", "z", None]
    taken, gaps = run(spark, ids, incremental.everything(spark), 2)
    assert taken == ["x", "y"]
    taken, gaps = run(spark, ["x", *ids], gaps, 3)  # one more of a known id at the top
    assert taken == ["x", "x", None]
    taken, gaps = run(spark, ["x", *ids], gaps, None)
    assert taken == ["x", "z", None] and run(spark, ["x", *ids], gaps, None)[0] == []
    empty = listing(spark, [])
    assert incremental.rows_in_gaps(empty, "id", ORDER, incremental.everything(spark), 2).count() == 0
    assert incremental.next_gaps(empty, "id", ORDER, incremental.everything(spark), 2).count() == 1


def test_marker_zero(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 1, 0), (2, 0, 7)], "page int, pos int, id bigint")
    assert [r["id"] for r in incremental.since_marker(df, "id", 0, ORDER).collect()] == [5]


def test_first_run_is_bounded_by_the_last_seen_row(spark):
    gaps = incremental.everything(spark, ["a4#1"])
    ids = [f"a{k}" for k in range(10)]
    taken, gaps = run(spark, ids, gaps, 2)
    assert taken == ["a0", "a1"]
    assert run(spark, ids, gaps, None)[0] == ["a2", "a3"]


PAGE = """<p class="job-details__title">Engineer {0}</p><p class="job-details__sub-title">Company {0}</p>
    <p class="job-details__paragraph">overview {0}</p><p class="job-details__paragraph">demand</p><p class="job-details__paragraph">benefit</p>"""


def test_limited_runs_of_the_chain(spark, path, monkeypatch):
    lake, sent = medallion.Lakehouse(f"{path}/lake"), []
    monkeypatch.setattr(medallion, "run_stages", lambda *_, **__: "weights")

    def collect(numbers, limit, fail=False):
        rows = [(k // 3, k % 3, PAGE.format(x)) for k, x in enumerate(numbers)]

        def send(postings):
            found = [r["title"] for r in postings.orderBy(*ORDER).collect()]
            if fail:
                raise ConnectionError("no broker")
            sent.extend(found)

        return medallion.run_all(spark, lake, spark.createDataFrame(rows, "page int, pos int, html string"), F.lit("site"), send, lambda: None, limit=limit)

    collect(range(5, 12), 2)
    with pytest.raises(ConnectionError):
        collect(range(3, 12), 4, fail=True)
    collect(range(3, 12), 4)
    collect(range(0, 12), None)
    assert collect(range(0, 12), None) is None
    assert sent == [f"Engineer {k}" for k in (5, 6, 3, 4, 7, 8, 0, 1, 2, 9, 10, 11)]


def test_plan_neither_sorts_nor_shuffles_whole_rows(spark, path):
    write_table(listing(spark, [f"a{k}" for k in range(20)]), TableSpec(path))
    df = spark.read.parquet(f"{path}/data")
    plan = incremental.open_rows(df.withColumn("at", F.struct(*ORDER)), incremental.gap_bounds(incremental.positions(df, "id", ORDER), incremental.everything(spark, ["a3"])))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    whole = text.split("scalar-subquery")[0]
    assert "Join" not in whole and "Sort" not in whole and "exists" in text
