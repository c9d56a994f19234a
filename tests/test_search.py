import math
import random

import pytest
from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.operators.search import match_search, match_search_many

K1, B = 1.2, 0.75


def brute_force(docs, terms, k=10):
    docs = {i: tokens for i, tokens in docs.items() if tokens}
    mean = sum(map(len, docs.values())) / len(docs)
    scores = {}
    for i, tokens in docs.items():
        score = 0.0
        for term in terms:
            tf = tokens.count(term)
            df = sum(term in other for other in docs.values())
            score += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf / (tf + K1 * (1 - B + B * len(tokens) / mean))
        if score > 0:
            scores[i] = score
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]


def test_match_search(spark):
    rng = random.Random(11)
    words = ["k8s", "c", "sql", "java", "the", "cloud"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(80)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    for analyzer, terms in [(text.analyze, ["k8s", "k8s c", "c"]), (text.tokenize, ["k8s", "c"])]:
        analysed = {row[0]: row[1] or [] for row in df.select("id", analyzer("t")).collect()}
        got = match_search(df, "id", "t", "k8s C#", analyzer).collect()
        expected = brute_force(analysed, terms)
        assert [row["id"] for row in got] == [i for i, _ in expected]
        assert all(abs(row["score"] - score) < 1e-9 for row, (_, score) in zip(got, expected))


def test_long_query(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(5000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(20))) for i in range(60)]
    got = match_search(spark.createDataFrame(rows, "id int, t string"), "id", "t", " ".join(words), text.tokenize, 60).collect()
    expected = dict(brute_force({i: t.split() for i, t in rows}, set(words), 60))
    assert {row["id"] for row in got} == set(expected)
    assert all(abs(row["score"] - expected[row["id"]]) < 1e-9 for row in got)
    assert [row["score"] for row in got] == sorted((row["score"] for row in got), reverse=True)


def test_no_match(spark):
    df = spark.createDataFrame([(1, "java sql")], "id int, t string")
    assert match_search(df, "id", "t", "kotlin").collect() == []
    assert match_search(df, "id", "t", "the of").collect() == []


def test_many_queries_equal_single_searches(spark):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(40)] + ["hot"] * 20
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [(999, None)]
    asked = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("terms", text.tokenize("t")).withColumn("score", F.lit("x"))
    queries = spark.createDataFrame([*asked, (300, None), (301, ""), (302, "nowhere"), (303, "w1"), (303, "w2")], "q int, said string")
    documents = {i: (t or "").split() for i, t in rows}
    for stored in (None, "terms"):
        got = {}
        for r in match_search_many(df, "id", "t", queries, "q", "said", text.tokenize, 5, stored).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
        assert set(got) <= {*range(200), 303}
        for q, said in [*asked, (303, "w1 w2")]:
            want = brute_force(documents, sorted(set(said.split())), 5)
            assert [x[:2] for x in got.get(q, [])] == [(n + 1, i) for n, (i, _) in enumerate(want)]
            assert all(abs(x[2] - score) < 1e-9 for x, (_, score) in zip(got.get(q, []), want))
    single = match_search(df, "id", "t", asked[0][1], text.tokenize, 5).collect()
    assert [(r["id"], r["score"]) for r in single] == [x[1:] for x in got[0]]
    assert match_search_many(df, "id", "t", queries.limit(0), "q", "said", text.tokenize).count() == 0
    assert match_search_many(df.limit(0), "id", "t", queries, "q", "said", text.tokenize).count() == 0


def test_the_best_of_a_query_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "java sql")], "id int, t string")
    queries = spark.createDataFrame([(1, "java")], "q int, said string")
    plan = match_search_many(df, "id", "t", queries, "q", "said", text.tokenize)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_many_searches_analyse_every_text_once(spark):
    docs = [(1, "doc red red"), (2, "doc blue"), (2, "doc blue"), (None, "doc red"), (4, ""), (5, None)]
    df = spark.createDataFrame(docs, "id int, t string").repartition(2)
    asked = spark.createDataFrame([("q", "red blue")], "q string, t string")
    analysed = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def terms(t):
        if t is None or t == "" or t.startswith("doc"):
            analysed.add(1)
        return t and t.split()

    got = match_search_many(df, "id", "t", asked, "q", "t", terms).collect()
    assert analysed.value == len(docs)
    # Four rows with terms, 9 / 4 terms a row; the equal rows count one by one in the statistics.
    idf = {"red": math.log1p((4 - 2 + 0.5) / 2.5), "blue": math.log1p((4 - 1 + 0.5) / 1.5)}
    want = {1: idf["red"] * 2 / (2 + 1.2 * (0.25 + 0.75 * 3 / 2.25)), None: idf["red"] / (1 + 1.2 * (0.25 + 0.75 * 2 / 2.25))}
    want[2] = idf["blue"] * 2 / (2 + 1.2 * (0.25 + 0.75 * 2 / 2.25))
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx(want)
