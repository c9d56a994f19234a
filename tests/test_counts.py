import random
from collections import Counter

from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.operators import counts


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def docs(spark, *rows):
    return spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "id int, t string")


def test_tag_and_company_counts(spark):
    df = spark.createDataFrame(
        [(["sql", "sql", "c"], "x"), ([], "x"), (None, None), (["c"], "y")], "tags array<string>, company string"
    )
    assert as_dict(counts.tag_count(df)) == {"sql": 2, "c": 2}
    assert as_dict(counts.company_count(df)) == {"x": 2, None: 1, "y": 1}
    assert counts.row_count(df).collect()[0][0] == 4
    assert as_dict(counts.keyword_count(df, "company")) == {"x": 2, "y": 1}


def test_term_count_counts_documents(spark):
    df = docs(spark, "java java sql", "java", "sql java", None, "")
    got = as_dict(counts.term_count(df, text.analyze("t")))
    assert got == {"java": 3, "sql": 2, "java java": 1, "java sql": 1, "sql java": 1}
    assert as_dict(counts.term_count(df, text.analyze("t"), 2)) == {"java": 3, "sql": 2}
    limited = counts.term_count(df, text.analyze("t"), limit=3).collect()
    assert [tuple(row) for row in limited] == [("java", 3), ("sql", 2), ("java java", 1)]
    assert tuple(counts.most_frequent(counts.term_count(df, text.analyze("t"))).first()) == ("java", 3)


def test_one_term_in_every_row(spark):
    df = spark.range(20_000).select(F.concat(F.lit("hot w"), F.col("id") % 3).alias("t"))
    got = as_dict(counts.term_count(df, text.analyze("t"), 10_000))
    assert got == {"hot": 20_000}


def test_frequent_terms_do_not_depend_on_the_counters(spark):
    rng = random.Random(21)
    rows = [" ".join(f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(rng.randint(0, 30))) for _ in range(300)]
    df = docs(spark, *rows, None, "", rows[0])
    plain = as_dict(counts.term_count(df, text.analyze("t")))
    for least in (1, 4, 50, 10**6):
        want = {term: n for term, n in plain.items() if n >= least}
        for counters in (1, 64, counts.HASHED_COUNTERS):
            assert as_dict(counts.frequent_term_count(df, text.analyze("t"), least, counters)) == want
    assert as_dict(counts.frequent_term_count(df.limit(0), text.analyze("t"), 2)) == {}
    nulls = spark.createDataFrame([([None, "a", "_bucket"],), ([None, "a"],), (None,), ([],)], "term array<string>")
    assert as_dict(counts.frequent_term_count(nulls, F.col("term"), 2)) == {None: 2, "a": 2}


def test_word_frequency(spark):
    df = docs(spark, "the cat the dog", "a cat")
    assert as_dict(counts.word_frequency(df, text.tokenize("t"))) == {"the": 2, "cat": 2, "dog": 1, "a": 1}
    assert as_dict(counts.word_frequency(df, text.tokenize("t"), text.ENGLISH_STOP_WORDS)) == {"cat": 2, "dog": 1}


def test_frequency_map(spark):
    expected = {f"t{i}": i for i in range(50)}
    df = spark.createDataFrame(list(expected.items()), "tag string, n bigint")
    assert counts.frequency_map(df, "tag", "n").first()["frequency"] == expected
    shards = counts.frequency_map(df, "tag", "n", shards=4).collect()
    assert len(shards) == 4
    merged = Counter()
    for row in shards:
        merged.update(row["frequency"])
    assert dict(merged) == {**expected, "t0": 0}


def test_top_terms_after_the_cut(spark):
    rows = [(f"t{i:03}", n) for i, n in enumerate([1] * 50 + [2] * 20 + [3] * 5 + [900, 901, 5_000_000_000])]
    df = spark.createDataFrame(rows, "term string, n bigint")
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    for k in (1, 2, 3, 4, 8, 9, 28, 29, 60, 78, 100):
        assert [tuple(r) for r in counts.top_terms(df, k).collect()] == ordered[:k]


def test_frequency_map_query_deals_tags_to_shards(spark, monkeypatch):
    from siltstone.workload import queries

    rows = [(f"tag{i}", i) for i in range(2000)]
    tags, made = spark.createDataFrame(rows, "term string, n long"), []
    plain = counts.frequency_map
    monkeypatch.setattr(queries, "tag_frequency", lambda *_: tags)
    monkeypatch.setattr(queries.counts, "frequency_map", lambda *a: made.append(plain(*a)) or made[-1])
    assert sorted(map(tuple, queries.frequency_map(spark, "").collect())) == sorted(rows)
    sizes = [len(r["frequency"]) for r in made[0].collect()]
    assert sum(sizes) == 2000 and max(sizes) < 100


def test_frequent_terms_analyse_every_text_once(spark):
    df = spark.createDataFrame([("x a b",), ("x a c",), ("x",), (None,)], "t string").repartition(2)
    analysed = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def terms(t):
        analysed.add(1)
        return t and t.split()

    assert as_dict(counts.frequent_term_count(df, terms("t"), 2)) == {"x": 3, "a": 2}
    assert analysed.value == 4
