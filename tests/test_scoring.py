import random
from collections import Counter

from siltstone.functions import text
from siltstone.operators import scoring
from siltstone.operators.scoring import Field
from siltstone.plans.medallion import score_terms

FIELDS = [Field("tags", 6, 1), Field("overview", 1, 3), Field("requirement", 1, 3), Field("benefit", 1, 3)]
WORDS = ["java", "sql", "you", "việt", "12", "cloud", "excel", "team", "the"]


def postings(seed=3, rows=60):
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, n)))

    return [([words(2) for _ in range(rng.randint(0, 3))], words(6), words(6), words(6)) for _ in range(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "tags array<string>, overview string, requirement string, benefit string")


def brute_force(spark, rows, dictionary, fields=FIELDS, buckets=None):
    """Counters on the driver: per field minimum, bucket cut, weights, classes."""
    df = frame(spark, rows)
    analysed = df.select(text.analyze_tags("tags"), *[text.analyze(f.name) for f in fields[1:]]).collect()
    points, tag_buckets = Counter(), set()
    for i, field in enumerate(fields):
        count = Counter(term for row in analysed for term in set(row[i]))
        kept = sorted(((t, n) for t, n in count.items() if n >= field.min_doc_count), key=lambda x: (-x[1], x[0]))
        for term, n in kept[:buckets]:
            points[term] += field.weight * n
            if i == 0:
                tag_buckets.add(term)

    def label(term):
        words = term.split(" ")
        bad = (len(words) == 1 and not term.isascii()) or set(words) & {"", "you", "have", "work"} or term.isnumeric()
        if term in tag_buckets or (not bad and term in dictionary):
            return "TAG"
        return "IGNORED" if bad else "NOT_TAG"

    return {(term, n, label(term)) for term, n in points.items()}


def test_score_terms_equals_counters(spark):
    rows, dictionary = postings(), {"java", "excel", "cloud team", "sql"}
    entries = spark.createDataFrame([(term,) for term in [*dictionary, "sql"]], "term string")
    got = score_terms(frame(spark, rows), entries).select("term", "points", "class").collect()
    assert {tuple(row) for row in got} == brute_force(spark, rows, dictionary)
    assert len(got) == len({row["term"] for row in got})


def test_score_terms_with_buckets(spark):
    rows, dictionary = postings(5, 200), {"java"}
    entries = spark.createDataFrame([("java",)], "term string")
    got = score_terms(frame(spark, rows), entries, buckets=4).select("term", "points", "class").collect()
    assert {tuple(row) for row in got} == brute_force(spark, rows, dictionary, buckets=4)


def test_classes(spark):
    points = spark.createDataFrame(
        [("java", 5, False), ("you know", 9, True), ("team", 4, False), ("việt", 3, False), ("12", 2, False)],
        "term string, points bigint, is_tag boolean",
    )
    classified = scoring.classify(points, spark.createDataFrame([("java",), ("12",)], "term string"))
    assert {row["term"]: row["class"] for row in classified.collect()} == {
        "java": "TAG", "you know": "TAG", "team": "NOT_TAG", "việt": "IGNORED", "12": "IGNORED",
    }
    assert {tuple(row) for row in scoring.tag_points(classified).collect()} == {("java", 5), ("you know", 9)}
    assert {tuple(row) for row in scoring.other_points(classified).collect()} == {("team", 4)}


def test_allowed_and_dropped(spark):
    terms = spark.createDataFrame([("java",), ("java",), ("team",), ("you are",), ("",)], "term string")
    dictionary = spark.createDataFrame([("java",), ("",)], "term string")
    assert [row[0] for row in scoring.allowed_terms(terms, dictionary).collect()] == ["java"]
    assert [row[0] for row in scoring.dropped_terms(terms, dictionary).collect()] == ["team"]


def test_points_shuffle_once(spark):
    terms = scoring.field_terms(frame(spark, postings()), {
        "tags": text.analyze_tags("tags"), **{f.name: text.analyze(f.name) for f in FIELDS[1:]},
    })
    plan = scoring.weighted_points(terms, FIELDS, "tags")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_parts_of_a_field_count_as_its_terms_do(spark):
    df = spark.createDataFrame([("b c b",), ("b 7",), (None,), ("漢 b",)], "t string")
    fields = [Field("t", 2, 2)]
    terms = scoring.field_terms(df, {"t": text.analyze("t", distinct=True)})
    want = scoring.weighted_points(terms, fields).collect()
    assert scoring.weighted_points(scoring.field_parts(df, "t", "t"), fields).collect() == want == [("b", 6)]
