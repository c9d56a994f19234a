"""Many rows without id, and several texts under one id, are documents of their own."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from siltstone.llm import sentences, suffixes


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    passage = " ".join(prose(12) for _ in range(3))
    out = [(None, f"{prose(rng.randint(3, 25))} {passage if k % 4 == 0 else ''} {prose(9)}") for k in range(5000)]
    out += [(k, f"{prose(14)} {passage if k % 5 == 0 else ''}") for k in range(50) for _ in range(2)]
    return out + out[:30]


def in_order(spark, rows):
    """Distinct documents by id, then digest; those without id last."""
    df = spark.createDataFrame(rows, "doc_id long, text string").distinct().withColumn("digest", F.xxhash64("text"))
    return [(r.doc_id, r.text) for r in sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.digest))]


def test_bytes(spark, rows):
    seen, expected = set(), {}
    for doc, text in in_order(spark, rows):
        raw, gone = text.encode(), set()
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen:
                gone.update(range(k, k + 100))
            seen.add(raw[k:k + 100])
        left = bytes(x for k, x in enumerate(raw) if k not in gone)
        expected[(doc, hashlib.sha256(left).hexdigest(), len(gone))] = left
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffixes.without_repeated_bytes(df).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.kept_sha256, r.n_removed): bytes(r.kept) for r in got} == expected
    assert "kept" not in suffixes.without_repeated_bytes(df, kept=False).columns


def test_sentences(spark, rows):
    seen, expected = set(), set()
    for doc, text in in_order(spark, rows):
        cut = [tuple(s.split()) for s in text.split(".") if s.split()]
        gone = set()
        for a in range(len(cut)):
            for b in range(a + 2, len(cut) + 1):
                if sum(map(len, cut[a:b])) >= 20:
                    if tuple(cut[a:b]) in seen:
                        gone.update(range(a, b))
                    seen.add(tuple(cut[a:b]))
        expected.add((doc, len(cut), len(gone), " ".join(" ".join(s) + "." for k, s in enumerate(cut) if k not in gone)))
    got = sentences.without_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_sentences, r.n_removed, " ".join(r.text.split())) for r in got} == expected
