"""Greedy string tiling held against a plain search for the longest free match, and on repetitive texts."""

import random
import re

import pyarrow as pa
import pytest

from siltstone.llm import tiling


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(doc, item):
    """Number of tiles and of the item's words under them."""
    least, used_d, used_i, tiles = min(tiling.SEED, len(item)), set(), set(), []
    while item:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and d + n not in used_d and i + n not in used_i:
                    n += 1
                best = max(best, (n, -d, -i))
        n, d, i = best[0], -best[1], -best[2]
        if n < least:
            break
        tiles.append(n)
        used_d.update(range(d, d + n))
        used_i.update(range(i, i + n))
    return len(tiles), sum(tiles)


def tables(rng):
    some = lambda n, voc: " ".join(rng.choice(voc) for _ in range(n))
    items = [some(rng.randint(1, 25), "Ab") for _ in range(4)] + [some(rng.randint(4, 25), "abcdefgh") for _ in range(4)]
    docs = []
    for _ in range(12):
        words = rng.choice(items).split() + rng.choice(items).split()
        cut = rng.randrange(len(words))
        docs.append(some(9, "abc") + " " + " ".join(words[cut:] + ["x"] + words[:cut]) + ", " + some(9, "ab"))
    return items, docs


@pytest.mark.parametrize("hits", [5, 200, tiling.HITS])
def test_every_leak_as_the_plain_model_finds_it(spark, monkeypatch, hits):
    monkeypatch.setattr(tiling, "HITS", hits)
    for seed in range(6):
        items, docs = tables(random.Random(seed))
        index = tiling._index(items)
        want = set()
        for d, doc in enumerate(docs):
            for i, item in enumerate(items):
                n, covered = plain(split(doc), split(item))
                if covered >= tiling.COVERAGE * len(split(item)):
                    want.add((d, i, n, covered))
        assert set(tiling._found(pa.array([*docs, None, ""], pa.string()), index)) == want


def test_leaks_as_a_query(spark):
    items, docs = tables(random.Random(40))
    got = tiling.leaks(
        spark.createDataFrame([*enumerate(docs), (None, docs[0]), (98, None)], "doc_id long, text string"),
        spark.createDataFrame([*enumerate(items), (99, None)], "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): (r["n_tiles"], r["covered_words"]) for r in got.collect()}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            n = plain(split(doc), split(item))
            assert got.get((d, i)) == (n if n[1] >= tiling.COVERAGE * len(split(item)) else None)
    assert {i for d, i in got if d is None} == {i for d, i in got if d == 0} and not any(d == 98 for d, _ in got)


def test_tiles_of_many_matches_that_lost_their_words():
    rng = random.Random(5)
    doc, item = ([rng.choice("ab") for _ in range(n)] for n in (500, 90))
    index = tiling._index([" ".join(item)])
    (_, _, n, covered), = tiling._found(pa.array([" ".join(doc)]), index)
    assert (n, covered) == plain(doc, item)


def test_a_very_long_text_of_one_word(monkeypatch):
    index = tiling._index(["a " * 200, "b " * 50, " ".join(str(i) for i in range(40))])
    sizes, expanded = [], tiling._matches
    monkeypatch.setattr(tiling, "_matches", lambda *x: sizes.append(len(x[0])) or expanded(*x))
    text = "a " * 150_000 + " ".join(str(i) for i in range(40))
    assert set(tiling._found(pa.array([text, "c"]), index)) == {(0, 0, 1, 200), (0, 2, 1, 40)}
    assert max(sizes) <= 2 * tiling.HITS
