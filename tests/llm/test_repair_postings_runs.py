"""Conversation repair, balanced posting lists and periodic runs against plain versions and odd rows."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from siltstone.llm import periodic, postings, repair
from siltstone.llm.shared import U64, mix

sys.setrecursionlimit(20_000)
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


# Conversation repair ------------------------------------------------------------------------------


def plain_edits(faults, initials):
    """The cheapest edits by trying all, the smallest string of them."""

    @lru_cache(None)
    def go(i, state, inserted):
        options = [(0, "")] if i == len(faults) and state in ("", "a") else []
        if inserted < 3:
            cost, rest = go(i, FOLLOWS[state], inserted + 1)
            options.append((cost + 2, "I" + rest))
        if i < len(faults):
            cost, rest = go(i + 1, state, 0)
            options.append((cost + 3, "D" + rest))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                cost, rest = go(i + 1, FOLLOWS[state], 0)
                options.append((cost + 2 + more, "R" + rest))
                if initials[i] == FOLLOWS[state] or (initials[i] == "s" and state == ""):
                    cost, rest = go(i + 1, initials[i], 0)
                    options.append((cost + more, "K" + rest))
        return min(options, default=(10**9, ""))

    return go(0, "", 0)


def plain_repairs(rows):
    messages = defaultdict(list)
    for conv, turn, role, text in rows:
        messages[conv]
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        messages[conv] += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = {}
    for conv, found in messages.items():
        found.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        seen, faults = set(), []
        for _, role, text in found:
            end = text.rstrip(" \t\n\v\f\r")
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [m[1][:1] for m in found]
        cost, audit = plain_edits(tuple(faults), tuple(initials))
        lines, state, rest = [], "", iter(found)
        for letter in audit:
            if letter == "I":
                state = FOLLOWS[state]
                lines.append(f"{NAMES[state]}:")
                continue
            _, role, text = next(rest)
            if letter != "D":
                state = role[:1] if letter == "K" else FOLLOWS[state]
                lines.append(f"{role if letter == 'K' else NAMES[state]}:{text}")
        turns = {m[0] for m in found if m[0] is not None}
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def test_block_tables_give_the_smallest_of_the_cheapest_edits():
    rng = random.Random(5)
    faults = {repair.GONE: "blank"}
    for _ in range(1500):
        symbols = bytes(rng.choice([1, 2, 2, 3, 4, 4, 5, 6, 7, 8, 9]) for _ in range(rng.randint(0, 13)))
        plain = plain_edits(
            tuple(faults.get(s, "truncated" if s % 2 else "") for s in symbols), tuple("uaso"[(s - 2) // 2] if s > 1 else "u" for s in symbols)
        )
        assert repair.cheapest_edits(symbols) == plain


def conversations_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, True) for r in rows], "conv_id long, turn long, role string, text string, d1 string, kind int, later boolean")


def repairs(df):
    return {r[0]: tuple(r[1:]) for r in repair.repaired(df).collect()}


def test_repaired_conversations(spark):
    rng = random.Random(11)
    texts = ["Yes.", "No", "Why?", "", " \n", "Long text. " * 40, "Ünï 日本.", None, "end!\t "]
    rows = [
        (conv, turn, rng.choice(["user", "assistant", "system", "tool", None, ""] if conv % 3 else ["user", "assistant"]), rng.choice(texts))
        for conv in range(150) for turn in range(rng.randint(1, 9)) if rng.random() < 0.9
    ]
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (900, None, "user", "Null turn."), (900, 3, "assistant", "Yes."), (900, None, None, None)]
    rows += [(901, None, "user", "a.")] * 3 + [(902, turn, "user", "same.") for turn in range(60)] + [(903, turn, ("user", "assistant")[turn % 2], f"t{turn}.") for turn in range(400)]
    rows += [r for r in rows[:20]]  # repeated rows are duplicates of their turn
    rows += [(904, turn, "user", "All of it is dropped.") for turn in range(4000) if zlib.crc32(f"904:{turn}".encode()) % 20 == 0][:2]
    rows += [(905, 0, "user", "word " * 200_000 + "."), (905, 1, "assistant", "Yes.")]
    assert repairs(conversations_of(spark, rows).repartition(5)) == plain_repairs(rows)
    assert repairs(conversations_of(spark, rows))[904][:7] == (0, 0, 0, 0, 0, 0, "")
    assert repairs(conversations_of(spark, [])) == {}


# Posting lists ------------------------------------------------------------------------------------


def plain_nearest(rows):
    whole = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = {}
    for q, x in {(i, tuple(v)) for i, v in whole if i % 100 == 0}:
        out[q] = sorted((float(np.sqrt(((np.array(x) - v) ** 2).sum())), i) for i, v in whole if i != q)[:10]
    return out


def answers(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return dict(out)


VECTOR = "vec_id long, embedding array<float>, k1 string, list int, ids int"


def test_odd_vectors_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(0, 900)]
    rows += [(int(i), [1.0, 2.0, 3.0, 0.0, 0.0]) for i in range(1000, 1400)]  # a group of copies that holds four queries
    rows += [(1500, None), (1600, []), (1700, [0.0] * 5), (1800, [1.0, None, 1.0, 1.0, 1.0]), (1900, [float("nan"), 1.0, 1.0, 1.0, 1.0]), (2000, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 5)]
    rows += [(7, rows[7][1])] * 3 + [(100, rows[100][1])]
    expected = plain_nearest(rows)
    rows.append((2100, [1.0, 2.0]))  # not the usual length
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTOR).repartition(4)
    assert answers(postings.nearest(df, list_rows=40, reach=100.0)) == expected
    assert postings.nearest(df.limit(0)).count() == 0
    assert answers(postings.nearest(df.where("vec_id in (200, 300)"))) == plain_nearest([r for r in rows if r[0] in (200, 300)])


@pytest.mark.parametrize("structured", [True, False])
def test_recall(spark, structured):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24)) * (1.5 if structured else 0)
    x = (centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 24))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = answers(postings.nearest(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTOR), list_rows=60))
    expected = plain_nearest(rows)
    assert found.keys() == expected.keys()
    hits = sum(len({i for _, i in found[q]} & {i for _, i in expected[q]}) for q in expected)
    assert hits >= 0.92 * 10 * len(expected)


def test_walk_prunes_lists_of_separate_groups():
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(16, 8)) * 20, 100, axis=0) + rng.normal(size=(1600, 8))
    graph = postings.fit(x, 32)
    sizes = np.bincount(postings.lists_within(graph, x, 1.0, 1, 8)[1], minlength=32)
    assert len(graph.centroids) == 32 and sizes.max() <= 4 * sizes.mean()
    rows, _ = postings.lists_within(graph, x, postings.fitted_reach(graph, x), None, 8)
    assert len(rows) < 5 * len(x) and len(np.unique(rows)) == len(x)


# Periodic runs ------------------------------------------------------------------------------------


def plain_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i - q, j), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_word_runs(doc_id, text):
    w = re.findall(r"[^ \t-\r]+", text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    found = plain_runs(w)
    gone = {i for s, x, q in found for i in range(s + q, s + x)}
    best = None
    for s, x, q in found:
        if best is None or x * best[2] > best[1] * q:
            best = (s, x, q)
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{x},{q}\n" for s, x, q in found), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digest)


def test_runs_of_random_words():
    rng = random.Random(6)
    for _ in range(600):
        rows = []
        for _ in range(rng.randint(1, 4)):
            w = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 70))]
            for _ in range(rng.randint(0, 3) if w else 0):
                a, p = rng.randrange(len(w)), rng.randint(1, 17)
                for i in range(a, min(len(w), a + rng.randint(0, 80))):
                    w[i] = w[a + (i - a) % p]
            rows.append(w)
        words = np.array([x for w in rows for x in w], np.int64)
        row = np.repeat(np.arange(len(rows)), [len(w) for w in rows])
        found = list(zip(*(c.tolist() for c in periodic.periodic_runs(mix(words.astype(U64) + U64(1)), row))))
        base = np.cumsum([0, *map(len, rows)])
        assert found == [(s + base[k], x, q) for k, w in enumerate(rows) for s, x, q in plain_runs(w)]


def test_word_runs(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "b", "cc", "Été", "a."]) for _ in range(rng.randint(0, 90))) for _ in range(400)]
    texts += [None, "", " \n\t", "x", "x " * 5, "x " * 6, "a b " * 50, " a  b\tc\n" * 9 + "a b", "日本 " * 8, "A a " * 3]
    rows = [(i * 7, t) for i, t in enumerate(texts)] + [(None, "x " * 9), (None, None), (7, texts[1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, start string, period int").repartition(3)
    expected = sorted((plain_word_runs(*r) for r in rows), key=repr)
    assert sorted(map(tuple, periodic.word_runs(df).collect()), key=repr) == expected
    assert periodic.word_runs(df.limit(0)).count() == 0


def test_long_text_of_one_word(spark):
    n = 300_000
    df = spark.createDataFrame([(1, "word " * n), (2, ("one two " * 5 + "three ") * (n // 11))], "doc_id long, text string")
    found = {r.doc_id: tuple(r)[2:6] for r in periodic.word_runs(df).collect()}
    assert found[1] == (0, n, 1, 1000 * n)
    assert found[2][2] == 11 or found[2][2] == 2
