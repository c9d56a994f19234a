"""Toxicity by a learned lexicon, matched with Levenshtein automata, and context windows.

Learning. Of the labelled rows whose crc32(id as text) mod 4 is not 2, at most about ``TRAIN_ROWS`` are
taken (by a hash of the id). Words, and word beginnings of ``PREFIXES`` characters, that are in at least
``SUPPORT`` toxic ones and much more often there than in the others make the lexicon: at most
``LEXICON`` terms, and the words found among them that one of their beginnings covers, with the logarithm of
that ratio as weight.

Matching. The lexicon is a trie. The Levenshtein automaton of distance 1 (0 for terms under ``SHORT``
letters) is intersected with it: a state is a set of (trie node, edits so far). A word beginning may hold its
edit before its last letter, which must be there: else any word with the letters before would do.
The sets that can be reached are numbered, which gives one table from state and byte to state. All
words of a block of texts run through the table side by side until they fail; a word's match is that with the
fewest edits, then the greatest weight.

Misspellings. Ordinary words lie one edit from terms too. A word that several clean training rows hold is no
misspelling. The others give each term a second weight for its misspelled matches: the same ratio, counted over
the training rows' misspelled matches, beginning from the term's own weight; they count if it is as great as a
term's must be.

Context. Every hit looks at the ``WINDOW`` words on each side. One between quotation marks, or near a word
that reports speech, counts as quoted, another as abuse. A document's features are its abusive, quoted
and misspelled hits with their weights, their density and variety; a logistic regression over the
labelled rows' features gives the score. Learning sees labels of training rows only, scoring the text only.

Defined cases: a null text is empty and scores like a text without hits. With no labelled rows of both
labels every score is 0. Rows without id are scored, never held out and never learned from. Labels that
repeat for an id count each; a null label is none. Extra columns are ignored, or kept by ``without_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import PUNCTUATION, SPACE, flat, slices, small_batches, words

TRAIN_ROWS = 20_000
SUPPORT, RATIO = 5, 8.0
LEXICON = 300
PREFIXES = (5, 6, 7)
SHORT = 5
#: Clean training rows that hold an ordinary word.
ORDINARY = 2
WINDOW = 8
THRESHOLD = 0.3
#: Words that report what somebody else said.
REPORTS = frozenset("said says quoted quote wrote called dit sagte dijo".split())
QUOTES = np.zeros(256, bool)
QUOTES[[34, 0xAB, 0xBB, 0x9C, 0x9D, 0x9E]] = True
FEATURES = 8

_WORD = re.compile(r"[^\W_]+")


def _terms(batches):
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    for b in batches:
        counts = Counter(), Counter()
        for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            own = set(_WORD.findall((text or "").lower()))
            own |= {f"{w[:n]}*" for w in own for n in PREFIXES if len(w) > n}
            counts[label].update(own)
        terms = sorted(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())], schema=schema)


def lexicon(rows: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Terms and weights from training rows (text, toxic); a term that ends with * is a word's beginning."""
    counted = rows.select("text", "toxic").mapInArrow(_terms, "term string, toxic long, clean long")
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = counted.filter(F.col("toxic") >= SUPPORT).withColumn("weight", weight).filter(F.col("weight") >= math.log(RATIO))
    gain = F.col("toxic") * F.col("weight") * F.when(F.col("term").endswith("*"), 1.0).otherwise(1.1)
    best = best.orderBy(gain.desc(), F.length("term"), "term").limit(4 * LEXICON).collect()
    out: dict[str, float] = {}
    rows: dict[str, int] = {}
    beside = 0  # words that a beginning covers: they are there for their misspellings, and take no other term's place
    for r in best:
        term, whole = r["term"], r["term"].rstrip("*")
        covered = any(f"{whole[:n]}*" in out for n in range(1, len(whole) + (term == whole)))
        if covered and term == whole:
            out[term] = r["weight"]
            beside += 1
            continue
        # A beginning adds nothing to a word that makes up most of it, and a word can be matched misspelled.
        mostly = term != whole and any(w.startswith(whole) and n >= 0.7 * r["toxic"] for w, n in rows.items())
        if len(out) - beside < LEXICON and not covered and not mostly:
            out[term] = r["weight"]
            rows[term] = r["toxic"]
    return out


class Automaton:
    """The table of a lexicon's trie and the Levenshtein automaton."""

    def __init__(self, terms: dict[str, float]):
        children: list[dict[int, int]] = [{}]
        accept: list[list[tuple[int, bool, bool]]] = [[]]  # (term, beginning, may be misspelled)
        bends = [False]
        self.weights = np.array([*terms.values(), 0.0])
        #: Weights of misspelled matches, and words that are none.
        self.bent, self.known = self.weights.copy(), frozenset()
        for t, term in enumerate(terms):
            node = 0
            path = [0]
            for byte in term.rstrip("*").encode():
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    accept.append([])
                    bends.append(False)
                node = children[node][byte]
                path.append(node)
            bend = len(term.rstrip("*")) >= SHORT
            accept[node].append((t, term.endswith("*"), bend))
            if bend:
                for p in path:
                    bends[p] = True
        symbols = sorted({b for c in children for b in c})
        self.symbol = np.zeros(256, np.int32)
        for k, b in enumerate(symbols):
            self.symbol[b] = k + 1
            if 97 <= b <= 122:
                self.symbol[b - 32] = k + 1

        # (node, 2) beside (node, 1): the last letter was there, as the end of a misspelled beginning needs.
        bent = [any(start and bend for _, start, bend in a) for a in accept]

        def closure(state):
            out = set(state)
            for node, edits in state:
                if edits == 0 and bends[node]:
                    out.update((c, 1) for c in children[node].values() if bends[c])
            return frozenset(out)

        def step(state, byte):
            out = set()
            for node, edits in state:
                if edits < 2 and byte in children[node]:
                    child = children[node][byte]
                    out.add((child, edits))
                    if edits == 1 and bent[child]:
                        out.add((child, 2))
                if edits == 0 and bends[node]:
                    out.add((node, 1))
                    out.update((c, 1) for c in children[node].values() if bends[c])
            # Paths with an edit go on only in terms that may have one.
            return closure({(node, edits) for node, edits in out if edits == 0 or bends[node]})

        def meaning(state):
            found = [(edits, -self.weights[t], t) for node, edits in state for t, start, bend in accept[node] if not start and edits < 2 and (edits == 0 or bend)]
            return min(found, default=(2, 0, -1))[::2]

        def begun(state):
            found = [(edits // 2, -self.weights[t], t) for node, edits in state for t, start, bend in accept[node] if start and (edits == 0 or (edits == 2 and bend))]
            return min(found, default=(2, 0, -1))[::2]

        # Beginnings stay matched whatever follows: they are kept beside the state of the walk.
        first = closure([(0, 0)])
        number, todo, table = {frozenset(): 0, first: 1}, deque([first]), [[0] * (len(symbols) + 1)]
        place = {b: k + 1 for k, b in enumerate(symbols)}
        self.edits, self.term, self.begin_edits, self.begins = [2], [-1], [2], [-1]

        def numbered(state):
            if state not in number:
                number[state] = len(number)
                todo.append(state)
            return number[state]

        while todo:
            state = todo.popleft()
            row = [numbered(step(state, None))] * (len(symbols) + 1)
            for byte in sorted({b for node, edits in state if edits < 2 for b in children[node]}):
                row[place[byte]] = numbered(step(state, byte))
            table.append(row)
            for (edits, term), kept in ((meaning(state), (self.edits, self.term)), (begun(state), (self.begin_edits, self.begins))):
                kept[0].append(edits)
                kept[1].append(term)
        self.table = np.array(table, np.int32)
        self.term, self.edits, self.begins, self.begin_edits = (np.array(x, np.int64) for x in (self.term, self.edits, self.begins, self.begin_edits))

    def match(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of each word that matches, its term and its edits."""
        word, place, state = np.arange(len(start)), start.copy(), np.ones(len(start), np.int32)
        best, best_edits = np.full(len(start), -1), np.full(len(start), 2)

        def better(at, term, edits):
            new = (term >= 0) & ((edits < best_edits[at]) | ((edits == best_edits[at]) & (self.weights[term] > self.weights[best[at]])))
            best[at[new]], best_edits[at[new]] = term[new], edits[new]

        while len(word):
            over = place >= end[word]
            if over.any():
                better(word[over], self.term[state[over]], self.edits[state[over]])
                word, place, state = word[~over], place[~over], state[~over]
            state = self.table[state, self.symbol[data[place]]]
            place = place + 1
            begins = self.begins[state] >= 0
            if begins.any():
                better(word[begins], self.begins[state[begins]], self.begin_edits[state[begins]])
            alive = state > 0
            word, place, state = word[alive], place[alive], state[alive]
        hit = np.flatnonzero(best >= 0)
        if self.known:
            hit = hit[[best_edits[k] == 0 or data[start[k]:end[k]].tobytes().lower() not in self.known for k in hit]]
        return hit, best[hit], best_edits[hit]

    def learn(self, found: list[tuple[bytes, int, int, int]], toxic: int, clean: int) -> None:
        """Weigh misspelled matches from (word, term, toxic rows, clean rows) of training rows."""
        self.known = frozenset(w for w, _, _, c in found if c >= ORDINARY)
        counts = np.zeros((2, len(self.weights)))
        for w, t, *n in found:
            if w not in self.known:
                counts[:, t] += n
        # Without matches the weight is the term's own.
        start = 0.5 * np.exp(self.weights) * (toxic + 1) / (clean + 1)
        self.bent = np.minimum(self.weights, np.log((counts[0] + start) / (toxic + 1)) - np.log((counts[1] + 0.5) / (clean + 1)))


def _misspelled(automaton: Automaton):
    def run(batches):
        schema = pa.schema([("word", pa.binary()), ("term", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])
        for b in batches:
            counts = Counter(), Counter()
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = [w.encode() for w in dict.fromkeys(_WORD.findall((text or "").lower()))]
                size = np.array([len(w) for w in own], np.int64)
                start = np.cumsum(size) - size
                hit, term, edits = automaton.match(np.frombuffer(b"".join(own), np.uint8), start, start + size)
                counts[label].update((own[h], t) for h, t, e in zip(hit.tolist(), term.tolist(), edits.tolist()) if e)
            both = sorted(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*((w, t, counts[1][w, t], counts[0][w, t]) for w, t in both)) if both else [[]] * 4, schema)], schema=schema)

    return run


def features(column: pa.Array, automaton: Automaton) -> np.ndarray:
    """One row of features per text."""
    data, offsets = flat(pc.utf8_lower(column))
    out = np.zeros((len(offsets) - 1, FEATURES))
    reports = {w.encode() for w in REPORTS}
    for first, stop in slices(offsets):
        mine, at = data[offsets[first]:offsets[stop]], offsets[first:stop + 1] - offsets[first]
        _, rows, start, end = words(mine, at, SPACE)
        solid = np.flatnonzero(~PUNCTUATION[mine])
        low, high = np.searchsorted(solid, start), np.searchsorted(solid, end)
        some = low < high
        total = np.bincount(rows, minlength=stop - first)
        rows, low, high, raw_start, raw_end = rows[some], low[some], high[some], start[some], end[some]
        if not len(rows):
            continue
        begin, finish = solid[low], solid[high - 1] + 1
        hit, term, edits = automaton.match(mine, begin, finish)
        some = (edits == 0) | (automaton.bent[term] >= math.log(RATIO))
        hit, term, edits = hit[some], term[some], edits[some]
        if not len(hit):
            continue
        row = rows[hit]
        row_first, row_last = np.searchsorted(rows, row), np.searchsorted(rows, row, "right") - 1
        left, right = np.maximum(hit - WINDOW, row_first), np.minimum(hit + WINDOW, row_last)
        marks = np.concatenate([[0], np.cumsum(QUOTES[mine])])
        before = marks[raw_start[hit] + 1] - marks[raw_start[left]]
        after = marks[raw_end[right]] - marks[np.maximum(raw_end[hit] - 1, raw_start[hit])]
        quoted = (before > 0) & (after > 0)
        for k in np.flatnonzero(~quoted):
            near = range(left[k], right[k] + 1)
            quoted[k] = any(mine[begin[j]:finish[j]].tobytes().lower() in reports for j in near if finish[j] - begin[j] <= 6)
        weight = np.where(edits == 0, automaton.weights[term], automaton.bent[term])
        count = lambda x: np.bincount(row, x, stop - first)  # noqa: B023, E731
        plain, exact = ~quoted, edits == 0
        part = out[first:stop]
        # A misspelled hit counts nearly like an exact one, so far as the labels don't say otherwise.
        part[:, 0] = np.log1p(count(weight * plain * np.where(exact, 1, 0.75)))
        part[:, 1] = count(plain) > 0
        part[:, 2] = np.log1p(count(weight * (plain & ~exact)))
        part[:, 3] = count(plain & ~exact) > 0
        part[:, 4] = np.log1p(count(weight * quoted))
        part[:, 5] = count(weight * plain) / np.sqrt(np.maximum(total, 1))
        new = np.unique(row * np.int64(len(automaton.weights)) + term) // len(automaton.weights)
        part[:, 6] = np.log1p(np.bincount(new, minlength=stop - first))
        part[:, 7] = count(weight) > 0
    return out


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.append(np.full(len(w) - 1, 0.5), 1e-6)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame):
    """The automaton and the weights, or None where there are not both labels to learn from."""
    small_batches(documents)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(~held_out())
    n = known.count()
    if n > TRAIN_ROWS:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < TRAIN_ROWS)
    # About TRAIN_ROWS narrow rows: a fixed bound for the broadcast.
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    automaton = Automaton(lexicon(rows, counts[1], counts[0]))
    found = rows.select("text", "toxic").mapInArrow(_misspelled(automaton), "word binary, term long, toxic long, clean long")
    found = found.groupBy("word", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()  # of about TRAIN_ROWS rows
    automaton.learn([(bytes(r["word"]), r["term"], r["toxic"], r["clean"]) for r in found], counts[1], counts[0])

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("x", pa.list_(pa.float64()))])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(features(b.column(2), automaton)), pa.list_(pa.float64()))], schema=schema)

    known = rows.select("doc_id", "toxic", "text").mapInArrow(run, "doc_id long, toxic int, x array<double>").toPandas()
    known["x"] = known["x"].map(tuple)
    known = known.sort_values(["doc_id", "toxic", "x"])
    if not len(known):
        return None
    return automaton, _fit(np.array(known["x"].tolist()).reshape(len(known), FEATURES), known["toxic"].to_numpy())


def _score(column: pa.Array, model) -> np.ndarray:
    if model is None:
        return np.zeros(len(column))
    automaton, w = model
    return 1 / (1 + np.exp(-np.clip(features(column, automaton) @ w[:-1] + w[-1], -30, 30)))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, held_out, score, predicted."""
    sent = documents.sparkSession.sparkContext.broadcast(train(documents, labels))

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_score(b.column(1), sent.value))], schema=schema)

    scored = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents``, with all their columns, that are not predicted toxic."""
    sent = documents.sparkSession.sparkContext.broadcast(train(documents, labels))
    at = documents.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_score(b.column(at), sent.value) < THRESHOLD))

    return documents.mapInArrow(run, documents.schema)
