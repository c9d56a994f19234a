"""Periodic runs of words, found on the diagonals where a text equals itself some words earlier.

A run of period ``q`` is a stretch whose words equal those ``q`` words before; it has to span at least
``FULL`` periods and ``LEAST_WORDS`` words. On the diagonal of lag ``q`` it is a chain of at least
``(FULL - 1) * q`` matches. Diagonals are sparse: only earlier occurrences of the same word make a match.
So that a word in a third of a text does not make a match with all its earlier places, lags of ``size`` to
``2 * size - 1`` words (``size`` a power of two) are followed in steps of ``size`` words: at every
``size``-th word, the earlier occurrences of the ``size`` words from there raise the match lengths of
their lags by one step, and a diagonal that has no next step is cut to its exact ends and emitted if long
enough. A chain of ``3 * q`` matches holds two whole steps, so none is missed; a text of n words has at
most n entries a size, also if all its words are the same. Sizes end as soon as no sequence of that many
words repeats within its text.

Words are compared by 64-bit hashes, sequences by hashes of their halves. The text is the unit of work and
stays in its row; nothing is shuffled, and texts are taken a megabyte at a time (a longer one alone).

Null text: no words. Null id: the text is taken as it is (nothing to derive its rewriting from). Repeated
rows give repeated results, an empty table an empty one, other columns are not read. Runs with equal
exponents: the smallest start counts, then the smallest period.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import BYTE_CODE, SPACE, U64, batch, flat, mix, runs, slices, words

#: A run spans at least so many of its periods, and so many words.
FULL, LEAST_WORDS = 4, 6
NO_RUNS = hashlib.sha256(b"").hexdigest()

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])
TYPE = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _steps(hashes: np.ndarray, alive: np.ndarray, row: np.ndarray, begin: np.ndarray, size: int):
    """(place, lag) of matching steps of a size, and which places are repeated within their row."""
    at = np.flatnonzero(alive)
    key = mix(hashes[at] * U64(0x9E3779B97F4A7C15) + mix(row[at].astype(U64) + U64(1)))
    order = np.argsort(key, kind="stable")
    at, new = at[order], runs(key[order])
    group = np.cumsum(new) - 1
    repeated = np.bincount(group, minlength=1)[group] > 1
    at, group = at[repeated], group[repeated]
    sorted_places = group * (len(hashes) + 1) + at
    step = (at - begin[at]) % size == 0
    place, base = at[step], sorted_places[step]
    low = np.searchsorted(sorted_places, base - np.minimum(2 * size - 1, place), "left")
    high = np.searchsorted(sorted_places, base - size, "right")
    count = np.maximum(high - low, 0)
    place = np.repeat(place, count)
    nth = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
    lag = place - at[np.repeat(low, count) + nth]
    seen = np.zeros(len(hashes), bool)
    seen[at] = True
    return place, lag, seen


def periodic_runs(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and smallest period of every run, by first word; rows are ascending."""
    n, empty = len(hashes), np.zeros(0, np.int64)
    if n == 0:
        return empty, empty, empty
    head = np.flatnonzero(runs(row))
    sizes = np.diff(np.append(head, n))
    begin, end = np.repeat(head, sizes), np.repeat(head + sizes, sizes)
    place = np.arange(n)
    alive = end - begin >= LEAST_WORDS
    levels, found, size = [hashes], [(empty, empty, empty)], 1
    while alive.any():
        here = levels[-1]
        at, lag, seen = _steps(here, alive, row, begin, size)
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        chain = np.ones(len(at), bool)
        chain[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + size)
        first = np.flatnonzero(chain)
        last = np.append(first[1:], len(at)) - 1
        long = last > first
        left, right, lag = at[first[long]], at[last[long]] + size, lag[first[long]]
        # The exact ends: less than one step further on either side.
        for level in reversed(range(len(levels) - 1)):
            span, code = 1 << level, levels[level]
            ok = right + span <= end[left]
            ok[ok] = code[right[ok]] == code[right[ok] - lag[ok]]
            right = right + ok * span
            ok = left - span - lag >= begin[left]
            ok[ok] = code[left[ok] - span] == code[left[ok] - span - lag[ok]]
            left = left - ok * span
        whole = (right - left >= (FULL - 1) * lag) & (right - left + lag >= LEAST_WORDS)
        found.append((left[whole] - lag[whole], right[whole], lag[whole]))
        # The next size: of places that repeat, those followed by places that repeat.
        alive = seen & (FULL * 2 * size <= end - begin) & (place + 2 * size <= end)
        alive[:max(n - size, 0)] &= seen[size:]
        alive[max(n - size, 0):] = False
        longer = np.zeros(n, U64)
        longer[:max(n - size, 0)] = mix(here[:max(n - size, 0)] * U64(0x9E3779B97F4A7C15) + mix(here[size:] + U64(size)))
        levels.append(longer)
        size *= 2
    start, stop, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    smallest = runs(start, stop)
    start, stop, period = start[smallest], stop[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], (stop - start)[order], period[order]


def rewritten_from(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """First word and period of the repetition planted in a text of n words, if its id asks for one."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _of_slice(ids: list, data: np.ndarray, offsets: np.ndarray):
    """Result columns of the texts of one slice."""
    hashes, row, first, last = words(data, offsets, SPACE, BYTE_CODE)
    cuts = np.searchsorted(row, np.arange(len(ids) + 1))
    source = np.arange(len(hashes))
    for r, doc_id in enumerate(ids):
        planted = rewritten_from(doc_id, int(cuts[r + 1] - cuts[r]))
        if planted:
            a, p = planted
            source[cuts[r] + a:cuts[r + 1]] = cuts[r] + a + np.arange(cuts[r + 1] - cuts[r] - a) % p
    start, length, period = periodic_runs(hashes[source], row)
    # Words beyond the first period of a run go: +1 where a stretch begins, -1 where it ends.
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    kept = np.cumsum(edge[:-1]) == 0
    at = np.searchsorted(start, cuts)
    for r, doc_id in enumerate(ids):
        found = [(int(s - cuts[r]), int(x), int(q)) for s, x, q in zip(*(c[at[r]:at[r + 1]] for c in (start, length, period)))]
        mine = source[cuts[r]:cuts[r + 1]][kept[cuts[r]:cuts[r + 1]]]
        text = data[offsets[r]:offsets[r + 1]].tobytes()
        if len(mine) == cuts[r + 1] - cuts[r] and mine.size and mine[-1] - mine[0] == len(mine) - 1 and (np.diff(mine) == 1).all():
            collapsed = b" ".join(text.split())
        else:
            collapsed = b" ".join([text[b:e] for b, e in zip((first[mine] - offsets[r]).tolist(), (last[mine] - offsets[r]).tolist())])
        best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if found else (None, None, None)
        listed = hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in found).encode()).hexdigest() if found else NO_RUNS
        yield (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, listed, hashlib.sha256(collapsed).hexdigest())


def _periodic(batches):
    for b in batches:
        data, offsets = flat(b.column(1))
        ids = b.column(0).to_pylist()
        for low, high in slices(offsets):
            rows = _of_slice(ids[low:high], data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
            yield batch(SCHEMA, *zip(*rows))


def word_runs(documents: DataFrame) -> DataFrame:
    """Number of runs, the most repetitive one, and digests of all runs and of the text without repetitions, per document."""
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_periodic, TYPE)
