"""Substring dedup by sliding sentence spans.

A sentence ends at a line break, or at . ! ? before white space; it is known by its lower-cased words. A
run of at least ``LEAST_SENTENCES`` sentences and ``LEAST_WORDS`` words, or a sentence of ``LONG_SENTENCE``
words alone, is repeated wherever it is found but at its first place (smallest id, then earliest sentence).
The sentences under repeated runs are removed from the text with the gaps after them.

Spans. Not all runs are hashed: of those that start at a sentence the shortest, and of those that end at it
the shortest. They cover all: a sentence of a repeated run either starts a span that ends in the run, or lies
in the span that ends where the run does, and the run's first place has the same spans. Equal spans have
equal lengths, so they meet by one hash.

Joining. A map block sorts its spans; places that are not the first of their block are repeated for
certain and leave at once, so a span sends one entry per block, however many copies there are. A
slice of the hash space then keeps each span's first place and gives back the others. Texts meet only the
places found in them.

Defined cases: a null text is empty. Texts with fewer sentences than a span lose nothing. Rows with
equal id and text are one document, each is returned. Rows without id come last in the order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.places import BLOCK, BLOCK_TYPE, GROUP, gathered, keyed, place_block, repeated_places, unpacked
from siltstone.llm.shared import PUNCTUATION, SPACE, U64, flat, mix, powers, runs, slices, small_batches, words, written

LEAST_SENTENCES, LEAST_WORDS, LONG_SENTENCE = 2, 20, 40

STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?"]] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """Hash, words, row, and first and last byte (with the gap after it) of every sentence that has a word."""
    hashes, rows, start, end = words(data, offsets, PUNCTUATION)
    if not len(hashes):
        none = np.zeros(0, np.int64)
        return none.astype(U64), none, none, none, none
    following = np.append(SPACE[data[1:]], True)
    stop = (data == 10) | (STOP[data] & following)
    stops = np.concatenate([[0], np.cumsum(stop)])
    head = np.ones(len(hashes), bool)
    head[1:] = (rows[1:] != rows[:-1]) | (stops[start[1:]] > stops[end[:-1]])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(hashes))
    up, down = powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * up[:len(hashes)], out=total[1:])
    n = last - first
    value = mix((total[last] - total[first]) * down[first] + n.astype(U64))
    row = rows[first]
    close = np.append(start[first[1:]], len(data))
    close = np.minimum(close, offsets[row + 1])
    begin = start[first]
    new = runs(row)
    begin = np.where(new, offsets[row], begin)
    return value, n, row, begin, close


def spans(value: np.ndarray, n: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, number of sentences and hash of every span, forward from each sentence and back from each."""
    m = len(value)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    total = np.concatenate([[0], np.cumsum(n)])
    first = np.arange(m)
    stop = np.maximum(np.searchsorted(total, total[:-1] + LEAST_WORDS), first + LEAST_SENTENCES)
    stop = np.where(n >= LONG_SENTENCE, first + 1, stop)
    row_end = np.searchsorted(row, row, "right")
    whole = stop <= row_end
    first, stop = first[whole], stop[whole]
    # Back, from each sentence that is no span alone.
    end = np.flatnonzero(n < LONG_SENTENCE) + 1
    back = np.minimum(np.searchsorted(total, total[end] - LEAST_WORDS, "right") - 1, end - LEAST_SENTENCES)
    inside = back >= np.searchsorted(row, row[end - 1])
    both = np.concatenate([first * (m + 1) + stop, back[inside] * (m + 1) + end[inside]])
    first, stop = np.divmod(np.unique(both), m + 1)
    up, down = powers(m + 1)
    chain = np.zeros(m + 1, U64)
    np.cumsum(value * up[:m], out=chain[1:])
    return first, stop - first, mix((chain[stop] - chain[first]) * down[first] + (stop - first).astype(U64))


def _blocks(groups: int):
    def run(batches):
        parts, size = [], 0
        for ids, digests, _, found in _sliced(batches):
            value, n, row, _, _ = found
            first, count, span = spans(value, n, row)
            begin = np.searchsorted(row, row[first]) if len(first) else first
            parts.append((span, ids[row[first]], digests[row[first]], first - begin, count))
            size += len(span)
            if size >= BLOCK:
                yield place_block(parts, groups)
                parts, size = [], 0
        if size:
            yield place_block(parts, groups)

    return run


def _sliced(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        data, offsets = flat(b.column(1))
        ids, digests = (b.column(c).to_numpy() for c in ("row", "digest"))
        for start, stop in slices(offsets):
            part = offsets[start:stop + 1]
            mine, at = data[part[0]:part[-1]], part - part[0]
            yield ids[start:stop], digests[start:stop], (mine, at), sentences(mine, at)


def _clean(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("n_runs", pa.int64())])
    for b in batches:
        out = []
        for doc, text, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            raw = (text or "").encode()
            data = np.frombuffer(raw, np.uint8)
            value, _, _, begin, close = sentences(data, np.array([0, len(data)]))
            gone = np.zeros(len(value) + 1, np.int64)
            first, n = unpacked(places)
            np.add.at(gone, first, 1)
            np.add.at(gone, first + n, -1)
            gone = np.cumsum(gone)[:-1] > 0
            if gone.any():
                text = b"".join(raw[x:y] for x, y, g in zip(begin.tolist(), close.tolist(), gone.tolist()) if not g).decode()
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1)
            out.append((doc, text or "", len(value), int(gone.sum()), len(edge)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, schema)], schema=schema)


def without_repeated_spans(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, the text that is left, n_sentences, n_removed, n_runs."""
    texts = small_batches(keyed(documents))
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(64, math.ceil(total / 60 / GROUP))
    places = written(gathered(repeated_places(texts.mapInArrow(_blocks(groups), BLOCK_TYPE))), "places")
    return texts.join(places, ["row", "digest"], "left").select("doc_id", "text", "places").mapInArrow(
        _clean, "doc_id long, text string, n_sentences long, n_removed long, n_runs long")
