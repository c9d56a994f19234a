"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of ASCII letters, digits and other characters. Documents and test items are
joined on shared runs of ``SEED`` words (rolling hashes looked up in the sorted index of the items). For
each document and item the seeds are joined along diagonals to the longest matches; the longest match
whose words are unmarked on both sides is marked again and again, cut matches are put back, until none
of ``SEED`` words is left. The share of the item's words under tiles is the coverage: moved sentences
count like a verbatim passage. From ``COVERAGE`` on, the item leaked.

The index of the items is sent to all tasks in blocks of at most ``BLOCK_WORDS`` words (an item is in
one block), each in a pass of its own, so its size is bounded however large the benchmark is. A text's
seeds are joined ``HITS`` hits at a time, and a text with more takes its items some at a time: a very long
text of one word needs no more memory than another.

Defined cases: null or empty texts and items match nothing. An item of fewer than ``SEED`` words
matches only by its whole word sequence. Repeated rows and repeated items are all reported. Rows without
id are reported with a null id. Extra columns are ignored by ``leaks`` and kept by ``decontaminated``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import PUNCTUATION, flat, grams, runs, slices, small_batches, words

SEED = 5
COVERAGE = 0.5
BLOCK_WORDS = 2_000_000
#: Places of seeds in the items that are looked at together.
HITS = 1 << 20


def _index(texts: list[str]) -> dict:
    data, offsets = flat(pa.array(texts, pa.large_string()))
    hashes, rows, _, _ = words(data, offsets, PUNCTUATION)
    size = np.bincount(rows, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(size)])
    index = {"size": size}
    for k in range(1, SEED + 1):
        seed, at = grams(hashes, rows, k)
        mine = size[rows[at]] == k if k < SEED else np.ones(len(at), bool)
        seed, at = seed[mine], at[mine]
        if len(seed):
            order = np.argsort(seed, kind="stable")
            index[k] = seed[order], rows[at][order], (at - begin[rows[at]])[order]
    return index


def _open(used: bytearray, least: int) -> np.ndarray:
    """Number of places before each one from which ``least`` words are free."""
    taken = np.concatenate([[0], np.cumsum(np.frombuffer(used, np.uint8), dtype=np.int64)])
    n = len(used)
    free = taken[np.minimum(np.arange(n) + least, n)] == taken[:-1]
    return np.concatenate([[0], np.cumsum(free)])


def tile(matches, least: int, whole: int | None = None) -> list[tuple[int, int, int]]:
    """Greedy tiles of (document word, item word, length) matches, longest first, none under ``least``.

    ``whole`` is the item's length: when fewer than ``least`` of its words are free, no tile can follow.
    """
    matches = np.asarray(matches, np.int64).reshape(-1, 3)
    d, i, n = matches.T
    order = np.lexsort((i, d, -n))
    low_d = int(d.min(initial=0))
    used_d, used_i = bytearray(int((d + n).max(initial=0)) - low_d), bytearray(int((i + n).max(initial=0)))
    cut: list[tuple[int, int, int]] = []  # what is left of matches that lost words to longer ones
    tiles, free_i, at, tried = [], len(used_i) if whole is None else whole, 0, 0
    while free_i >= least and (at < len(order) or cut):
        if tried > max(1000, (len(order) - at) // 8):  # drop matches without a free run on either side
            rest, at, tried = order[at:], 0, 0
            open_d, open_i = _open(used_d, least), _open(used_i, least)
            x, y, until = d[rest] - low_d, i[rest], n[rest] - least + 1
            order = rest[(open_d[x + until] > open_d[x]) & (open_i[y + until] > open_i[y])]
            continue
        tried += 1
        there = (-int(n[order[at]]), int(d[order[at]]), int(i[order[at]])) if at < len(order) else None
        if cut and (there is None or cut[0] < there):
            size, x, y = heapq.heappop(cut)
        else:
            (size, x, y), at = there, at + 1
        size, x = -size, x - low_d
        if used_d.find(1, x, x + size) < 0 and used_i.find(1, y, y + size) < 0:
            tiles.append((x + low_d, y, size))
            used_d[x:x + size] = used_i[y:y + size] = b"\x01" * size
            free_i -= size
            continue
        taken = np.frombuffer(used_d, np.uint8, size, x) | np.frombuffer(used_i, np.uint8, size, y)
        edges = np.flatnonzero(np.diff(taken, prepend=1, append=1))
        for start, stop in edges.reshape(-1, 2).tolist():
            if stop - start >= least:
                heapq.heappush(cut, (start - stop, x + low_d + start, y + start))
    return tiles


def _matches(row, item, d, i, seeds):
    """Join the parts of matches of one row and item that follow each other on a diagonal; ``seeds`` counts a part's seeds."""
    diagonal = d - i
    order = np.lexsort((d, diagonal, item, row))
    row, item, d, i, diagonal, seeds = (x[order] for x in (row, item, d, i, diagonal, seeds))
    first = np.flatnonzero(runs(row, item, diagonal, d - np.cumsum(seeds) + seeds))
    total = np.add.reduceat(seeds, first) if len(first) else seeds
    return row[first], item[first], d[first], i[first], total


def _expanded(rows, at, low, n, index):
    """Matches of a text's seeds, ``HITS`` hits at a time, so that repetitive texts don't fill the worker."""
    _, items, places = index
    parts = []
    for a, b in slices(np.concatenate([[0], np.cumsum(n)]), HITS):
        m = n[a:b]
        entry = np.repeat(low[a:b] - np.cumsum(m) + m, m) + np.arange(m.sum())
        d = np.repeat(at[a:b], m)
        parts.append(_matches(rows[d], items[entry], d, places[entry], np.ones(len(d), np.int64)))
    return parts[0] if len(parts) == 1 else _matches(*(np.concatenate(x) for x in zip(*parts)))


def _groups(seed, at, rows, index, size, k):
    """Matches of whole (row, item) pairs: all at once if they have few hits, else row by row and some items at a time."""

    def hits(seed, at, keys):
        low = np.searchsorted(keys, seed)
        hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == seed)
        low = low[hit]
        return at[hit], low, np.searchsorted(keys, seed[hit], "right") - low

    at, low, n = hits(seed, at, index[0])
    if not len(at):
        return
    if n.sum() <= HITS:
        yield _expanded(rows, at, low, n, index)
        return
    first = np.flatnonzero(runs(rows[at]))
    for a, b in zip(first, np.append(first[1:], len(at))):
        if n[a:b].sum() <= HITS:
            yield _expanded(rows, at[a:b], low[a:b], n[a:b], index)
            continue
        # Hits of each item, counted by entry of the index; an item with too few for its coverage can't leak.
        change = np.zeros(len(index[0]) + 1, np.int64)
        np.add.at(change, low[a:b], 1)
        np.add.at(change, low[a:b] + n[a:b], -1)
        count = np.bincount(index[1], np.cumsum(change)[:-1], len(size)).astype(np.int64)
        count[count * k < COVERAGE * size] = 0
        own = np.flatnonzero(count)
        entries = low[a:b]
        for x, y in slices(np.concatenate([[0], np.cumsum(count[own])]), HITS):
            mine = np.zeros(len(size), bool)
            mine[own[x:y]] = True
            mine = mine[index[1]]
            part = tuple(column[mine] for column in index)
            at_, low_, n_ = hits(index[0][entries], at[a:b], part[0])
            yield _expanded(rows, at_, low_, n_, part)


def _found(column: pa.Array, index: dict) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, tiles, words under them) of the items that a row's text covers enough."""
    data, offsets = flat(column)
    size = index["size"]
    for start, stop in slices(offsets):
        part = offsets[start:stop + 1]
        hashes, rows, _, _ = words(data[part[0]:part[-1]], part - part[0], PUNCTUATION)
        for k in range(1, SEED + 1):
            if k not in index:
                continue
            seed, at = grams(hashes, rows, k)
            for row, item, d, i, seeds in _groups(seed, at, rows, index[k], size, k):
                length = seeds + k - 1
                pair = np.flatnonzero(runs(row, item))
                for a, b in zip(pair, np.append(pair[1:], len(row))):
                    whole = int(size[item[a]])
                    if length[a:b].sum() < COVERAGE * whole:
                        continue
                    tiles = tile(np.column_stack((d[a:b], i[a:b], length[a:b])), k, whole)
                    covered = sum(t[2] for t in tiles)
                    if covered >= COVERAGE * whole:
                        yield start + int(row[a]), int(item[a]), len(tiles), covered


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, object]]:
    """Item ids and the broadcast index of each block of items."""
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    total = bench.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_WORDS))
    for k in range(n):
        rows = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toPandas()
        index = _index(rows["text"].tolist())
        if len(index) > 1:
            ids = [None if x != x or x is None else int(x) for x in rows["item_id"].astype(object)]
            yield ids, benchmark.sparkSession.sparkContext.broadcast((ids, index))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_tiles, covered_words, item_words, coverage) of every leaked item."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_tiles", pa.int64()), ("covered_words", pa.int64()), ("item_words", pa.int64()), ("coverage", pa.float64())])

    def run(sent):
        def tiles(batches):
            ids, index = sent.value
            for b in batches:
                found = list(_found(b.column(1), index))
                doc = b.column(0).to_pylist()
                size = index["size"]
                rows = [(doc[r], ids[i], n, covered, int(size[i]), covered / int(size[i])) for r, i, n, covered in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, schema)], schema=schema)
        return tiles

    texts = small_batches(documents.select(F.col("doc_id").cast("long"), "text"))
    kind = "doc_id long, item_id long, n_tiles long, covered_words long, item_words long, coverage double"
    out = documents.sparkSession.createDataFrame([], kind)
    for _, sent in _blocks(benchmark):
        out = out.union(texts.mapInArrow(run(sent), kind))
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, with all their columns, into which no item leaked."""

    def run(sent, at):
        def clean(batches):
            _, index = sent.value
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[r for r, *_ in _found(b.column(at), index)]] = False
                yield b.filter(pa.array(keep))
        return clean

    small_batches(documents)
    for _, sent in _blocks(benchmark):
        documents = documents.mapInArrow(run(sent, documents.columns.index("text")), documents.schema)
    return documents
