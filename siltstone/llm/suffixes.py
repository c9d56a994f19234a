"""Exact substring dedup over UTF-8 bytes with a run-length Burrows-Wheeler index.

Every byte under a ``LENGTH``-byte string that also starts earlier (smaller id, or same document and
earlier start) is removed; matches may overlap and never cross documents.

Dealing. A window (a ``LENGTH``-byte string) is known by its minimizer, its ``GRAM``-byte string of
smallest hash: equal windows have equal ones at the same place. Neighbouring windows with one minimizer
make a segment. Segments meet by minimizer in slices of the hash space. Of equal segments all but the
first are repeated whole, which a map block already sees of its own, so copies cost one entry a block.
Only a minimizer with several different segments needs their bytes: those segments meet again, in bins
of about ``BIN`` bytes.

Index. A bin's segments, each with an end mark of its own, are suffix sorted. The transform is kept as
runs, and suffixes are sampled at the run ends. Only there are longest common prefixes computed by
comparing bytes; inside a run they follow from the place before by streaming over the text, one less for
each byte. Neighbours in suffix order that share ``LENGTH`` bytes are one string, and all but its first
place are marked.

Hot minimizers. One in more than ``HOT`` different segments (inside a very common line) is not indexed:
the hashes of its windows meet instead, again one entry per block, which is exact at any size.

Defined cases: a null text is empty. Texts under ``LENGTH`` bytes lose nothing. Rows with equal id and
text are one document, each is returned. Rows without id come last in the order.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.places import (
    BLOCK, BLOCK_TYPE, GROUP, UNITS, by_document, filled, gathered, keyed, place_block, repeated_places, unpacked,
)
from siltstone.llm.shared import (
    BROADCAST_ROWS, BYTE_CODE, U64, batch, flat, mix, number_bytes, pack, powers, runs, signed, slices, small_batches, unpack, written,
)

LENGTH, GRAM = 100, 32
BIN = 1 << 19
HOT = 4_000

#: Bytes of remaining texts that leave a worker together.
KEPT_BYTES = 8 << 20

FULL, BYTES, WINDOWS = 0, 1, 2


def _prefix_sums(data: np.ndarray):
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODE[data] * up[:len(data)], out=total[1:])
    return total, down


def segments(data: np.ndarray, offsets: np.ndarray):
    """Row, first byte, number of windows, minimizer and digest of every segment."""
    n, last = len(data), offsets[1:] - LENGTH
    none = np.zeros(0, np.int64)
    rows = np.flatnonzero(last >= offsets[:-1])
    if not len(rows):
        return none, none, none, none.astype(U64), none.astype(U64)
    total, down = _prefix_sums(data)
    gram = mix((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
    bits = U64(n.bit_length())
    low = (U64(1) << bits) - U64(1)
    least = (gram & ~low) | np.arange(len(gram), dtype=U64)
    width, reach = LENGTH - GRAM + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    valid = np.zeros(n + 1, np.int8)
    np.add.at(valid, offsets[rows], 1)
    np.add.at(valid, last[rows] + 1, -1)
    window = np.flatnonzero(np.cumsum(valid[:-1], dtype=np.int8))
    where = (least[window] & low).astype(np.int64)
    head = np.flatnonzero(runs(where))
    first = window[head]
    count = np.diff(np.append(head, len(window)))
    stop = first + count + LENGTH - 1
    digest = mix((total[stop] - total[first]) * down[first] + U64(LENGTH))
    return np.searchsorted(offsets, first, "right") - 1, first, count, gram[where[head]], digest


# First meeting: by minimizer --------------------------------------------------------------------

MET = pa.schema([("slice", pa.int32()), ("base", pa.int64()), ("widths", pa.list_(pa.int32())), ("gram", pa.binary()), ("segment", pa.binary()), ("doc", pa.binary()), ("digest", pa.binary()), ("first", pa.binary()), ("n", pa.binary()), ("repeated", pa.bool_())])
MET_TYPE = "slice int, base long, widths array<int>, gram binary, segment binary, doc binary, digest binary, first binary, n binary, repeated boolean"


def _meet_blocks(groups: int):
    def block(parts):
        gram, segment, doc, digest, first, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((first, digest, doc, segment, gram))
        gram, segment, doc, digest, first, n = (x[order] for x in (gram, segment, doc, digest, first, n))
        keep = runs(gram, segment, doc, digest, first)
        gram, segment, doc, digest, first, n = (x[keep] for x in (gram, segment, doc, digest, first, n))
        later = ~runs(gram, segment)
        where = np.where(later, doc ^ digest, (gram >> U64(24)).astype(np.int64)) % groups
        base = int(doc.min())
        widths = [number_bytes(int(doc.max()) - base), number_bytes(first.max())]
        out = [[] for _ in MET]
        for repeated in (False, True):
            mine = np.flatnonzero(later == repeated)
            for g, o in filled(where, mine):
                hashes = (b"", b"") if repeated else (pack(gram[o], 6), pack(segment[o], 8))
                row = (g, base, widths, *hashes, pack(doc[o].astype(U64) - U64(base % (1 << 64)), widths[0]), pack(digest[o], 8), pack(first[o], widths[1]), pack(n[o], 1), repeated)
                for c, v in zip(out, row):
                    c.append(v)
        return batch(MET, *out)

    def run(batches):
        parts, size = [], 0
        for b in batches:
            data, offsets = flat(b.column(1))
            ids, digests = (b.column(c).to_numpy() for c in ("row", "digest"))
            for start, stop in slices(offsets):
                mine, at = data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
                row, first, n, gram, segment = segments(mine, at)
                parts.append((gram, segment, ids[start:stop][row], digests[start:stop][row], first - at[row], n))
                size += len(gram)
                if size >= BLOCK:
                    yield block(parts)
                    parts, size = [], 0
        if size:
            yield block(parts)

    return run


def _settle(table: pa.Table) -> pa.Table:
    """Per document of one slice: places repeated whole, and places whose bytes or windows have to meet."""
    out, kept = [], []
    for r in table.to_pylist():
        w = r["widths"]
        doc = signed(unpack(r["doc"], w[0]) + U64(r["base"] % (1 << 64)))
        place = doc, unpack(r["digest"], 8).view(np.int64), unpack(r["first"], w[1]).view(np.int64), unpack(r["n"], 1).view(np.int64)
        if r["repeated"]:
            out.append((np.full(len(doc), FULL), np.zeros(len(doc), U64), *place))
        else:
            kept.append((unpack(r["gram"], 6), unpack(r["segment"], 8), *place))
    if kept:
        gram, segment, doc, digest, first, n = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((first, digest, doc, segment, gram))
        gram, segment, doc, digest, first, n = (x[order] for x in (gram, segment, doc, digest, first, n))
        keep = runs(gram, segment, doc, digest, first)
        gram, segment, doc, digest, first, n = (x[keep] for x in (gram, segment, doc, digest, first, n))
        lead = runs(gram, segment)
        group = np.cumsum(runs(gram)) - 1
        different = np.bincount(group, lead)[group]
        kind = np.where(~lead, FULL, np.where(different > HOT, WINDOWS, BYTES))
        use = ~lead | (different > 1)
        out.append((kind[use], gram[use], doc[use], digest[use], first[use], n[use]))
    kind, gram, doc, digest, first, n = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((first, digest, doc, kind))
    kind, gram, doc, digest, first, n = (x[order] for x in (kind, gram, doc, digest, first, n))
    head = np.flatnonzero(runs(kind, doc, digest))
    cuts = list(zip(head, np.append(head[1:], len(doc))))
    return pa.table({
        "row": doc[head], "digest": digest[head], "kind": pa.array(kind[head], pa.int32()),
        "places": pa.array([pack((first[a:b] << UNITS) | n[a:b], 8) for a, b in cuts], pa.binary()),
        "grams": pa.array([pack(gram[a:b], 6) if kind[a] == BYTES else b"" for a, b in cuts], pa.binary()),
        "size": pa.array([int((n[a:b] + LENGTH).sum()) for a, b in cuts], pa.int64()),
    })


# Second meeting: bytes in bins, or window hashes ------------------------------------------------

BINNED = pa.schema([("bin", pa.int64()), ("doc", pa.binary()), ("digest", pa.binary()), ("first", pa.binary()), ("size", pa.binary()), ("bytes", pa.binary())])
BINNED_TYPE = "bin long, doc binary, digest binary, first binary, size binary, bytes binary"


def _bytes_blocks(bins: int):
    """Rows (row, digest, text, places, grams) to the bytes of their segments by bin."""

    def block(parts):
        rows, order = [], np.argsort([p[0] for p in parts], kind="stable")
        where = np.array([parts[i][0] for i in order])
        head = np.flatnonzero(runs(where))
        for a, b in zip(head, np.append(head[1:], len(where))):
            mine = [parts[i] for i in order[a:b]]
            numbers = [np.array([p[c] for p in mine], np.int64) for c in (1, 2, 3)]
            size = np.array([len(p[4]) for p in mine], np.int64)
            rows.append((int(where[a]), *(x.tobytes() for x in numbers), size.tobytes(), zlib.compress(b"".join(p[4] for p in mine), 1)))
        return batch(BINNED, *zip(*rows))

    def run(batches):
        parts, size = [], 0
        for b in batches:
            for r in range(b.num_rows):
                row, digest, text, places, grams = (c[r].as_py() for c in b.columns)
                raw = text.encode()
                first, n = unpacked(places)
                where = mix(unpack(b"".join(grams), 6)) % U64(bins)
                for w, f, c in zip(where.tolist(), first.tolist(), n.tolist()):
                    parts.append((w, row, digest, f, raw[f:f + c + LENGTH - 1]))
                    size += c + LENGTH
                if size >= 8 * BIN:
                    yield block(parts)
                    parts, size = [], 0
        if parts:
            yield block(parts)

    return run


def suffix_array(text: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Suffix order of symbols above 0; each 0 is an end mark, the smaller the earlier. ``mark``: marks before a place."""
    n = len(text)
    symbols = 5 if mark[-1] < 1 << 18 else 3
    key, open_ = np.zeros(n, U64), np.ones(n, bool)
    for j in range(symbols):
        here = np.zeros(n, U64)
        here[:max(0, n - j)] = text[j:]
        key = (key << U64(9)) | np.where(open_, here, U64(0))
        open_ &= here > 0
    key = (key << U64(64 - 9 * symbols)) | np.where(open_, U64(0), mark.astype(U64) + U64(1))
    reach = symbols
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(runs(key[order]))
        if rank[order[-1]] == n:
            return order
        ahead = np.zeros(n, np.int64)
        ahead[:max(0, n - reach)] = rank[reach:]
        key = rank.astype(U64) * U64(n + 1) + ahead.astype(U64)
        reach *= 2


def repeated_starts(data: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Which places of the joined segments start a ``length``-byte string that starts at an earlier place too."""
    n = len(data) + len(size)
    stop = np.cumsum(size + 1)
    text = np.zeros(n, np.int64)
    inside = np.ones(n, bool)
    inside[stop - 1] = False
    text[inside] = data.astype(np.int64) + 1
    mark = np.cumsum(~inside) - ~inside
    order = suffix_array(text, mark)
    # The transform's runs, with suffixes sampled at their ends.
    before = text[order - 1]
    before[order == 0] = 0
    head = runs(before) | (before == 0)
    run = np.flatnonzero(head)
    ends, starts = order[run[1:] - 1], order[run[1:]]
    # Prefixes shared across run ends, by comparing bytes.
    shared = np.zeros(len(starts), np.int64)
    active = np.arange(len(starts))
    step = 0
    while len(active):
        x, y = text[ends[active] + step], text[starts[active] + step]
        active = active[(x == y) & (x > 0)]
        step += 1
        shared[active] = step
    # Everywhere else they follow from the place before.
    reach = np.zeros(n, np.int64)
    reach[starts] = shared + starts
    reach[order[0]] = order[0]
    prefix = np.maximum.accumulate(reach) - np.arange(n)
    same = prefix[order] >= length
    same[0] = False
    group = np.cumsum(~same) - 1
    first = np.minimum.reduceat(order, np.flatnonzero(~same))
    out = np.zeros(n, bool)
    out[order[order != first[group]]] = True
    return out[inside]


def _index(table: pa.Table) -> pa.Table:
    """Places of one bin that start a string which starts earlier."""
    numbers = [np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column(c)]) for c in ("doc", "digest", "first", "size")]
    doc, digest, first, size = numbers
    data = np.frombuffer(b"".join(zlib.decompress(x.as_py()) for x in table.column("bytes")), np.uint8)
    begin = np.cumsum(size) - size
    order = np.lexsort((first, digest, doc))
    doc, digest, first, size, begin = (x[order] for x in (doc, digest, first, size, begin))
    one = runs(doc, digest, first)  # a repeated row is one document
    doc, digest, first, size, begin = (x[one] for x in (doc, digest, first, size, begin))
    joined = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    found = np.flatnonzero(repeated_starts(data[joined], size, LENGTH))
    stop = np.cumsum(size)
    segment = np.searchsorted(stop, found, "right")
    start = first[segment] + found - (stop - size)[segment]
    head = np.flatnonzero(runs(segment, start - np.arange(len(start))))
    count = np.diff(np.append(head, len(start)))
    return by_document(doc[segment[head]], digest[segment[head]], start[head], count)


def _window_blocks(groups: int):
    """Rows (row, digest, text, places) to blocks of window hashes."""

    def run(batches):
        parts, size = [], 0
        for b in batches:
            for r in range(b.num_rows):
                row, digest, text, places, _ = (c[r].as_py() for c in b.columns)
                data = np.frombuffer(text.encode(), np.uint8)
                total, down = _prefix_sums(data)
                first, n = unpacked(places)
                start = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                parts.append((mix((total[start + LENGTH] - total[start]) * down[start]), np.full(len(start), row), np.full(len(start), digest), start, np.ones(len(start), np.int64)))
                size += len(start)
                if size >= BLOCK:
                    yield place_block(parts, groups)
                    parts, size = [], 0
        if size:
            yield place_block(parts, groups)

    return run


# Texts ------------------------------------------------------------------------------------------


def _cut(kept: bool):
    """Rows (doc_id, text, places) to what is removed from each, with the rest itself if asked for."""
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept", pa.binary())] * kept)

    def row(doc, text, places):
        raw = (text or "").encode()
        left, removed, spans = raw, 0, 0
        if places:
            first, n = unpacked(places)
            under = np.zeros(len(raw) + 1, np.int64)
            np.add.at(under, first, 1)
            np.add.at(under, first + n + LENGTH - 1, -1)
            gone = np.cumsum(under)[:-1] > 0
            left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            removed, spans = int(gone.sum()), int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
        return (doc, len(raw), removed, spans, hashlib.sha256(left).hexdigest(), *[left] * kept)

    def run(batches):
        for b in batches:
            out, size = [], 0
            for r in range(b.num_rows):  # one text at a time
                out.append(row(*(c[r].as_py() for c in b.columns)))
                size += len(out[-1][-1]) if kept else 0
                if size >= KEPT_BYTES:
                    yield batch(schema, *zip(*out))
                    out, size = [], 0
            if out:
                yield batch(schema, *zip(*out))

    return run


def without_repeated_bytes(documents: DataFrame, kept: bool = True) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept`` (bytes) if asked for."""
    texts = small_batches(keyed(documents))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(64, math.ceil(total / 35 / GROUP))
    met = texts.mapInArrow(_meet_blocks(groups), MET_TYPE)
    kind = "row long, digest long, kind int, places binary, grams binary, size long"
    found = written(met.groupBy("slice").applyInArrow(_settle, kind), "segments")

    def with_texts(places: DataFrame) -> DataFrame:
        ids = places.select("row").distinct()
        few = ids.count() <= BROADCAST_ROWS
        return (texts.join(F.broadcast(ids), "row", "left_semi") if few else texts).join(places, ["row", "digest"])

    marks = found.filter(F.col("kind") == FULL).select("row", "digest", "places")
    size = {r["kind"]: r["size"] for r in found.groupBy("kind").agg(F.sum("size").alias("size")).collect()}
    parts = lambda k: with_texts(found.filter(F.col("kind") == k).groupBy("row", "digest").agg(*(F.sort_array(F.collect_list(F.struct("places", "grams"))).getField(c).alias(c) for c in ("places", "grams")))).select("row", "digest", "text", "places", "grams")
    if BYTES in size:
        bins = max(64, math.ceil(size[BYTES] / BIN))
        binned = parts(BYTES).mapInArrow(_bytes_blocks(bins), BINNED_TYPE)
        marks = marks.union(binned.groupBy("bin").applyInArrow(_index, "row long, digest long, places binary"))
    if WINDOWS in size:
        slices_ = max(64, math.ceil(size[WINDOWS] / GROUP))
        marks = marks.union(repeated_places(parts(WINDOWS).mapInArrow(_window_blocks(slices_), BLOCK_TYPE)))
    marks = written(gathered(marks), "marks")
    ids = marks.select("row").distinct()
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept
    if ids.count() > BROADCAST_ROWS:
        return texts.join(marks, ["row", "digest"], "left").select("doc_id", "text", "places").mapInArrow(_cut(kept), out)
    touched = texts.join(F.broadcast(ids), "row", "left_semi").join(marks, ["row", "digest"], "left").select("doc_id", "text", "places")
    rest = texts.join(F.broadcast(ids), "row", "left_anti").select("doc_id", "text", F.lit(None).cast("array<binary>").alias("places"))
    return touched.union(rest).mapInArrow(_cut(kept), out)
