"""Near duplicates by word-shingle Jaccard similarity, joined on PartEnum signatures.

Two documents link when 100 * |A and B| >= 75 * |A or B| over their distinct five-word shingles. The
result is exact: no link between different texts is lost, and every candidate is verified.

Signatures. Sizes fall into bands [l, 1.5 l). Band m has a window: its own sizes, and the larger
sizes that can still be similar to them. Two linked sets differ in at most ``k`` shingles, a bound that
the window fixes. The hashed shingle domain is dealt into ``n1`` parts of ``n2`` cells each, and every
subset of ``n2 - k2`` cells of a part gives one signature: the hash of the shingles in them. If a set
has enough filled cells (sum over parts of min(k2 + 1, filled) > k), any linked partner shares one of
its non-empty signatures, so empty ones are left out.

Common shingles. Leaving the same shingles out of both sets never makes them differ more, so
signatures are taken from the sets without common shingles (boilerplate lines), which would otherwise
tie unlike documents together. Every map block of all documents names the shingles it sees in several
documents that are mostly different; any choice is right, it only changes the number of candidates. A
set with too few filled cells (a tiny one, or one that is mostly common) adds its first
``size - ceil(0.75 size) + 1`` shingles, the common ones last and else in hash order: two linked sets
that both do so share one of those.

Joining. Map tasks sort blocks of signatures, link the members of a signature with its smallest
member inside the block, and send only that member on: a hot signature costs one entry per block. One
group per slice of the signature space links those again. So a signature with n members gives
n - 1 candidate pairs, a tree. A pair is refuted without its texts if bit sketches of the two sets (the
parity of the shingles in each of 2048 buckets) already differ in more bits than linked sets may in
shingles; the others are verified on their whole texts. Verified pairs are links; their components are found by rounds of
neighbourhood minima. Only where a tree pair failed and its ends are still in different components
can a link be hidden: the documents around such pairs get their signatures again, one entry per signature
and block tells which signatures have several components, and all pairs of
different components in one signature are compared by sketches in tiles of bounded size, and verified.
Documents of one component need no further pairs.

Defined cases: an id names one text (repeated rows aside; of several texts the smallest is verified). A null or empty text,
or one without words, has no shingles and links with nothing. A row without id takes part like any other. Repeated rows get the same result each. The component is the
smallest id that is not null among its documents, or null where none has one.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import (
    BROADCAST_ROWS, U64, batch, checked_broadcast, flat, group_sums, mix, pack, runs, shingle_sets, signed, slices, small_batches, unpack, written,
)
from siltstone.operators.counts import candidates

SHINGLE = 5
#: Two sets link when LEAST_PER_100 * union <= 100 * intersection.
LEAST_PER_100 = 75
#: Cells of a part, and cells of a part that may differ.
CELLS, MISSES = 3, 1
#: A shingle is common if a block has it in so many documents, of whose shingles at most this share is.
COMMON_IN, COMMON_SHARE = 3, 0.3
#: Common shingles kept, the most frequent first: 8 MB for every task.
COMMON_MOST = 1_000_000
#: Signatures of a map block, and of a group of the signature space. A block and what sorts it are in memory.
BLOCK, GROUP = 400_000, 500_000
#: Bytes of a signature inside its slice. Two that fall together only add a candidate.
SIG_BYTES = 4
#: Bits of a sketch.
SKETCH_BITS = 2048
#: Tasks that a key's rows are dealt to where they join a side too large to be shipped.
SALTS = 16
#: Documents of a tile in which pairs of different components are compared.
TILE = 2048


def windows() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First size, largest size, difference bound and number of parts of every window."""
    first = [1]
    while first[-1] < 1 << 40:
        first.append(max(first[-1] + 1, math.ceil(first[-1] * 1.5)))
    home = [b - 1 for b in first[1:]]
    largest = [100 * s // LEAST_PER_100 for s in home]
    bound = [(100 - LEAST_PER_100) * (s + t) // (100 + LEAST_PER_100) for s, t in zip(home, largest)]
    parts = [math.ceil(1.16 * (k + 1) / (MISSES + 1)) + 2 if k else 1 for k in bound]
    return tuple(np.array(x, np.int64) for x in (first[:-1], largest, bound, parts))


FIRST, LARGEST, BOUND, PARTS = windows()


def signatures(hashes: np.ndarray, rows: np.ndarray, n_rows: int, common: np.ndarray, seed: int = 1):
    """Signatures of sets in order of (row, hash), and their rows. ``common``: sorted hashes."""
    size = np.bincount(rows, minlength=n_rows)
    rare = np.ones(len(hashes), bool)
    if len(common):
        rare = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] != hashes
    sig, at, weak = _cell_signatures(hashes[rare], rows[rare], size, seed)
    if len(weak):
        own = np.flatnonzero(np.isin(rows, weak))
        own = own[np.lexsort((~rare[own], rows[own]))]
        row = rows[own]
        place = np.arange(len(own)) - np.searchsorted(row, row)
        prefix = own[place <= size[row] - -(-LEAST_PER_100 * size[row] // 100)]
        sig.append(mix(hashes[prefix] + U64(77 + seed)))
        at.append(rows[prefix])
    if not sig:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(sig), np.concatenate(at)


def _cell_signatures(hashes: np.ndarray, rows: np.ndarray, size: np.ndarray, seed: int):
    """Signatures and rows of sets whose whole sizes are ``size``, and the rows with too few filled cells."""
    n_rows = len(size)
    home = np.searchsorted(FIRST, size, "right") - 1
    place, value = mix(hashes + U64(seed * 0x51ED270B + 1)), mix(hashes ^ U64(0xA5A5A5A55A5A5A5A))
    out, out_rows, weak = [], [], np.zeros(n_rows, bool)
    for back in (0, 1):
        window = home - back
        use = (size > 0) & (window >= 0)
        use[use] = size[use] <= LARGEST[window[use]]
        cells = np.where(use, PARTS[window] * CELLS, 0)
        base = np.concatenate([[0], np.cumsum(cells)])
        if base[-1] == 0:
            continue
        mine = use[rows]
        r = rows[mine]
        cell = base[r] + (place[mine] % cells[r].astype(U64)).astype(np.int64)
        filled = np.bincount(cell, minlength=base[-1]).reshape(-1, CELLS) > 0
        sums = group_sums(value[mine], cell, base[-1]).reshape(-1, CELLS)
        part_row = np.repeat(np.arange(n_rows), cells // CELLS)
        part_no = np.arange(len(part_row)) - base[part_row] // CELLS
        tag = mix((window[part_row] * (1 << 32) + part_no).astype(U64) + U64(seed << 60))
        for chosen in itertools.combinations(range(CELLS), CELLS - MISSES):
            chosen = list(chosen)
            there = filled[:, chosen].any(axis=1)
            name = U64(sum(1 << c for c in chosen))
            out.append(mix(sums[there][:, chosen].sum(axis=1, dtype=U64) + mix(tag[there] + name)))
            out_rows.append(part_row[there])
        sure = np.bincount(part_row, np.minimum(filled.sum(axis=1), MISSES + 1), n_rows)
        weak |= use & (sure <= BOUND[window])
    return out, out_rows, np.flatnonzero(weak)


def set_classes(hashes: np.ndarray, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each row's set."""
    return mix(group_sums(mix(hashes + U64(5)), rows, len(size)) + size.astype(U64))


def nodes(ids: pa.Array, classes: np.ndarray) -> np.ndarray:
    """Node numbers: the id, or for a row without one a number far below, made of its class."""
    lost = np.iinfo(np.int64).min + (classes >> U64(2)).astype(np.int64)
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), lost, ids.fill_null(0).to_numpy())


def _sets(batches: Iterator[pa.RecordBatch]):
    """Ids, node numbers, classes, sizes, shingles and their rows, slice by slice."""
    for b in batches:
        data, offsets = flat(b.column(1))
        for start, stop in slices(offsets):
            part = offsets[start:stop + 1]
            hashes, rows = shingle_sets(data[part[0]:part[-1]], part - part[0], SHINGLE)
            size = np.bincount(rows, minlength=stop - start)
            classes = set_classes(hashes, rows, size)
            ids = b.column(0).slice(start, stop - start).cast(pa.int64())
            yield ids, nodes(ids, classes), classes, size, hashes, rows


DESCRIBED = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("class", pa.int64()), ("n_shingles", pa.int64()), ("sketch", pa.binary()), ("gram", pa.int64()), ("seen", pa.int64())])


def _common(sets: list) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles of a block and in how many of its mostly different documents they are."""
    one = {c: (i, j) for i, (classes, _, _) in enumerate(sets) for j, c in enumerate(classes.tolist())}
    hashes, rows, n = [], [], 0
    for i, (classes, h, r) in enumerate(sets):
        first = np.array([one[c] == (i, j) for j, c in enumerate(classes.tolist())], bool)
        hashes.append(h[first[r]])
        rows.append(r[first[r]] + n)
        n += len(classes)
    hashes, rows = np.concatenate(hashes), np.concatenate(rows)
    for _ in range(2):
        order = np.argsort(hashes)
        h, r = hashes[order], rows[order]
        run = np.cumsum(runs(h)) - 1
        seen = np.bincount(run) if len(run) else np.zeros(0, np.int64)
        often = seen[run] >= COMMON_IN
        share = np.bincount(r[often], minlength=n) / np.maximum(np.bincount(r, minlength=n), 1)
        hashes, rows = h[share[r] <= COMMON_SHARE], r[share[r] <= COMMON_SHARE]
    head = runs(h) & often
    return h[head], seen[run[head]]


def _describe(batches):
    sets, n = [], 0
    for ids, node, classes, size, hashes, rows in _sets(batches):
        lost = np.full(len(size), None)
        yield batch(DESCRIBED, ids, node, signed(classes), size, _sketches(hashes, rows, len(size)), lost, lost)
        sets.append((classes, hashes, rows))
        n += len(hashes)
        if n >= BLOCK:
            yield _gram_rows(*_common(sets))
            sets, n = [], 0
    if n:
        yield _gram_rows(*_common(sets))


def _gram_rows(grams: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    lost = np.full(len(grams), None)
    return batch(DESCRIBED, lost, lost, lost, lost, lost, signed(grams), seen)


def _sketches(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> list[bytes]:
    bucket = rows * SKETCH_BITS + (mix(hashes + U64(7)) % U64(SKETCH_BITS)).astype(np.int64)
    odd = (np.bincount(bucket, minlength=n_rows * SKETCH_BITS) & 1).astype(np.uint8)
    packed = np.packbits(odd).reshape(n_rows, -1)
    return [x.tobytes() for x in packed]


def _refute(batches):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for b in batches:
        n = [b.column(c).to_numpy() for c in (2, 4)]
        bits = [np.frombuffer(b"".join(b.column(c).to_pylist()), U64).reshape(b.num_rows, -1) for c in (3, 5)]
        apart = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1, dtype=np.int64)
        able = 100 * np.minimum(*n) >= LEAST_PER_100 * np.maximum(*n)
        able &= (100 + LEAST_PER_100) * apart <= (100 - LEAST_PER_100) * (n[0] + n[1])
        yield batch(schema, b.column(0).to_numpy()[able], b.column(1).to_numpy()[able])


def possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The (a, b) pairs that their sizes and sketches don't refute. ``sketches``: node, n_shingles, sketch."""
    side = lambda x: sketches.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b").mapInArrow(_refute, "a long, b long")


def _tree(sig: np.ndarray, node: np.ndarray):
    """One (signature, smallest node) each, and distinct (smallest node, other node) pairs."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    head = runs(sig)
    least = node[np.flatnonzero(head)][np.cumsum(head) - 1] if len(sig) else node
    other = node != least
    a, b = least[other], node[other]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = runs(a) | runs(b)
    return sig[head], node[head], a[new], b[new]


def _blocks(groups: int, common):
    """Map side: sorted blocks of signatures by slice of the signature space, and the pairs found in a block."""
    schema = pa.schema([("slice", pa.int32()), ("base", pa.int64()), ("width", pa.int32()), ("sig", pa.binary()), ("node", pa.binary()), ("a", pa.binary()), ("b", pa.binary())])

    def block(sigs, node):
        sig, node, a, b = _tree(np.concatenate(sigs), np.concatenate(node))
        base = int(min(node.min(), a.min() if len(a) else node.min()))
        top = int(max(node.max(), b.max() if len(b) else node.max()))
        width = max(1, ((top - base).bit_length() + 7) // 8)
        delta = lambda x: (x.astype(U64) - U64(base % (1 << 64)))
        where = ((sig >> U64(8 * SIG_BYTES)) % U64(groups)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        cuts = np.searchsorted(where[order], np.arange(groups + 1))
        pair_where = a % groups
        pair_order = np.argsort(pair_where, kind="stable")
        pair_cuts = np.searchsorted(pair_where[pair_order], np.arange(groups + 1))
        columns = [[], [], [], [], [], [], []]
        for g in range(groups):
            o, p = order[cuts[g]:cuts[g + 1]], pair_order[pair_cuts[g]:pair_cuts[g + 1]]
            if len(o) or len(p):
                row = (g, base, width, pack(sig[o], SIG_BYTES), pack(delta(node[o]), width), pack(delta(a[p]), width), pack(delta(b[p]), width))
                for c, v in zip(columns, row):
                    c.append(v)
        return batch(schema, *columns)

    def run(batches):
        sigs, node, n = [], [], 0
        for _, ids, _, size, hashes, rows in _sets(batches):
            s, r = signatures(hashes, rows, len(size), common.value)
            sigs.append(s)
            node.append(ids[r])
            n += len(s)
            if n >= BLOCK:
                yield block(sigs, node)
                sigs, node, n = [], [], 0
        if n:
            yield block(sigs, node)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Reduce side: candidate pairs of one slice of the signature space."""
    sig, node, a, b = [], [], [], []
    for r in table.to_pylist():
        base = U64(r["base"] % (1 << 64))
        back = lambda name: signed(unpack(r[name], r["width"]) + base)  # noqa: B023, E731
        sig.append(unpack(r["sig"], SIG_BYTES))
        node.append(back("node"))
        a.append(back("a"))
        b.append(back("b"))
    _, _, x, y = _tree(np.concatenate(sig), np.concatenate(node))
    a, b = np.concatenate([x, *a]), np.concatenate([y, *b])
    order = np.lexsort((b, a))
    new = runs(a[order]) | runs(b[order])
    return pa.table({"a": a[order][new], "b": b[order][new]})


def candidate_pairs(texts: DataFrame, groups: int, common) -> DataFrame:
    """Distinct (a, b) nodes that a signature's tree joins. ``texts``: id, text."""
    sent = texts.mapInArrow(_blocks(groups, common), "slice int, base long, width int, sig binary, node binary, a binary, b binary")
    return sent.groupBy("slice").applyInArrow(_meet, "a long, b long").distinct()


def _verify(batches):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])
    for b in batches:
        sides = []
        for column in (2, 3):
            data, offsets = flat(b.column(column))
            sides.append((data, offsets))
        linked = np.zeros(b.num_rows, bool)
        for start, stop in slices(sides[0][1] + sides[1][1]):
            sets = []
            for data, offsets in sides:
                part = offsets[start:stop + 1]
                sets.append(shingle_sets(data[part[0]:part[-1]], part - part[0], SHINGLE))
            hashes, rows = np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets])
            total = np.bincount(rows, minlength=stop - start)
            order = np.lexsort((hashes, rows))
            hashes, rows = hashes[order], rows[order]
            both = np.bincount(rows[1:][(hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])], minlength=stop - start)
            linked[start:stop] = (both > 0) & (100 * both >= LEAST_PER_100 * (total - both))
        yield batch(schema, b.column(0), b.column(1), linked)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, linked) of node pairs. ``texts``: node, text of every node in them, one row each."""
    left = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = left.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long, linked boolean")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in (a, b) links: the smallest node reachable.

    Alternates large-star and small-star: each round every node moves its neighbours to its smallest
    neighbour. Rounds grow with the logarithm of the longest path. Each is written to the shared folder.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(least, "u")
        if large:
            out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    before = None
    while True:
        edges = written(star(star(edges, True), False), "edges")
        now = mark(edges)
        if now == before or now[0] == 0:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _texts_of(documents: DataFrame, described: DataFrame, wanted: DataFrame) -> DataFrame:
    """One (node, text) of each wanted node; the wanted ids are broadcast only if they are few."""
    count = wanted.count()
    if described.filter("doc_id is null and n_shingles > 0").isEmpty():
        found = documents.join(checked_broadcast(wanted.withColumnRenamed("node", "doc_id"), count), "doc_id", "left_semi")
        return found.select(F.col("doc_id").alias("node"), "text").groupBy("node").agg(F.min("text").alias("text"))
    tagged = documents.mapInArrow(_tag, "node long, text string")
    return tagged.join(checked_broadcast(wanted, count), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))


def _tag(batches):
    schema = pa.schema([("node", pa.int64()), ("text", pa.string())])
    for b in batches:
        data, offsets = flat(b.column(1))
        for start, stop in slices(offsets):
            part = offsets[start:stop + 1]
            hashes, rows = shingle_sets(data[part[0]:part[-1]], part - part[0], SHINGLE)
            classes = set_classes(hashes, rows, np.bincount(rows, minlength=stop - start))
            yield batch(schema, nodes(b.column(0).slice(start, stop - start).cast(pa.int64()), classes), b.column(1).slice(start, stop - start))


def _labelled(batches, common):
    """(signatures, nodes, components) of rows (node, text, component), slice by slice."""
    for b in batches:
        data, offsets = flat(b.column(1))
        for start, stop in slices(offsets):
            part = offsets[start:stop + 1]
            hashes, rows = shingle_sets(data[part[0]:part[-1]], part - part[0], SHINGLE)
            sig, r = signatures(hashes, rows, stop - start, common.value)
            yield sig, *(b.column(c).slice(start, stop - start).to_numpy()[r] for c in (0, 2))


def _reduced(sig, lead, least, most, n):
    """One entry per signature: its smallest node, smallest and largest component and number of members."""
    order = np.argsort(sig, kind="stable")
    sig, lead, least, most, n = (x[order] for x in (sig, lead, least, most, n))
    first = np.flatnonzero(runs(sig))
    if not len(first):
        return sig, lead, least, most, n
    return sig[first], np.minimum.reduceat(lead, first), np.minimum.reduceat(least, first), np.maximum.reduceat(most, first), np.add.reduceat(n, first)


def _entry_blocks(groups: int, common):
    """Map side: the entries of a block by slice of the signature space. A hot signature costs one entry per block."""
    schema = pa.schema([("slice", pa.int32()), ("sig", pa.binary()), ("lead", pa.binary()), ("least", pa.binary()), ("most", pa.binary()), ("n", pa.binary())])
    small = lambda x: zlib.compress(x.tobytes(), 1)

    def block(parts):
        sig, node, component = (np.concatenate(x) for x in zip(*parts))
        sig, lead, least, most, n = _reduced(sig, node, component, component, np.ones(len(sig), np.int64))
        where = ((sig >> U64(8 * SIG_BYTES)) % U64(groups)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        first = np.flatnonzero(runs(where[order])) if len(order) else order
        filled = [order[x:y] for x, y in zip(first, np.append(first[1:], len(order)))]
        # Most entries have one component, and many are their own: differences are mostly zeros.
        columns = [sig, lead, least ^ lead, most ^ least, n]
        return batch(schema, [where[o[0]] for o in filled], *([small(x[o]) for o in filled] for x in columns))

    def run(batches):
        parts, n = [], 0
        for part in _labelled(batches, common):
            parts.append(part)
            n += len(part[0])
            if n >= BLOCK:
                yield block(parts)
                parts, n = [], 0
        if n:
            yield block(parts)

    return run


def _torn(table: pa.Table) -> pa.Table:
    """(sig, lead) of the signatures of one slice that have several components; two members alone were a tree's pair."""
    column = lambda name, kind: np.concatenate([np.frombuffer(zlib.decompress(x.as_py()), kind) for x in table.column(name)])
    sig, lead, least, most, n = column("sig", U64), *(column(name, np.int64) for name in ("lead", "least", "most", "n"))
    least = least ^ lead
    sig, lead, least, most, n = _reduced(sig, lead, least, most ^ least, n)
    torn = (least != most) & (n > 2)
    return pa.table({"sig": signed(sig[torn]), "lead": lead[torn]})


def _member_rows(common):
    schema = pa.schema([("sig", pa.int64()), ("node", pa.int64()), ("component", pa.int64())])

    def run(batches):
        for sig, node, component in _labelled(batches, common):
            yield batch(schema, signed(sig), node, component)

    return run


def spread_join(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Join with a narrow ``side`` of one row per key: shipped if it is counted to be small, else every key has ``SALTS`` tasks."""
    count = side.count()
    if count <= BROADCAST_ROWS:
        return rows.join(checked_broadcast(side, count), key)
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, [key, "salt"]).drop("salt")


def _tiles(batches):
    """Pairs of different components in a tile that sketches don't refute, from rows in order of their tile."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(table: pa.Table):
        node, component, n = (table.column(c).to_numpy() for c in ("node", "component", "n_shingles"))
        outer = table.column("outer").to_numpy()
        bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), U64).reshape(len(node), -1)
        right = np.flatnonzero(~outer)
        for i in np.flatnonzero(outer):
            with_ = right[(component[right] != component[i]) & (100 * np.minimum(n[right], n[i]) >= LEAST_PER_100 * np.maximum(n[right], n[i]))]
            apart = np.bitwise_count(bits[with_] ^ bits[i]).sum(axis=1, dtype=np.int64)
            with_ = with_[(100 + LEAST_PER_100) * apart <= (100 - LEAST_PER_100) * (n[with_] + n[i])]
            if len(with_):
                yield batch(schema, np.minimum(node[with_], node[i]), np.maximum(node[with_], node[i]))

    open_ = None
    for b in batches:
        table = pa.Table.from_batches([b])
        keys = [table.column(c).to_numpy() for c in ("lead", "u", "r")]
        head = np.flatnonzero(runs(*keys))
        for x, y in zip(head, np.append(head[1:], len(table))):
            part, key = table.slice(x, y - x), tuple(k[x] for k in keys)
            if open_ is not None and open_[0] == key:
                open_ = key, pa.concat_tables([open_[1], part])
                continue
            if open_ is not None:
                yield from pairs(open_[1])
            open_ = key, part
    if open_ is not None:
        yield from pairs(open_[1])


def hidden_pairs(texts: DataFrame, labels: DataFrame, sketches: DataFrame, common, groups: int) -> DataFrame:
    """Pairs of different components in one signature that sketches don't refute. ``texts``: node, text.

    Entries of signatures tell which have several components; only rows of those go on, and no group holds the
    members of one. Signatures are put together by their smallest node. Under it, the documents outside its largest
    component are dealt to tiles of ``TILE``, all documents likewise, and each tile of the first meets each of the second.
    """
    labelled = texts.join(labels, "node", "left").select("node", "text", F.coalesce("component", "node").alias("component"))
    labelled = small_batches(written(labelled, "labelled"))
    sent = labelled.mapInArrow(_entry_blocks(groups, common), "slice int, sig binary, lead binary, least binary, most binary, n binary")
    torn = written(sent.groupBy("slice").applyInArrow(_torn, "sig long, lead long"), "signatures")
    every = labelled.mapInArrow(_member_rows(common), "sig long, node long, component long")
    member = written(spread_join(every, torn, "sig").select("lead", "node", "component").distinct(), "members")
    sizes = member.groupBy("lead", "component").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("lead").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main"))
    tiles = lambda n: F.ceil(n / TILE).cast("int")
    sizes = sizes.select("lead", F.col("main.component").alias("main"), tiles(F.col("n") - F.col("main.n")).alias("us"), tiles(F.col("n")).alias("rs"))
    side = spread_join(member, written(sizes.filter("us > 0"), "sizes"), "lead")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outer = side.filter("component <> main").withColumn("u", F.pmod(F.hash("node"), "us")).withColumn("r", every("rs")).withColumn("outer", F.lit(True))
    inner = side.withColumn("r", F.pmod(F.hash("node"), "rs")).withColumn("u", every("us")).withColumn("outer", F.lit(False))
    columns = ["lead", "u", "r", "outer", "node", "component"]
    both = outer.select(columns).union(inner.select(columns)).join(sketches, "node")
    both = both.repartition("lead", "u", "r").sortWithinPartitions("lead", "u", "r")
    return both.select(*columns, "n_shingles", "sketch").mapInArrow(_tiles, "a long, b long").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_shingles, component_id."""
    documents = small_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    described = written(documents.mapInArrow(_describe, "doc_id long, node long, class long, n_shingles long, sketch binary, gram long, seen long"), "described")
    grams = described.filter("gram is not null").groupBy("gram").agg(F.sum("seen").alias("seen"))
    # A task sends a million rows to the last one only if they can be among the most frequent.
    grams = candidates(grams, "seen", COMMON_MOST).orderBy(F.desc("seen"), "gram").limit(COMMON_MOST).select("gram").toPandas()["gram"].to_numpy(np.int64)
    common = documents.sparkSession.sparkContext.broadcast(np.sort(grams.view(U64)))
    described = described.filter("gram is null").drop("gram", "seen")
    filled = described.filter("n_shingles > 0")
    classes = written(filled.groupBy("class", "n_shingles").agg(F.min("node").alias("head")), "classes")
    heads = filled.join(classes, ["class", "n_shingles"]).filter("node <> head").select("node", "head").distinct()
    heads = written(heads, "heads")
    total = described.agg(F.sum("n_shingles")).first()[0] or 0

    def by_head(pairs: DataFrame) -> DataFrame:
        out = pairs
        for side in ("a", "b"):
            head = heads.select(F.col("node").alias(side), F.col("head").alias("h"))
            out = out.join(head, side, "left").withColumn(side, F.coalesce("h", side)).drop("h")
        return out.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    groups = max(64, math.ceil(0.75 * total / GROUP))
    pairs = written(by_head(candidate_pairs(documents, groups, common)), "pairs")
    sketches = filled.join(heads.select("node").distinct(), "node", "left_anti").groupBy("node").agg(F.min(F.struct("n_shingles", "sketch")).alias("s")).select("node", "s.*")
    sketches = written(sketches, "sketches")
    ends = lambda p: p.select(F.col("a").alias("node")).union(p.select(F.col("b").alias("node"))).distinct()

    def links_of(pairs: DataFrame) -> DataFrame:
        able = written(possible(pairs, sketches), "possible")
        texts = written(_texts_of(documents, described, ends(able)), "texts")
        return written(verified(able, texts).filter("linked").select("a", "b"), "links")

    links = links_of(pairs)
    labels = components(links)

    def label(df: DataFrame, side: str) -> DataFrame:
        mine = labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_component"))
        return df.join(mine, side, "left").withColumn(f"{side}_component", F.coalesce(f"{side}_component", side))

    torn = label(label(pairs.join(links, ["a", "b"], "left_anti"), "a"), "b").filter("a_component <> b_component").select("a", "b")
    torn = written(torn, "torn")
    if not torn.isEmpty():
        # A signature's tree has depth two, so all its members are within three pairs of a torn one.
        around = ends(torn)
        for _ in range(3):
            touching = [pairs.join(around.withColumnRenamed("node", x), x, "left_semi").select("a", "b") for x in ("a", "b")]
            around = written(ends(touching[0].union(touching[1])), "around")
        near = _texts_of(documents, described, around)
        more = hidden_pairs(near, labels, sketches, common, groups).join(pairs, ["a", "b"], "left_anti")
        more = links_of(more)
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)
    named = classes.withColumnRenamed("head", "node").join(labels, "node", "left")
    named = named.select("class", "n_shingles", F.coalesce("component", "node").alias("component"))
    rows = filled.join(named, ["class", "n_shingles"])
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = rows.join(least, "component").select("doc_id", "n_shingles", "component_id")
    alone = described.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone)
