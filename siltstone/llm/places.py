"""First places: of hashed spans all over the documents, the places that are not the first of their span.

A place is a document (its id as an order number, and a 64-bit digest of its text, by which rows without id
or with one id are told apart), a first unit and a number of units. A map block sends one place per span to the group of its slice of the hash space, and lets the
others go at once, as they are repeated for certain: a span that is everywhere costs one entry a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import U64, batch, number_bytes, pack, runs, signed, unpack

#: Places of a map block, and of a group of the hash space.
BLOCK, GROUP = 250_000, 500_000

BLOCK_SCHEMA = pa.schema([("slice", pa.int32()), ("base", pa.int64()), ("widths", pa.list_(pa.int32())), ("span", pa.binary()), ("doc", pa.binary()), ("digest", pa.binary()), ("first", pa.binary()), ("n", pa.binary()), ("repeated", pa.bool_())])
BLOCK_TYPE = "slice int, base long, widths array<int>, span binary, doc binary, digest binary, first binary, n binary, repeated boolean"
#: Bits of a packed place that hold its number of units.
UNITS = 20


def filled(where: np.ndarray, mine: np.ndarray):
    """Groups that some of these places go to, with them."""
    mine = mine[np.argsort(where[mine], kind="stable")]
    head = np.flatnonzero(runs(where[mine])) if len(mine) else mine
    for a, b in zip(head, np.append(head[1:], len(mine))):
        yield int(where[mine[a]]), mine[a:b]


def place_block(parts: list, groups: int) -> pa.RecordBatch:
    """Rows for the groups from (span hash, document, digest, first, n) arrays."""
    span, doc, digest, first, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((first, digest, doc, span))
    span, doc, digest, first, n = (x[order] for x in (span, doc, digest, first, n))
    keep = runs(span, doc, digest, first)  # a repeated row is one document
    span, doc, digest, first, n = (x[keep] for x in (span, doc, digest, first, n))
    later = ~runs(span)
    where = np.where(later, doc ^ digest, (span >> U64(40)).astype(np.int64)) % groups
    base = int(doc.min())
    widths = [number_bytes(int(doc.max()) - base), number_bytes(first.max()), number_bytes(n.max())]
    out = [[] for _ in BLOCK_SCHEMA]
    for repeated in (False, True):
        mine = np.flatnonzero(later == repeated)
        for g, o in filled(where, mine):
            row = (g, base, widths, b"" if repeated else pack(span[o], 8), pack(doc[o].astype(U64) - U64(base % (1 << 64)), widths[0]), pack(digest[o], 8), pack(first[o], widths[1]), pack(n[o], widths[2]), repeated)
            for c, v in zip(out, row):
                c.append(v)
    return batch(BLOCK_SCHEMA, *out)


def _later(table: pa.Table) -> pa.Table:
    """Places of one slice that are not the first of their span."""
    kept, out = [], []
    for r in table.to_pylist():
        w = r["widths"]
        doc = signed(unpack(r["doc"], w[0]) + U64(r["base"] % (1 << 64)))
        place = doc, unpack(r["digest"], 8).view(np.int64), unpack(r["first"], w[1]).view(np.int64), unpack(r["n"], w[2]).view(np.int64)
        if r["repeated"]:
            out.append(place)
        else:
            kept.append((unpack(r["span"], 8), *place))
    if kept:
        span, doc, digest, first, n = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((first, digest, doc, span))
        span, doc, digest, first, n = (x[order] for x in (span, doc, digest, first, n))
        later = ~runs(span) & runs(span, doc, digest, first)
        out.append((doc[later], digest[later], first[later], n[later]))
    return by_document(*(np.concatenate(x) for x in zip(*out)))


def by_document(doc, digest, first, n) -> pa.Table:
    """Packed places of each document."""
    order = np.lexsort((first, digest, doc))
    doc, digest, first, n = (x[order] for x in (doc, digest, first, n))
    head = np.flatnonzero(runs(doc, digest))
    cuts = np.append(head, len(doc))
    places = [pack((first[a:b] << UNITS) | n[a:b], 8) for a, b in zip(cuts, cuts[1:])]
    return pa.table({"row": pa.array(doc[head]), "digest": pa.array(digest[head]), "places": pa.array(places, pa.binary())})


def repeated_places(blocks: DataFrame) -> DataFrame:
    """(row, digest, places): places that are not the first of their span, from rows of ``place_block``."""
    return blocks.groupBy("slice").applyInArrow(_later, "row long, digest long, places binary")


def gathered(places: DataFrame) -> DataFrame:
    return places.groupBy("row", "digest").agg(F.collect_list("places").alias("places"))


def unpacked(places: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """First units and numbers of units."""
    both = unpack(b"".join(places or ()), 8).view(np.int64)
    return both >> UNITS, both & ((1 << UNITS) - 1)


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text, row, digest: the last two name a document in places; rows without id come last."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), row.alias("row"), F.xxhash64(text).alias("digest"))
