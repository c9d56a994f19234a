"""Helpers that several operators share: scratch tables, checked joins and numpy text kernels.

The kernels work on Arrow string columns as flat UTF-8 bytes. A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import scratch_path

#: A side of a join is broadcast only when it was counted and has at most so many rows of a few numbers.
BROADCAST_ROWS = 1_000_000
#: Rows that go to Python together.
BATCH_ROWS = 1_000
#: Bytes of text a kernel looks at together; a longer text is looked at alone.
SLICE_BYTES = 1 << 18

U64 = np.uint64


# Tables between steps -------------------------------------------------------------------------


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """Have rows with texts sent to Python ``BATCH_ROWS`` at a time, so that long texts don't fill a worker."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def checked_broadcast(side: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a narrow side for broadcast if it has at most ``BROADCAST_ROWS`` rows, else leave it as it is."""
    rows = side.count() if rows is None else rows
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


# Kernels --------------------------------------------------------------------------------------


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes each, or one row that is longer."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
FOLDED_CODE = BYTE_CODE.copy()
FOLDED_CODE[65:91] = BYTE_CODE[97:123]
_BASE, _POWERS = 0x9E3779B97F4A7C15 | 1, {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2^64, and of its inverse."""
    kept = _POWERS.get("kept")
    if kept is None or len(kept[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, U64(base))
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=U64))
        kept = tuple(both)
        if size <= 16 * SLICE_BYTES:
            _POWERS["kept"] = kept
    return kept[0][:n], kept[1][:n]


def byte_class(spaces: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in spaces]] = True
    return table


#: ASCII white space.
SPACE = byte_class(" \t\n\x0b\x0c\r")
#: All ASCII characters but digits and letters.
PUNCTUATION = byte_class("".join(chr(c) for c in range(128) if not chr(c).isalnum()))


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray, code: np.ndarray = FOLDED_CODE):
    """Hash, row, start and end byte of every word (a run of bytes outside ``breaks``)."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty.astype(U64), empty, empty, empty
    inside = ~breaks[data]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first[n] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(code[data] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))
    rows = np.searchsorted(offsets, starts, "right") - 1
    return hashes, rows, starts, ends


def grams(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and index of the first word of every run of k words within a row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    whole = np.flatnonzero(rows[:n] == rows[k - 1:])
    out = np.zeros(len(whole), U64)
    for j in range(k):
        out = mix(out + hashes[whole + j] + U64(j + 1))
    return out, whole


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row, as hashes and rows in order of (row, hash).

    A row with fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    hashes, rows, _, _ = words(data, offsets, SPACE)
    out, at = grams(hashes, rows, k)
    row = rows[at]
    count = np.bincount(rows, minlength=len(offsets) - 1)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        begin = np.searchsorted(rows, short)
        extra = np.zeros(len(short), U64)
        for j in range(k - 1):
            there = count[short] > j
            extra[there] = mix(extra[there] + hashes[begin[there] + j] + U64(j + 1))
        out, row = np.concatenate([out, mix(extra + U64(k))]), np.concatenate([row, short])
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new], row[new]


def group_sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2^64 of hashes by group number."""
    low = np.bincount(groups, (values & U64(0xFFFFFFFF)).astype(np.float64), n)
    high = np.bincount(groups, (values >> U64(32)).astype(np.float64), n)
    return low.astype(U64) + (high.astype(U64) << U64(32))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, U64).view(np.int64)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def number_bytes(top: int) -> int:
    return max(1, (int(top).bit_length() + 7) // 8)


def pack(x: np.ndarray, width: int) -> bytes:
    """The lowest bytes of non-negative numbers."""
    return np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def runs(*keys: np.ndarray) -> np.ndarray:
    """True where a run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new) > 1:
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new
