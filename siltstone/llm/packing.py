"""Hierarchical multi-length packing of token sequences.

Every task tokenises the documents of its input partition and packs them, so no text is shuffled. A
document (its ids, then the end id) first gives whole windows of the longest tier. The rest goes to the
shortest tier that holds it. Rests of the longest tier open a long window each; its gap is filled with whole
rests of shorter tiers, longest first, and at last with the front of one, whose back is routed anew.
Then each shorter tier is filled in order to windows of exactly its own size, cutting at the edges. So
windows have no padding but for one at the end of a partition: what is left there goes to tiers by size, and
the last window is shorter. Closed windows of a tier are dealt to step groups of ``STEP_TOKENS`` tokens
in a snake by their number of pieces, so that steps have as many tokens and about as many documents.

A task keeps the rests that wait for a window, less than a window for each short tier. Sequence ids are the
partition's number and a count, so a task that runs again gives the same ids.

Words are looked up in a cache of at most ``CACHE_WORDS`` entries per worker: the tokenizer never joins
across a space or line break, so the ids of a text are those of its space-separated pieces in turn, nor between a letter or digit and a mark. Texts that
may hold special tokens are encoded whole.

Defined cases: a null or empty text has the end id only. Repeated rows are packed each. Ids may be null.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import U64, mix, runs, small_batches

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16_384
END = 1
CACHE_WORDS = 2_000_000
#: Bytes of text that are tokenised and packed together.
PART_BYTES = 4 << 20

#: Capital ASCII letters as small ones, line breaks and tabs as spaces.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\r", b"abcdefghijklmnopqrstuvwxyz   ")
ALNUM = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789"))
MARK = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))


def parted(raw: np.ndarray) -> np.ndarray:
    """Where a word or a run of marks ends in folded bytes, so that the tokenizer starts anew whatever follows.

    It does so between an ASCII letter or digit (or a Latin-1 letter) and a mark. Apostrophes are no marks here.
    """
    word, mark = ALNUM[raw], MARK[raw]
    latin = np.zeros(len(raw), bool)
    latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    cut = np.zeros(len(raw), bool)
    cut[1:] = ((word | latin)[:-1] & mark[1:]) | (mark[:-1] & word[1:])
    return cut


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Token ids of texts by a cache of words, kept as a hash table of flat arrays.

    A word of at most eight bytes is its own key, a longer one has a 64-bit hash; lengths are compared too.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self):
        self.ids, self.begin = array("I"), array("q", [0, 0])  # word 0 is the empty one
        self.keys, self.sizes, self.numbers = np.zeros(1 << 12, U64), np.zeros(1 << 12, np.int32), np.full(1 << 12, -1, np.int32)
        self.put(np.zeros(1, U64), np.zeros(1, np.int32), np.zeros(1, np.int32))

    def find(self, key: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for new ones."""
        out = np.full(len(key), -1, np.int32)
        top = len(self.keys) - 1
        open_, slot = np.arange(len(key)), (mix(key) & U64(top)).astype(np.int64)
        while len(open_):
            number = self.numbers[slot]
            same = (self.keys[slot] == key[open_]) & (self.sizes[slot] == size[open_])
            hit = same & (number >= 0)
            out[open_[hit]] = number[hit]
            further = (number >= 0) & ~same
            open_, slot = open_[further], (slot[further] + 1) & top
        return out

    def put(self, key: np.ndarray, size: np.ndarray, number: np.ndarray) -> None:
        """Take in distinct words that are not there."""
        top = len(self.keys) - 1
        slot = (mix(key) & U64(top)).astype(np.int64)
        while len(key):
            free = np.flatnonzero(self.numbers[slot] < 0)
            free = free[np.unique(slot[free], return_index=True)[1]]
            at = slot[free]
            self.keys[at], self.sizes[at], self.numbers[at] = key[free], size[free], number[free]
            left = np.ones(len(key), bool)
            left[free] = False
            key, size, number, slot = key[left], size[left], number[left], (slot[left] + 1) & top

    def learn(self, key: np.ndarray, size: np.ndarray, words: list[bytes]) -> None:
        first = len(self.begin) - 1
        for found in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False):
            self.ids.extend(found.ids)
            self.begin.append(len(self.ids))
        if 2 * len(self.begin) > len(self.keys):
            kept = np.flatnonzero(self.numbers >= 0)
            old = self.keys[kept], self.sizes[kept], self.numbers[kept]
            slots = 1 << (4 * len(self.begin)).bit_length()
            self.keys, self.sizes, self.numbers = np.zeros(slots, U64), np.zeros(slots, np.int32), np.full(slots, -1, np.int32)
            self.put(*old)
        self.put(key, size, np.arange(first, first + len(words), dtype=np.int32))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, and the end id."""
        if len(self.begin) > CACHE_WORDS:
            self.forget()
        raws, whole = [t.encode() for t in texts], {}
        for i, raw in enumerate(raws):
            if b"<|" in raw:
                whole[i], raws[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32), b""
        starts = np.cumsum([0, *(len(r) + 1 for r in raws[:-1])])
        joined = b" ".join(raws).translate(FOLD)
        raw = np.frombuffer(joined, np.uint8)
        edge = np.flatnonzero(parted(raw) | (raw == 32))
        begin, stop = np.append(0, edge + (raw[edge] == 32)), np.append(edge, len(raw))
        first = np.searchsorted(edge, starts)
        key, size = word_keys(joined, begin, stop)
        at = self.find(key, size)
        new = np.flatnonzero(at < 0)
        if len(new):
            order = new[np.lexsort((size[new], key[new]))]
            distinct = order[runs(key[order], size[order])]
            self.learn(key[distinct], size[distinct], [joined[x:y] for x, y in zip(begin[distinct].tolist(), stop[distinct].tolist())])
            at[new] = self.find(key[new], size[new])
        known, ids = np.frombuffer(self.begin, np.int64), np.frombuffer(self.ids, np.uint32)
        start, size = known[at], known[at + 1] - known[at]
        done = np.cumsum(size)
        flat = ids[np.repeat(start - done + size, size) + np.arange(done[-1])] if len(at) and done[-1] else np.zeros(0, np.uint32)
        edges = np.concatenate([[0], done])[np.append(first, len(begin))]
        return [np.append(whole.get(i, flat[edges[i]:edges[i + 1]]), np.uint32(END)) for i in range(len(texts))]


def word_keys(raw: bytes, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for the bytes of each word, and its length."""
    padded = raw + bytes(8)
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    size = (stop - begin).astype(np.int32)
    mask = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)
    key = eight[begin] & mask[np.minimum(size, 8)]
    long, done = np.flatnonzero(size > 8), 8
    while len(long):
        more = eight[begin[long] + done] & mask[np.minimum(size[long] - done, 8)]
        key[long] = mix(key[long] * U64(0x9E3779B97F4A7C15) + mix(more + U64(done)))
        done += 8
        long = long[size[long] > done]
    return key, size


ENCODERS: dict[str, Encoder] = {}


def _parts(batches):
    """Ids and texts of about ``PART_BYTES``."""
    ids, texts, size = [], [], 0
    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
            text = text.as_py() or ""
            ids.append(doc)
            texts.append(text)
            size += len(text)
            if size >= PART_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


class Packer:
    """Windows of pieces (document, ids, start in it, all its ids)."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers, self.longest = tiers, tiers[-1]
        self.waiting = {t: deque() for t in tiers}
        self.tokens = dict.fromkeys(tiers, 0)
        self.closed: list[tuple[int, list]] = []

    def route(self, piece, front: bool = False):
        n = len(piece[1])
        if n:
            tier = next(t for t in self.tiers if n <= t)
            (self.waiting[tier].appendleft if front else self.waiting[tier].append)(piece)
            self.tokens[tier] += n

    def take(self, tier: int):
        piece = self.waiting[tier].popleft()
        self.tokens[tier] -= len(piece[1])
        return piece

    def cut(self, piece, n: int):
        doc, ids, start, total = piece
        return (doc, ids[:n], start, total), (doc, ids[n:], start + n, total)

    def add(self, doc, ids):
        whole = len(ids) // self.longest * self.longest
        for start in range(0, whole, self.longest):
            self.closed.append((self.longest, [(doc, ids[start:start + self.longest], start, len(ids))]))
        self.route((doc, ids[whole:], whole, len(ids)))

    def pack(self):
        """Close all windows that can be filled."""
        while self.waiting[self.longest]:
            window = [self.take(self.longest)]
            gap = self.longest - len(window[0][1])
            for tier in reversed(self.tiers[:-1]):
                while gap and self.waiting[tier] and len(self.waiting[tier][0][1]) <= gap:
                    window.append(self.take(tier))
                    gap -= len(window[-1][1])
            if gap:
                tier = next((t for t in self.tiers if self.waiting[t]), None)
                if tier is None:
                    for piece in window:
                        self.route(piece)
                    break
                front, back = self.cut(self.take(tier), gap)
                window.append(front)
                self.route(back)
            self.closed.append((self.longest, window))
        for tier in self.tiers[:-1]:
            while self.tokens[tier] >= tier:
                self.closed.append((tier, self.fill([tier], tier)))

    def fill(self, tiers, size: int) -> list:
        window, gap = [], size
        for tier in tiers:
            while gap and self.waiting[tier]:
                front, back = self.cut(self.take(tier), gap)
                window.append(front)
                gap -= len(front[1])
                if len(back[1]):
                    self.waiting[tier].appendleft(back)
                    self.tokens[tier] += len(back[1])
        return window

    def finish(self):
        """Close windows for all that waits."""
        while left := sum(self.tokens.values()):
            size = max([t for t in self.tiers if t <= left], default=left)
            self.closed.append((size if size in self.tiers else self.longest, self.fill(self.tiers[::-1], size)))

    def steps(self, number: int):
        """(sequence pieces, tier, step group) of the closed windows; step groups count on from ``number``."""
        for tier in self.tiers:
            mine = sorted((w for t, w in self.closed if t == tier), key=len, reverse=True)
            groups = -(-len(mine) * tier // STEP_TOKENS)
            for k, window in enumerate(mine):
                lap, at = divmod(k, groups)
                yield window, tier, number + (groups - 1 - at if lap % 2 else at)
            number += groups
        self.closed = []
        yield None, None, number


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.int64()), ("ids", pa.list_(pa.int32())),
])
TYPE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


def _pack(path: str, with_ids: bool):
    schema = SCHEMA if with_ids else pa.schema(list(SCHEMA)[:-1])

    def run(batches):
        if path not in ENCODERS:
            ENCODERS[path] = Encoder(path)
        encoder, packer = ENCODERS[path], Packer(TIERS)
        first = TaskContext.get().partitionId() << 40
        sequence = step = first

        def out():
            nonlocal sequence, step
            rows = []
            for window, tier, group in packer.steps(step):
                if window is None:
                    step = group
                    continue
                offset = 0
                for doc, ids, start, total in window:
                    row = (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, tier, group)
                    rows.append((*row, ids.astype(np.int32)) if with_ids else row)
                    offset += len(ids)
                sequence += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for docs, texts in _parts(batches):
            for doc, ids in zip(docs, encoder.encode(texts)):
                packer.add(doc, ids)
            packer.pack()
            yield from out()
        packer.finish()
        yield from out()

    return run


def packed(documents: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces of ``documents`` (doc_id, text) in sequences: one row each, with its ids if asked for."""
    texts = small_batches(documents.select(F.col("doc_id").cast("long"), "text"))
    return texts.mapInArrow(_pack(path or tokenizer_path(), with_ids), TYPE + ", ids array<int>" * with_ids)
