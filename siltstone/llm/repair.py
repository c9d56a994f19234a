"""Repair of conversations: the cheapest edits after which user and assistant take turns.

A message is kept (0), given the role user or assistant (2) or deleted (3), and messages without text may be
inserted anywhere (2); blank messages and duplicates have to go, a truncated one that stays costs 1 more. The
result is nothing, or pairs of user and assistant, after a system message or none. The cost of what is still to
come is a vector over four states (nothing yet, system, user, assistant); less its minimum it takes few values.

Four-Russians tables: a message is one of nine symbols (has to go, or one of four initials, truncated or not).
For every such vector and every block of ``BLOCK`` symbols the vector before the block is computed once, with
what its minimum grew by. A conversation is read from its end, one look-up a block. To trace, each block is
expanded backward into the vectors between its messages, and edits are chosen from the front in the order of
their letters (D, I, K, R) as long as they keep the least cost: so ties give the smallest string.

Spark deals conversations by id and sorts them, first their messages as a few numbers, then their texts. A
worker reads that order as a stream: it holds one byte for each message of the current conversation and its
edits, never its texts, which go into the running hash as they come (a hash over all texts of a conversation
can't be cut into tasks). Whether role and text were seen earlier is found by an aggregation over digests, so
no set of all messages is needed.

``damaged`` makes the faults to repair. Null roles, texts and parts of the key are one blank; a null turn sorts
first and does not count as a turn; rows without conv_id are one conversation. Rows of one turn stand in the
order of their roles, then of a digest of role and text; equal ones are duplicates. A conversation without
messages has zeros and an empty result, an empty table gives an empty one, other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import batch, checked_broadcast, written

#: Messages of a block.
BLOCK = 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: what the result ends with.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The turn that may follow a state, and the role of the message that makes it.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("", "", "user", "assistant")
INITIALS = "uas"
#: Symbols: none (fills up a block), has to go, then two for each initial (as it is, truncated).
NONE, GONE, FIRST, SYMBOLS = 0, 1, 2, 10
BLANK = " \t\n\x0b\x0c\r"
UNSET = 1 << 20


# Tables -----------------------------------------------------------------------------------------


def _kept(state: int, symbol: int) -> int | None:
    """The state after keeping a message."""
    initial = (symbol - FIRST) // 2 if symbol >= FIRST else 3
    if initial == 2:
        return SYSTEM if state == NOTHING else None
    return NEXT[state] if initial < 2 and NEXT[state] == (USER, ASSISTANT)[initial] else None


def _before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Cost of what is to come before a message, from that after it."""
    if symbol == NONE:
        return costs
    out = []
    for state in range(4):
        best = DELETE + costs[state]
        if symbol != GONE:
            more = TRUNCATED * (symbol % 2)
            best = min(best, REROLE + more + costs[NEXT[state]])
            after = _kept(state, symbol)
            if after is not None:
                best = min(best, KEEP + more + costs[after])
        out.append(best)
    return _inserted(out)


def _inserted(costs: list[int]) -> tuple[int, ...]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


END = _inserted([0, UNSET, UNSET, 0])


@lru_cache(maxsize=1)
def tables():
    """All normalised vectors, the table of single symbols and the table of blocks: (vector, growth) each."""
    number = {END: 0}
    vectors, step = [END], []
    for costs in vectors:
        row = []
        for symbol in range(SYMBOLS):
            before = _before(costs, symbol)
            least = min(before)
            before = tuple(c - least for c in before)
            if before not in number:
                number[before] = len(vectors)
                vectors.append(before)
            row.append((number[before], least))
        step.append(row)
    one = np.array(step)  # vector, symbol, (vector before, growth)
    to, grown = one[:, :, 0], one[:, :, 1]
    blocks, growth = np.arange(len(vectors))[:, None], np.zeros((len(vectors), 1), np.int64)
    for _ in range(BLOCK):  # the block's last symbol comes first: codes are numbers to the base SYMBOLS
        growth = (growth[:, None, :] + grown[blocks].transpose(0, 2, 1)).reshape(len(vectors), -1)
        blocks = to[blocks].transpose(0, 2, 1).reshape(len(vectors), -1)
    return vectors, step, blocks, growth


@lru_cache(maxsize=None)
def _edits(state: int, after: int, symbol: int) -> tuple[str, int]:
    """Letters up to the message's own, and the next state: the smallest that keep the least cost."""
    costs = tables()[0][after]
    before = _before(costs, symbol)
    if symbol == NONE:
        return "", state
    letters = ""
    while True:
        more = TRUNCATED * (symbol % 2)
        if before[state] == DELETE + costs[state]:
            return letters + "D", state
        if before[state] == INSERT + before[NEXT[state]]:
            letters, state = letters + "I", NEXT[state]
            continue
        kept = _kept(state, symbol)
        if kept is not None and before[state] == KEEP + more + costs[kept]:
            return letters + "K", kept
        return letters + "R", NEXT[state]


def cheapest_edits(symbols: bytes) -> tuple[int, str]:
    """Least cost, and the letters of the first of the cheapest edits, for the symbols of a conversation."""
    vectors, step, blocks, growth = tables()
    padded = np.frombuffer(symbols.ljust(-(-len(symbols) // BLOCK) * BLOCK, b"\0"), np.uint8).reshape(-1, BLOCK)
    codes = (padded @ SYMBOLS ** np.arange(BLOCK)[::-1]).tolist() if len(padded) else []
    vector, cost, right = 0, 0, []
    for code in reversed(codes):
        right.append(vector)
        cost += int(growth[vector, code])
        vector = int(blocks[vector, code])
    cost += vectors[vector][NOTHING]
    state, out = NOTHING, []
    for block, vector in zip(padded.tolist(), reversed(right)):
        after = [vector]
        for symbol in reversed(block[1:]):
            after.append(step[after[-1]][symbol][0])
        for symbol, vector in zip(block, reversed(after)):
            letters, state = _edits(state, vector, symbol)
            out.append(letters)
    out.append({NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state])
    return cost, "".join(out)


# Spark ------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with planted faults, by a checksum of the message's key."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(key) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.where(fault != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), blank)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _facts(messages: DataFrame) -> DataFrame:
    """Messages as numbers: place, initial, digests of role and text, and the faults of the text alone."""
    end = F.rtrim("text", F.lit(BLANK))
    return messages.select(
        "conv_id", "turn", "role",
        F.xxhash64("role", "text").alias("d1"), F.xxhash64(F.lit(1), "text", "role").alias("d2"),
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        "text",
    )


def _turn_order() -> Column:
    return F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))


#: Rows of a worker's stream: the id of a conversation (kind 0), its messages as numbers (1), its texts (2).
STREAM = "conv_id long, kind int, turn long, role string, d1 long, d2 long, blank boolean, truncated boolean, later boolean, text string"


def _stream(conversations: DataFrame, messages: DataFrame) -> DataFrame:
    facts = _facts(messages)
    same = ["conv_id", "d1", "d2"]
    repeated = facts.groupBy(same).agg(F.min(_turn_order()).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = written(repeated.select(*[F.col(name).alias(f"_{name}") for name in same], "first"), "repeated")
    joined = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in same]
    narrow = facts.drop("text").join(checked_broadcast(repeated), joined, "left").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "d1", "d2", "blank", "truncated",
        F.coalesce(_turn_order() > F.col("first"), F.lit(False)).alias("later"), F.lit(None).cast("string").alias("text"),
    )
    texts = facts.select("conv_id", F.lit(2).alias("kind"), "turn", "role", "d1", "d2", F.lit(None).cast("boolean").alias("blank"), F.lit(None).cast("boolean").alias("truncated"), F.lit(None).cast("boolean").alias("later"), "text")
    ids = conversations.select(F.col("conv_id").cast("long")).distinct().withColumn("kind", F.lit(0))
    return ids.unionByName(narrow.union(texts), allowMissingColumns=True).select(*[part.split()[0] for part in STREAM.split(", ")])


SCHEMA = pa.schema([
    *((name, pa.int64()) for name in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
TYPE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Conversation:
    """What is held of the conversation that a stream is in."""

    def __init__(self, conv_id):
        self.conv_id, self.symbols, self.audit, self.at = conv_id, bytearray(), None, 0
        self.least = self.most = self.turn = self.before = self.initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.state, self.first, self.hash = NOTHING, True, hashlib.sha256()

    def message(self, turn, role, d1, d2, blank, truncated, later) -> None:
        if turn is not None:
            self.turns += turn != self.turn
            self.least, self.most = turn if self.least is None else self.least, turn
        here = (turn, role, d1, d2)
        duplicate = later or here == self.before
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.turn, self.before, self.initial = turn, here, initial
        if blank:
            self.blank += 1
        elif duplicate:
            self.duplicate += 1
        elif truncated:
            self.truncated += 1
        known = INITIALS.find(initial) if initial else -1
        self.symbols.append(GONE if blank or duplicate else FIRST + 2 * (known if known >= 0 else 3) + truncated)

    def decide(self) -> None:
        if self.audit is None:
            self.cost, self.audit = cheapest_edits(bytes(self.symbols))

    def line(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = NEXT[self.state]
            self.line(ROLES[self.state], "")
            self.at += 1

    def text(self, role: str, text: str) -> None:
        self.decide()
        self._insert()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = SYSTEM if role[:1] == "s" else NEXT[self.state]
            self.line(role, text)
        elif letter == "R":
            self.state = NEXT[self.state]
            self.line(ROLES[self.state], text)

    def result(self) -> tuple:
        self.decide()
        self._insert()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit, self.hash.hexdigest())


def _repair(batches):
    current, out = None, []
    for b in batches:
        columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
        for conv_id, kind, turn, role, d1, d2, blank, truncated, later, text in zip(*columns):
            if kind == 0:
                if current is not None:
                    out.append(current.result())
                current = _Conversation(conv_id)
            elif kind == 1:
                current.message(turn, role, d1, d2, blank, truncated, later)
            else:
                current.text(role, text)
        if out:
            yield batch(SCHEMA, *zip(*out))
            out = []
    if current is not None:
        yield batch(SCHEMA, *zip(*[current.result()]))


def repaired(conversations: DataFrame) -> DataFrame:
    """Faults, least cost, edits and digest of the repaired text of every conversation, after ``damaged``."""
    stream = _stream(conversations, damaged(conversations))
    order = ["conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "d1", "d2"]
    return stream.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_repair, TYPE)
