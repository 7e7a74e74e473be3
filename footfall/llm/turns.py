"""Conversation structure repair.

The cheapest edits that give a conversation's roles the form ``(s?(ua)+)?`` (an optional system
turn, then pairs of user and assistant): Keep costs 0, Rerole to user or assistant 3, Delete 4,
Insert of an empty user or assistant turn 3; a truncated turn that stays costs 3 more, blank and
repeated turns must go. Of several cheapest lists of edits the ASCII-least is taken.

The form is an automaton of four states, so what is left to pay from a row on is a vector of four
costs. Less its minimum, only a few dozen vectors exist. As in the Four-Russians method, a table
holds for each vector and each block of ``BLOCK`` turns the vector before the block and what was
subtracted; a conversation is processed from its end by one lookup a block. The edits are then
found from the start: each block is expanded backward from the vector behind it, and every turn
takes the first edit in ASCII order that lies on a cheapest path, so ties cannot go wrong.

Rows of one conversation are ordered by turn (null first), then role and text. Equal rows are
counted before anything is shuffled by order, and the ordered rows are cut by range, so that a
very long conversation is read by several tasks, which keep one byte a turn. Its edits, a byte a
turn too, are one value of the result. The digest of the repaired texts is sequential by its
nature: one task reads them in order, holding one batch.

Null roles and texts count as one space, so a null text is blank and a null role is none of the
three. A null conversation id is a conversation of its own. Other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.tables import cut, shuffle_partitions

RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns in a block of the table.
BLOCK = 4
#: Turns whose symbols are sent on as one row.
SEGMENT = 1 << 20
#: Characters of a text that order rows of one turn and role; beyond them a digest does.
HEAD = 64

# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after a pair.
_ADDED = (2, 2, 3, 2)  # the state after adding the one role that may be added
_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}  # (state, role): state
# Symbols: role 0 to 3 (system, user, assistant, other), the same truncated, must go, nothing.
_GONE, _NONE = 8, 9
_END = (0, 2 * INSERT, INSERT, 0)
_ROLE = {2: "user", 3: "assistant"}  # named by the state that follows


def _options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a turn in ASCII order: initial, cost, state after it."""
    found = [("D", DELETE, state)]
    if symbol != _GONE:
        role, more = symbol % 4, TRUNCATED * (symbol >= 4)
        if (state, role) in _KEPT:
            found.append(("K", more, _KEPT[state, role]))
        found.append(("R", more + RETYPE, _ADDED[state]))
    return found


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs left before a turn, from those behind it."""
    if symbol == _NONE:
        return after
    costs = [min(cost + after[to] for _, cost, to in _options(symbol, q)) for q in range(4)]
    for _ in range(3):
        costs = [min(costs[q], INSERT + costs[_ADDED[q]]) for q in range(4)]
    return tuple(costs)


@cache
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """All vectors that occur, and for vector and block code (a decimal digit a turn, the first
    turn leading) the vector before the block and the cost taken off."""
    vectors, at = [_END], {_END: 0}
    step, off = [], []
    for vector in vectors:  # grows while new ones are found
        row, cost = [], []
        for symbol in range(10):
            costs = _before(symbol, vector)
            least = min(costs)
            reduced = tuple(c - least for c in costs)
            if reduced not in at:
                at[reduced] = len(vectors)
                vectors.append(reduced)
            row.append(at[reduced])
            cost.append(least)
        step.append(row)
        off.append(cost)
    step, off = np.array(step), np.array(off)
    to, taken = np.arange(len(vectors))[:, None], np.zeros((len(vectors), 1), int)
    for _ in range(BLOCK):  # turns from the last to the first
        to, taken = (
            step[to].transpose(0, 2, 1).reshape(len(vectors), -1),
            (taken[:, :, None] + off[to]).transpose(0, 2, 1).reshape(len(vectors), -1),
        )
    return vectors, to, taken


@cache
def _expanded(code: int, behind: int, state: int) -> tuple[str, int]:
    """Edits of a block that starts in ``state``, given the vector behind it; the state after it."""
    symbols = [code // 10**k % 10 for k in reversed(range(BLOCK))]
    costs = [tables()[0][behind]]
    for symbol in reversed(symbols):
        costs.append(_before(symbol, costs[-1]))
    costs.reverse()
    edits = ""
    for k, symbol in enumerate(symbols):
        while symbol != _NONE:
            here, after = costs[k], costs[k + 1]
            options = _options(symbol, state)
            options.insert(1, ("I", INSERT, _ADDED[state]))
            edit, state = next(
                (name, to) for name, cost, to in options
                if cost + (here if name == "I" else after)[to] == here[state]
            )
            edits += edit
            if edit != "I":
                break
    return edits, state


def cheapest(symbols: np.ndarray) -> tuple[int, str]:
    """Cost and edits of a conversation, given its turns' symbols."""
    vectors, to, taken = tables()
    padded = np.full(-(-len(symbols) // BLOCK) * BLOCK, _NONE, np.int64)
    padded[: len(symbols)] = symbols
    codes = padded.reshape(-1, BLOCK) @ 10 ** np.arange(BLOCK - 1, -1, -1)
    behind = np.zeros(len(codes), np.int32)
    vector, cost = 0, 0
    for k in range(len(codes) - 1, -1, -1):
        behind[k] = vector
        cost += int(taken[vector, codes[k]])
        vector = int(to[vector, codes[k]])
    cost += vectors[vector][0]
    parts, state = [], 0
    for code, vector in zip(codes.tolist(), behind.tolist(), strict=True):
        edits, state = _expanded(code, vector, state)
        parts.append(edits)
    while _END[state]:
        parts.append("I")
        state = _ADDED[state]
    return cost, "".join(parts)


def _letter(role):
    return F.substring(role, 1, 1)


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct rows with their number, the digest that tells role and text, and the text's head."""
    rows = conversations.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    said = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n")).select(
        "*", F.unhex(F.sha2(said, 256)).alias("key"), F.substring("text", 1, HEAD).alias("head")
    )


_ORDER = ["turn", "role", "head", "key"]


def _marked(turns: DataFrame) -> DataFrame:
    """Symbol and fault of the first copy of each distinct row; later copies are duplicates,
    or blank if it is."""
    told = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    marks = turns.select(
        "conv", *_ORDER, "n", (F.length(told) == 0).alias("blank"),
        (~F.substring(told, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    said = marks.groupBy("conv", "key").agg(F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("none"))
    m, s = marks.alias("m"), said.alias("s")
    joined = m.join(s, F.col("m.conv").eqNullSafe(F.col("s.conv")) & (F.col("m.key") == F.col("s.key")))
    first = F.when(F.col("s.none"), F.col("m.turn").isNull()).otherwise(F.col("m.turn") == F.col("s.least"))
    letter = _letter("m.role")
    kind = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    fault = F.when(F.col("m.blank"), 0).when(~first, 1).when(F.col("m.open"), 2).otherwise(3)
    return joined.select(
        "m.conv", *[f"m.{c}" for c in _ORDER], "m.n", kind.cast("int").alias("kind"), fault.cast("int").alias("fault")
    )


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "distinct"]
_ENDS = ["first", "last", "low", "high"]
_SEGMENT = "part int, seq int, symbols binary, " + ", ".join(f"{c} long" for c in [*_COUNTS, *_ENDS])
_LEGAL = {(0, 1), (1, 2), (2, 1)}


class _Segment:
    """Symbols and counts of consecutive rows of one conversation."""

    def __init__(self):
        self.symbols = bytearray()
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.ends = dict.fromkeys(_ENDS)

    def add(self, turn, n, kind, fault):
        counts, ends = self.counts, self.ends
        if ends["first"] is None:
            ends["first"] = kind
        else:
            counts["illegal"] += (ends["last"], kind) not in _LEGAL
        counts["illegal"] += n - 1  # no role may follow itself
        ends["last"] = kind
        if fault < 3:
            counts[_COUNTS[fault]] += 1
        counts["blank" if fault == 0 else "duplicate"] += n - 1
        if turn is not None:
            if turn != ends["high"]:
                counts["distinct"] += 1
            if ends["low"] is None:
                ends["low"] = turn
            ends["high"] = turn
        self.symbols.append(_GONE if fault < 2 else kind + 4 * (fault == 2))

    def joined(self, other: dict) -> None:
        """Add the row of a segment that follows."""
        for c in _COUNTS:
            self.counts[c] += other[c]
        ends = self.ends
        if other["first"] is not None:
            if ends["first"] is None:
                ends["first"] = other["first"]
            else:
                self.counts["illegal"] += (ends["last"], other["first"]) not in _LEGAL
            ends["last"] = other["last"]
        if other["low"] is not None:
            self.counts["distinct"] -= other["low"] == ends["high"]
            if ends["low"] is None:
                ends["low"] = other["low"]
            ends["high"] = other["high"]
        self.symbols += other["symbols"]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    done: list[tuple] = []
    now, held = None, None  # conversation, its segment
    conv_type = None

    def close():
        nonlocal held, seq
        if held is not None:
            done.append((now, part, seq, bytes(held.symbols), *held.counts.values(), *held.ends.values()))
            seq += 1
        held = None

    def out():
        names = ["conv", "part", "seq", "symbols", *_COUNTS, *_ENDS]
        types = [conv_type, pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * (len(_COUNTS) + len(_ENDS))]
        batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types, strict=True)], names=names)
        done.clear()
        return batch

    for batch in batches:
        conv_type = batch.schema.field(0).type
        for conv, turn, n, kind, fault in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            if held is None or conv != now or len(held.symbols) >= SEGMENT:
                close()
                now, held = conv, _Segment()
            held.add(turn, n, kind, fault)
            for left in range(n - 1, 0, -SEGMENT):  # the other copies, in pieces of one segment
                held.symbols += bytes([_GONE]) * min(left, SEGMENT)
                if len(held.symbols) >= SEGMENT:
                    close()
                    held = _Segment()
        if len(done) >= 1000:
            yield out()
    close()
    if done:
        yield out()


_NUMBERS = ["gaps", *_COUNTS[:4], "cost"]
_RESULT = ", ".join(f"{c} long" for c in _NUMBERS) + ", audit string"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = []
        for row in batch.column(1):
            whole = _Segment()
            for segment in row.as_py():
                whole.joined(segment)
            cost, audit = cheapest(np.frombuffer(whole.symbols, np.uint8))
            counts, low, high = whole.counts, whole.ends["low"], whole.ends["high"]
            gaps = 0 if low is None else high - low + 1 - counts["distinct"]
            got.append((gaps, *(counts[c] for c in _COUNTS[:4]), cost, audit))
        types = [*[pa.int64()] * 6, pa.large_string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*got), types, strict=True)] if got else [pa.array([], t) for t in types]
        columns[-1] = columns[-1].cast(pa.string())
        yield pa.record_batch([batch.column(0), *columns], names=["conv", *_NUMBERS, "audit"])


def _conv_type(df: DataFrame, *, name: str = "conv") -> T.StructField:
    return T.StructField(name, df.schema["conv"].dataType)


def _audits(turns: DataFrame) -> DataFrame:
    """Counts, cost and edits of each conversation that has rows."""
    marked = cut(_marked(turns), "turn-marks")
    parts = shuffle_partitions(turns.sparkSession)
    ordered = marked.repartitionByRange(parts, "conv", *_ORDER).sortWithinPartitions("conv", *_ORDER)
    conv = _conv_type(turns)
    schema = T.StructType([conv, *T.StructType.fromDDL(_SEGMENT).fields])
    segments = ordered.select("conv", "turn", "n", "kind", "fault").mapInArrow(_segments, schema)
    named = F.struct(*[c for c in schema.fieldNames() if c != "conv"])
    per_conv = segments.groupBy("conv").agg(F.sort_array(F.collect_list(named)).alias("segments"))
    return per_conv.mapInArrow(_solve, T.StructType([conv, *T.StructType.fromDDL(_RESULT).fields]))


_DELETED = re.compile("D*")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``conv, edit, role, text`` of every turn that stays, and ``conv, None, None, None`` behind
    each conversation. A conversation's edits come before its rows."""
    conv, audit, at, state, began = None, "", 0, 0, False

    def added():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _ADDED[state]
            yield conv, "I", _ROLE[state], ""

    def finish():
        yield from added()
        if began:
            yield conv, None, None, None

    for batch in batches:
        for here, edits, role, text, n in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            if edits is not None:
                yield from finish()
                conv, audit, at, state, began = here, edits, 0, 0, True
                continue
            while n:
                yield from added()
                gone = _DELETED.match(audit, at, at + n).end() - at
                at, n = at + gone, n - gone
                if not gone:
                    edit = audit[at]
                    at, n = at + 1, n - 1
                    state = _KEPT[state, "sua".find(role[0])] if edit == "K" else _ADDED[state]
                    yield conv, edit, role if edit == "K" else _ROLE[state], text
    yield from finish()


def _in_order(turns: DataFrame, audits: DataFrame) -> DataFrame:
    rows = turns.withColumn("kind", F.lit(1)).unionByName(
        audits.select("conv", "audit").withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    parts = shuffle_partitions(turns.sparkSession)
    ordered = rows.repartition(parts, "conv").sortWithinPartitions("conv", "kind", *_ORDER)
    return ordered.select("conv", "audit", "role", "text", "n")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    convs, digests, conv_type = [], [], None

    def typed():
        nonlocal conv_type
        for batch in batches:
            conv_type = batch.schema.field(0).type
            yield batch

    def out():
        found = pa.record_batch([pa.array(convs, conv_type), pa.array(digests, pa.string())], names=["conv", "digest"])
        convs.clear()
        digests.clear()
        return found

    state, first = hashlib.sha256(), True
    for conv, edit, role, text in _walk(typed()):
        if edit is None:
            convs.append(conv)
            digests.append(state.hexdigest())
            state, first = hashlib.sha256(), True
            if len(convs) >= 1000:
                yield out()
        else:
            state.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
    if convs:
        yield out()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_type = None

    def typed():
        nonlocal conv_type
        for batch in batches:
            conv_type = batch.schema.field(0).type
            yield batch

    held, size, position = [], 0, 0

    def out():
        types = [conv_type, pa.int64(), pa.string(), pa.string(), pa.string()]
        names = ["conv", "position", "edit", "role", "text"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)], names=names)

    for conv, edit, role, text in _walk(typed()):
        if edit is None:
            position = 0
            continue
        held.append((conv, position, edit, role, text))
        position, size = position + 1, size + len(text) + 64
        if size >= 1 << 22:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def repaired_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations: ``conv``, ``position`` from 0, ``edit`` (K, R or I), ``role``, ``text``."""
    turns = cut(_turns(conversations, conv, turn, role, text), "turns")
    schema = T.StructType([
        _conv_type(turns), T.StructField("position", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")],
    ])
    return _in_order(turns, _audits(turns)).mapInArrow(_repaired, schema).withColumnRenamed("conv", conv)


def repair(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per conversation: ``gaps`` in its turn numbers, rows whose first fault is ``blank``,
    ``duplicate`` or ``truncated``, ``illegal`` neighbours, ``cost`` and ``audit`` (initials of
    the edits in order), and ``repaired_sha256`` of the repaired ``role:text`` lines."""
    turns = cut(_turns(conversations, conv, turn, role, text), "turns")
    audits = cut(_audits(turns), "turn-audits")
    schema = T.StructType([_conv_type(turns), T.StructField("digest", T.StringType())])
    digests = _in_order(turns, audits).mapInArrow(_digests, schema).alias("d")
    a = audits.alias("a")
    return a.join(digests, F.col("a.conv").eqNullSafe(F.col("d.conv"))).select(
        F.col("a.conv").alias(conv), *[f"a.{c}" for c in [*_NUMBERS, "audit"]],
        F.col("d.digest").alias("repaired_sha256"),
    )
