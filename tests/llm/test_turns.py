from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import turns
from footfall.llm.queries import damaged, op11_turn_repair
from tests.conftest import in_order

SCHEMA = "conv_id long, turn long, role string, text string"


def every_edit(symbols, added=4):
    """The least (cost, edits) by trying all edits."""
    found = []

    def go(at, roles, cost, audit, inserts):
        if at == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit))
        if inserts < added:
            for role in "ua":
                go(at, roles + role, cost + 3, audit + "I", inserts + 1)
        if at < len(symbols):
            symbol = symbols[at]
            go(at + 1, roles, cost + 4, audit + "D", inserts)
            if symbol != 8:
                more = 3 * (symbol >= 4)
                go(at + 1, roles + "sua?"[symbol % 4], cost + more, audit + "K", inserts)
                for role in "ua":
                    go(at + 1, roles + role, cost + more + 3, audit + "R", inserts)

    go(0, "", 0, "", 0)
    return min(found)


def by_states(symbols):
    """The same by dynamic programming, turn by turn from the start."""
    keep = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
    add = {0: 2, 1: 2, 2: 3, 3: 2}

    def closed(best):
        for _ in range(3):
            for q, (cost, audit) in list(best.items()):
                option = (cost + 3, audit + "I")
                best[add[q]] = min(best.get(add[q], option), option)
        return best

    best = closed({0: (0, "")})
    for symbol in symbols:
        after = {}
        for q, (cost, audit) in best.items():
            options = [(q, (cost + 4, audit + "D"))]
            if symbol != 8:
                more = 3 * (symbol >= 4)
                options.append((add[q], (cost + more + 3, audit + "R")))
                if (q, symbol % 4) in keep:
                    options.append((keep[q, symbol % 4], (cost + more, audit + "K")))
            for to, option in options:
                after[to] = min(after.get(to, option), option)
        best = closed(after)
    return min(best[q] for q in (0, 3) if q in best)


@pytest.mark.parametrize("length", range(3))
def test_cheapest_edits_of_all_short_conversations(length):
    for symbols in itertools.product(range(9), repeat=length):
        assert turns.cheapest(np.array(symbols, np.uint8)) == every_edit(symbols) == by_states(symbols)


def test_cheapest_edits_of_long_conversations():
    draw = random.Random(4)
    for length in [4, 5, 7, 8, 9, 30, 31, 300]:
        for _ in range(30):
            symbols = [draw.randrange(9) for _ in range(length)]
            assert turns.cheapest(np.array(symbols, np.uint8)) == by_states(symbols)


def test_the_table_has_few_vectors():
    vectors, to, taken = turns.tables()
    assert len(vectors) < 100 and to.shape == taken.shape == (len(vectors), 10**turns.BLOCK)


def expected(rows):
    """``rows`` of one conversation: the result of ``repair``, row by row."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
    counts, seen, symbols = [0, 0, 0], set(), []
    for _, role, text in rows:
        told = text.strip(" \t\n\x0b\f\r")
        fault = 0 if not told else 1 if (role, text) in seen else 2 if told[-1] not in ".!?" else 3
        seen.add((role, text))
        if fault < 3:
            counts[fault] += 1
        kind = "sua".find(role[:1]) if role[:1] else 3
        symbols.append(8 if fault < 2 else (kind if kind >= 0 else 3) + 4 * (fault == 2))
    cost, audit = by_states(symbols)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    letters = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
    out, kept, state = [], iter(rows), 0
    for edit in audit:
        row = next(kept) if edit != "I" else (None, None, "")
        if edit == "D":
            continue
        added = "assistant" if state == 2 else "user"
        role = row[1] if edit == "K" else added
        state = {"s": 1, "u": 2, "a": 3}[role[0]]
        out.append((edit, role, row[2]))
    assert next(kept, None) is None
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for _, r, x in out).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest), out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    by_conv = {}
    for conv, *row in rows:
        by_conv.setdefault(conv, []).append(tuple(row))
    want = {conv: expected(own) for conv, own in by_conv.items()}
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in turns.repair(df).collect()}
    assert got == {conv: result for conv, (result, _) in want.items()}
    fixed = in_order(tuple(r) for r in turns.repaired_turns(df).collect())
    assert fixed == in_order(
        (conv, k, *row) for conv, (_, out) in want.items() for k, row in enumerate(out)
    )


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi there."), (1, 2, "assistant", "Hello!"),
    (2, 0, "user", "Twice."), (2, 0, "user", "Twice."), (2, 3, "user", "Twice."), (2, 4, "assistant", "cut off"),
    (3, None, None, None), (3, None, "user", "no number."), (3, 5, "tool", "Result?"), (3, 9, "", "nameless."),
    (None, 1, "assistant", "first"), (None, 1, "user", "tie."), (None, 1, "assistant", "tie."),
    (4, 2, "user", ""), (4, 3, "assistant", " \t\n"), (4, 4, "user", " "),
    (5, 1, "user", "x" * 50 + "a."), (5, 1, "user", "x" * 50 + "b."), (5, 2, "assistant", "end. \n"),
    (6, 1, "user:", "a:b\nc."), (6, 2, "assistant", "q" * 300_000 + "."),
]


def test_against_row_by_row(spark):
    check(spark, ROWS)


def test_random_conversations_in_short_segments(spark, monkeypatch):
    monkeypatch.setattr(turns, "SEGMENT", 3)
    draw = random.Random(8)
    rows = []
    for conv in range(25):
        for _ in range(draw.randrange(1, 40)):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", None])
            text = draw.choice(["Yes.", "No!", "well", "", None, "a?", "b.", "c.", "d."])
            rows += [(conv, draw.choice([None, *range(30)]), role, text)] * draw.choice([1, 1, 1, 2, 9])
    check(spark, rows)


def test_one_conversation_with_most_rows_is_cut(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"turn {k}.") for k in range(3000)] + [(2, 0, "user", "a.")] * 500
    check(spark, rows)
    marked = turns._marked(turns._turns(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text"))
    ordered = marked.repartitionByRange(4, "conv", *turns._ORDER)
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def test_empty_tables_and_other_columns(spark):
    assert turns.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(7, 1, "user", "a.", "x", 3)], "c long, t int, r string, x string, conv string, n int")
    (row,) = turns.repair(df, "c", "t", "r", "x").collect()
    assert (row.c, row.cost, row.audit) == (7, 3, "KI")


def test_the_query_keeps_conversations_whose_rows_are_dropped(spark, tmp_path):
    rows = [(k, 0, "user", "Hi.") for k in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    left = {r.conv_id for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect()}
    out = {r.conv_id: r for r in op11_turn_repair(spark, str(tmp_path)).collect()}
    assert set(out) == set(range(60)) and len(left) < 60
    for conv in set(out) - left:
        row = out[conv]
        assert (row.cost, row.audit, row.gaps, row.repaired_sha256) == (0, "", 0, hashlib.sha256(b"").hexdigest())
