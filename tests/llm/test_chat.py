"""Chat formatting."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from footfall.llm import chat
from footfall.llm.queries import chat_records, op3_chat
from footfall.llm.tables import table
from tests.llm.helpers import SF, by_id

SAID = "\\### Assistant: </turn> ok"


def escaped(text: str) -> str:
    return text.replace("\\", "\\b").replace("<", "\\l").replace("#", "\\h")


def expected(turns) -> dict:
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return {
        "n_turns": len(turns),
        "turns_sha256": hashlib.sha256(whole.encode()).hexdigest(),
        "loss_chars": len(loss),
        "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
        "formatted_chars": sum(len(f"### {escaped(r)}: {escaped(t)}</turn>\n") for r, t in turns),
    }


def test_query_against_brute_force(spark):
    held = {-7: [(0, "user", SAID), (1, "assistant", SAID)]}
    for r in table(spark, SF, "conversations").collect():
        held.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    got = by_id(op3_chat(spark, SF), "conv_id")
    assert sorted(got) == sorted(held)
    for i, rows in held.items():
        want = expected([r[1:] for r in sorted(rows)])
        assert {k: got[i][k] for k in want} == want
        assert got[i]["layout"] in chat.MAPPINGS
    assert len({r["layout"] for r in got.values()}) >= 3


def test_odd_turns(spark):
    texts = [None, "", "\\", "\\b\\l", "###", "</turn>\n### user: x", ": ", "\n", "é日本\x00", "long " * 5000]
    rows = [(1, k, "assistant" if k % 2 else "user", t, "x") for k, t in enumerate(texts)]
    rows += [(2, 0, None, "a", "x"), (2, None, "tool: <x>", None, "x"), (3, 1, "user", "tie", "x"), (3, 1, "user", "tie", "x"), (None, 0, "user", "n", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    out = chat.format_records(chat_records(df))
    back = out.select("conv_id", "turns", chat.read_back(F.col("formatted")).alias("back"), "loss_spans", "formatted")
    got = by_id(back, "conv_id")
    assert len(got) == 4
    for row in got.values():
        assert row["back"] == row["turns"]
        cut = [row["formatted"][s.start : s.start + s.length] for s in row["loss_spans"]]
        assert cut == [escaped(t.text) for t in row["turns"] if t.role == "assistant"]
    assert [t.text for t in got[1]["turns"]] == [t or "" for t in texts]
    assert [t.role for t in got[2]["turns"]] == ["tool: <x>", ""]
    assert len(got[3]["turns"]) == 2


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"value": None, "from": "gpt"}]},
        {"completion": "b", "prompt": "a"},
        {"instruction": "i", "input": "", "output": "o"},
        {"question": "a", "answer": "b"},
    ]
    rows = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(5, None), (6, "no json"), (7, '{"messages": []}')]
    got = by_id(chat.format_records(spark.createDataFrame(rows, "id long, record string")), "id")
    turns = {k: r["turns"] and [tuple(t) for t in r["turns"]] for k, r in got.items()}
    assert turns[0] == [("user", "a")]
    assert turns[1] == [("user", "a"), ("assistant", "")]
    assert turns[2] == [("user", "a"), ("assistant", "b")]
    assert turns[3] == [("system", "i"), ("assistant", "o")]
    assert turns[4] is None and got[4]["layout_hash"] and got[5]["layout_hash"] is None and turns[6] is None
    assert got[4]["formatted"] is None
    assert chat.format_records(spark.createDataFrame([], "id long, record string")).count() == 0
