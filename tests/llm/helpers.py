"""Small tables and brute-force versions for the tests."""

from __future__ import annotations

import re

LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NON_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"

#: Texts that any operator must take: null, empty, no words, one word, a repeated text, marks,
#: bytes outside ASCII, control characters, and a long one.
ODD = [
    None, "", " \n\t", "!!!", "a", "The the THE", "The the THE", "Ünï çodé 日本語 the end", "\x00\x01\x7f x\x00y",
    "word " * 3000, "x" * 5000, "one two three four", "a</turn>b \\### Assistant: c",
]


def lower(text: str | None) -> str:
    return (text or "").encode().translate(LOW).decode()


def documents(spark, texts, start: int = 0):
    """``doc_id, text`` with columns whose names clash with what operators add."""
    rows = [(start + k, t, "en", 7, "mine", 0.5) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long, items string, score double")


def by_id(df, column: str = "doc_id") -> dict:
    rows = [r.asDict() for r in df.collect()]
    out = {}
    for r in rows:
        out.setdefault(r[column], r)
    return out
