"""Removal of repeated strings, and suffix arrays."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from footfall.llm import repeats
from footfall.llm.queries import op9_suffix_dedup
from footfall.llm.suffixes import suffix_array
from footfall.llm.tables import table
from tests.llm.helpers import ODD, SF, by_id, documents


def brute(docs, length):
    seen, out = set(), {}
    for i, text in sorted(docs):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for k in range(len(body) - length + 1):
            string = body[k : k + length]
            if string in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(string)
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(body), len(body) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in by_id(df).items()}


@pytest.mark.parametrize("alphabet", [1, 2, 3, 26])
def test_suffix_array(alphabet):
    rnd = random.Random(alphabet)
    for n in [*range(14)] * 15 + [300, 700]:
        text = [rnd.randrange(alphabet) for _ in range(n)]
        assert suffix_array(text) == sorted(range(n), key=lambda k: text[k:])
    assert suffix_array(b"") == [] and suffix_array("".encode()) == []


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert result(op9_suffix_dedup(spark, SF)) == brute(docs, 100)


@pytest.mark.parametrize("crowd", [1, 4, 1500])
def test_short_strings(spark, crowd):
    rnd = random.Random(9)
    parts = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(3, 40))) for _ in range(12)]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 8))) for _ in range(80)] + ODD
    docs = documents(spark, texts).repartition(3)
    want = brute(list(enumerate(texts)), 20)
    assert result(repeats.remove_repeats(docs, length=20, kmer=6, crowd=crowd)) == want


def test_long_texts_in_stretches(monkeypatch):
    def strings(found):
        anchor, _, place, low, high = found
        return sorted((s, a, p) for a, p, b, e in zip(anchor.tolist(), place.tolist(), low.tolist(), high.tolist(), strict=True) for s in range(b, e + 1))

    data = np.frombuffer(random.Random(5).randbytes(5000), np.uint8)
    at = np.array([0, 0, 30, 1700, 1715, 4990, 5000])
    whole = strings(repeats.segments(data, at, 20, 6))
    assert [s for s, _, _ in whole] == [s for a, b in zip(at, at[1:]) for s in range(a, b - 19)]
    monkeypatch.setattr(repeats, "MOST", 256)
    assert strings(repeats.segments(data, at, 20, 6)) == whole


def test_common_parts():
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        before, after = rnd.randint(0, 12), rnd.randint(0, 12)
        rows.append((rnd.randint(0, 20), before, bytes(rnd.choice(b"\0ab") for _ in range(before + after))))
    rows.sort(key=lambda r: r[0])
    sizes = np.array([len(r[2]) for r in rows])
    body = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
    offset, size = repeats._common(np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), sizes, np.cumsum(sizes) - sizes, body)

    def agree(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for k, (key, before, own) in enumerate(rows):
        others = [r for j, r in enumerate(rows) if j != k and r[0] == key]
        left = max((agree(own[:before][::-1], r[2][: r[1]][::-1]) for r in others), default=0)
        right = max((agree(own[before:], r[2][r[1] :]) for r in others), default=0)
        assert (offset[k], size[k]) == (before - left, left + right)


def test_kept_bytes(spark):
    docs = documents(spark, ["abcdefghij" * 3, "xxabcdefghijyy"])
    got = by_id(repeats.remove_repeats(docs, length=8, kmer=4, with_text=True))
    # The first text repeats itself after ten bytes: strings that start later than place 9 go.
    assert bytes(got[0]["kept"]) == b"abcdefghij"
    assert bytes(got[1]["kept"]) == b"xxyy"


def test_repeated_and_null_ids(spark):
    text = "".join(random.Random(3).choices("abcdefgh", k=60))
    rows = [(1, text), (1, text), (2, text + "!"), (None, text), (None, None)]
    got = [tuple(r) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=20, kmer=6).collect()]
    by = sorted((str(r[0]), r[1], r[2]) for r in got)
    assert by == [("1", 60, 60), ("1", 60, 60), ("2", 61, 60), ("None", 0, 0), ("None", 60, 0)]


def test_empty_table(spark):
    assert repeats.remove_repeats(documents(spark, ["x"]).limit(0)).count() == 0
