"""SpotSigs fingerprints, their comparison and the edited texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from footfall.llm import spotsigs
from footfall.llm.queries import op1_spotsigs
from footfall.llm.tables import in_id_order, table
from tests.llm.helpers import ALNUM, ODD, SF, by_id, documents, lower

ANCHORS = {w for line in spotsigs.ANCHORS.values() for w in line.split()}


def spots(text: str) -> set:
    words = ALNUM.findall(lower(text))
    out = set()
    for k, word in enumerate(words):
        chain = [w for w in words[k + 1 :] if w not in ANCHORS][: spotsigs.CHAIN]
        if word in ANCHORS and len(chain) == spotsigs.CHAIN:
            out.add((word, *chain))
    return out


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(texts: list[str]) -> list[str]:
    out = []
    for k, text in enumerate(texts):
        half = len(text) // 2
        out.append(text[: len(text) - half] + texts[(k + 1) % len(texts)][:half])
    return out


def test_query_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text or "") for r in table(spark, SF, "documents").collect())
    ids, texts = zip(*docs, strict=True)
    new = edited(list(texts))
    got = by_id(op1_spotsigs(spark, SF))
    assert sorted(got) == sorted(ids)
    for k, i in enumerate(ids):
        row = got[i]
        assert row["n_chars"] == len(texts[k])
        assert row["edited_sha256"] == hashlib.sha256(new[k].encode()).hexdigest()
        own, changed, after = spots(texts[k]), spots(new[k]), spots(texts[(k + 1) % len(ids)])
        if own and changed and after:
            assert int(row["fingerprint"].split(":")[0]) == len(own)
            assert row["near_edited"] == pytest.approx(jaccard(own, changed))
            assert row["near_next"] == pytest.approx(jaccard(own, after))


def test_odd_texts(spark):
    docs = documents(spark, ODD)
    got = by_id(spotsigs.edited_fingerprints(docs))
    plain = by_id(spotsigs.fingerprints(docs))
    assert len(got) == len(plain) == len(ODD)
    for k, text in enumerate(ODD):
        assert got[k]["fingerprint"] == plain[k]["fingerprint"]
        assert 0 <= got[k]["near_edited"] <= 1 and 0 <= got[k]["near_next"] <= 1
    assert got[0]["fingerprint"] == got[1]["fingerprint"] == "0:"
    assert got[5]["fingerprint"] == got[6]["fingerprint"] != got[4]["fingerprint"]
    assert got[5]["near_next"] == 1.0 and got[0]["near_next"] == 1.0


def test_ids_that_repeat_or_are_null(spark):
    rows = [(None, "n"), (None, "m"), (5, "b"), (5, "a"), (9, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = in_id_order(docs, "doc_id", "text").filter("not is_copy").collect()
    assert len(order) == 5
    got = spotsigs.edited_fingerprints(docs).collect()
    assert len(got) == 5


def test_order_spans_blocks(spark):
    docs = spark.createDataFrame([(k * 3, f"t{k}") for k in range(500)], "doc_id long, text string")
    placed = in_id_order(docs.repartition(7), "doc_id", "text")
    parts = placed.rdd.mapPartitions(lambda rows: [[(r.block, r.doc_id, r.is_copy) for r in rows]]).collect()
    after = {}
    for part in parts:
        for (block, one, copy), (_, two, _) in zip(part, part[1:], strict=False):
            if not copy:
                after[one] = two
    assert after == {k * 3: (k * 3 + 3) % 1500 for k in range(500)}


def test_empty_table(spark):
    docs = documents(spark, ["x"]).limit(0)
    assert spotsigs.edited_fingerprints(docs).count() == 0
    assert spotsigs.fingerprints(docs).count() == 0


def test_pruned_likeness():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 900, rng.integers(0, 700))).astype(np.uint32)
        b = np.unique(rng.integers(0, 900, rng.integers(0, 700))).astype(np.uint32)
        exact = jaccard(set(a.tolist()), set(b.tolist()))
        assert spotsigs.likeness(a, b) == pytest.approx(exact)
        for floor in (0.2, 0.4, 0.75):
            assert spotsigs.likeness(a, b, floor) == pytest.approx(exact if exact >= floor else 0.0)
        assert np.array_equal(spotsigs.decode(spotsigs.encode(a)), a)


def test_compare(spark):
    prints = by_id(spotsigs.fingerprints(documents(spark, ["the cat sat on the mat by the door", "", None])))
    rows = [(prints[0]["fingerprint"], prints[0]["fingerprint"]), (prints[0]["fingerprint"], prints[1]["fingerprint"]), (None, "0:")]
    pairs = spark.createDataFrame(rows, "x string, y string")
    assert [r.likeness for r in spotsigs.compare(pairs, "x", "y").collect()] == [1.0, 0.0, None]
