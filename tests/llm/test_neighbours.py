"""Nearest-neighbour voting on quality."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import neighbours
from footfall.llm.arrays import PIECE_BYTES, flat
from footfall.llm.queries import op12_quality
from footfall.llm.tables import table
from tests.llm.helpers import ODD, documents

LABELS = "doc_id long, quality int"


def counted(texts):
    return neighbours.term_counts(*flat(pa.array(texts, pa.string())))


def made(n, seed):
    draw = random.Random(seed)
    words = ["tree", "house", "walk", "rain", "blue", "song", "river"]
    out = []
    for k in range(n):
        text = " ".join(draw.choice(words) for _ in range(draw.randint(5, 60)))
        out.append((text.replace(" ", "$$ ") if k % 8 == 0 else text.upper() if k % 8 == 1 else text, int(k % 8 > 1)))
    return out


def labelled(spark, rows, start=0):
    return spark.createDataFrame([(start + k, y) for k, (_, y) in enumerate(rows)], LABELS)


def by_hand(model, counts):
    """Votes one text and one neighbour at a time."""
    out = []
    for row in counts:
        term = np.log1p(row) * model.rarity
        latent = (term / max(np.linalg.norm(term), 1e-9)) @ model.to_latent
        near = [round(float(latent @ v / max(np.linalg.norm(latent), 1e-9)), 5) for v in model.vectors]
        least = sorted(near)[-min(neighbours.NEIGHBOURS, len(near))]
        votes = [(max(s, 0) ** neighbours.POWER, y) for s, y in zip(near, model.labels, strict=True) if s >= least]
        total = sum(w for w, _ in votes)
        out.append(sum(w * y for w, y in votes) / total if total else model.share)
    return out


def test_terms_by_hand():
    text = "To be or Ünï be to be"
    data = text.encode()
    counts = counted([text, None, "ab", "a a a a b", "x " * 4])
    want = {}
    for k in range(len(data) - 2):
        code = np.array([data[k] | data[k + 1] << 8 | data[k + 2] << 16], np.uint64)
        slot = int(neighbours.mix(code)[0] >> np.uint64(64 - neighbours.BITS))
        if slot < neighbours.SLOTS - neighbours.SHARES:
            want[slot] = want.get(slot, 0) + 1
    assert {int(s): int(counts[0, s]) for s in np.flatnonzero(counts[0])} == want
    assert not counts[1].any() and not counts[2].any()
    # Two of five words, then two of four, repeat the two before.
    assert list(counts[3, -8:]) == [2, 2, 2, 2, 2, 2, 0, 0] and list(counts[4, -8:]) == [2, 2, 2, 2, 2, 2, 2, 0]


def test_long_texts_are_taken_whole():
    piece = "abc def ghi " * 2000
    long = piece * (1 + 3 * PIECE_BYTES // len(piece))
    whole, one = counted([long]), counted([piece])
    times = len(long) / len(piece)
    assert set(np.flatnonzero(whole[0])) == set(np.flatnonzero(one[0]))
    assert np.allclose(whole[0], one[0] * times, rtol=1e-3)
    assert counted(["x" * (PIECE_BYTES * 2 + 5)]).max() > 2 * PIECE_BYTES - 10


def test_votes_are_exact(spark):
    rows = made(150, 3)
    docs = documents(spark, [t for t, _ in rows])
    model = neighbours.train(docs, labelled(spark, rows))
    held = [t for t, _ in made(60, 4)] + ODD
    assert np.allclose(model.votes(counted(held)), by_hand(model, counted(held)), atol=1e-3)


def test_finds_what_the_labels_say(spark):
    rows, held = made(400, 1), made(200, 2)
    docs = documents(spark, [t for t, _ in rows + held])
    model = neighbours.train(docs, labelled(spark, rows))
    got = {r.doc_id: r.predicted for r in neighbours.score(docs, model, keep=["doc_id"]).collect()}
    right = [got[400 + k] == y for k, (_, y) in enumerate(held)]
    assert np.mean(right) > 0.97


def test_rarity_covers_all_texts(spark):
    texts = [t for t, _ in made(90, 5)] + ODD
    found = neighbours.rarity(documents(spark, texts).repartition(5))
    held = np.count_nonzero(counted(texts[:-1]), axis=0) + np.count_nonzero(counted(texts[-1:]), axis=0)
    assert np.allclose(found, np.log((len(texts) + 1) / (held + 1)))


def test_odd_texts_clashing_columns_and_repeated_rows(spark):
    rows = made(80, 6)
    docs = documents(spark, [t for t, _ in rows] + ODD + ODD)
    model = neighbours.train(docs, labelled(spark, rows))
    out = neighbours.score(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "n_words", "items", "score", "predicted"]
    got = out.collect()
    assert len(got) == 80 + 2 * len(ODD)
    scores = {}
    for r in got:
        scores.setdefault(r.text or "", []).append(r.score)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= neighbours.THRESHOLD)
    assert all(max(s) - min(s) < 1e-6 for s in scores.values())
    assert scores[""][0] == pytest.approx(model.share)


def test_conflicting_and_odd_labels(spark):
    rows = made(60, 7)
    docs = documents(spark, [t for t, _ in rows])
    own = labelled(spark, rows)
    extra = spark.createDataFrame([(0, 1), (0, 0), (2, 7), (None, 1), (999, 0), (3, 1), (3, 1)], LABELS)
    model = neighbours.train(docs, own.unionByName(extra))
    assert len(model.labels) == 59  # id 0 carries both labels
    again = neighbours.train(docs.repartition(7), extra.unionByName(own).repartition(3))
    assert np.allclose(model.vectors, again.vectors, atol=1e-4) and list(model.labels) == list(again.labels)
    assert len(neighbours.train(docs, own, rows=10).labels) == 10


@pytest.mark.parametrize(("labels", "share"), [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)])
def test_one_label_only(spark, labels, share):
    docs = documents(spark, ["a b c", "hello there", "more words here"])
    model = neighbours.train(docs, spark.createDataFrame(labels, LABELS))
    assert {r.score for r in neighbours.score(docs, model).collect()} == {share}
    none = documents(spark, ["x"]).limit(0)
    assert neighbours.score(none, neighbours.train(none, spark.createDataFrame(labels, LABELS))).collect() == []


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    scored = op12_quality(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    held = scored.filter("held_out and quality is not null").collect()
    right = {y: np.mean([r.predicted == y for r in held if r.quality == y]) for y in (0, 1)}
    assert right[0] > 0.97 and right[1] > 0.99
