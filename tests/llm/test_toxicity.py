"""Multiple-instance learning of toxicity."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa

from footfall.llm import toxicity
from footfall.llm.arrays import ALNUM, flat, hash_words
from footfall.llm.queries import op10_toxicity
from footfall.llm.tables import table
from tests.llm.helpers import ODD, by_id, documents

SF = "/root/testdata/sf0.1"


def bag(label, text):
    data, at = flat(pa.array([text], pa.string()))
    words = hash_words(data, at, ALNUM, toxicity.STEM)
    return label, np.tile(toxicity.sentences(data, at, words), 2).astype(np.int32), toxicity.slots(words)


def made(n, seed):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        lines = [" ".join(rnd.choice(["tree", "house", "walk", "rain", "blue", "song"]) for _ in range(6)) for _ in range(rnd.randint(1, 12))]
        label = k % 4 == 0
        if label:
            lines[rnd.randrange(len(lines))] += rnd.choice([" grobble", " snarf"])
        out.append((int(label), ". ".join(lines)))
    return out


def test_finds_sentences_from_text_labels(spark):
    model = toxicity.fit([bag(y, t) for y, t in made(400, 1)])
    held = made(200, 2)
    docs = documents(spark, [t for _, t in held])
    got = by_id(toxicity.score(docs, model, located=True))
    for k, (label, text) in enumerate(held):
        assert got[k]["predicted"] == label
        spans = [text.encode()[s.start : s.end].decode() for s in got[k]["offending"]]
        assert len(spans) == label and all("grobble" in s or "snarf" in s for s in spans)


def test_noisy_or():
    model = toxicity.fit([bag(y, t) for y, t in made(200, 1)])
    text = "tree grobble. rain. blue song!\nsnarf"
    data, at = flat(pa.array([text], pa.string()))
    chance, *_ = model.sentence_scores(data, at)
    assert len(chance) == 4
    assert np.isclose(model.scores(data, at)[0], 1 - np.prod(1 - chance))


def test_query(spark):
    got = by_id(op10_toxicity(spark, SF))
    assert len(got) == table(spark, SF, "documents").count()
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    hits = {(y, p): 0 for y in (0, 1) for p in (0, 1)}
    for i, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
        if row["held_out"] and labels.get(i) in (0, 1):
            hits[labels[i], row["predicted"]] += 1
    assert hits[1, 1] / (hits[1, 0] + hits[1, 1]) >= 0.85  # recall on held-out labels
    assert hits[0, 1] / (hits[0, 0] + hits[0, 1]) <= 0.01


def test_odd_texts_and_labels(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([(0, None, 1), (1, 2, 1), (None, 1, 1), (4, 1, 1), (4, 1, 1)], "doc_id long, toxic int, text int")
    model = toxicity.train(docs, labels)
    got = by_id(toxicity.score(docs, model, located=True))
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got.values())
    none = toxicity.train(docs, labels.limit(0))
    assert all(r.score < 1e-6 for r in toxicity.score(docs, none).collect())
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_same_model_for_any_order(spark):
    rows = made(80, 3)
    docs = documents(spark, [t for _, t in rows])
    labels = spark.createDataFrame([(k, y) for k, (y, _) in enumerate(rows)], "doc_id long, toxic int")
    one, two = toxicity.train(docs, labels), toxicity.train(docs.repartition(5), labels.repartition(3))
    assert one.bias == two.bias and np.array_equal(one.weights, two.weights)
