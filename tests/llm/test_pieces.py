"""SentencePiece encoding and decoding."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from footfall.llm import pieces
from footfall.llm.queries import model_file, op7_sentencepiece
from footfall.llm.tables import table
from tests.llm.helpers import ODD, SF, by_id, documents


@pytest.fixture(scope="module")
def model():
    return pieces.load(model_file())


def brute(text: str, model) -> float:
    """Highest score of any path of the whole text, without cutting it into words."""
    if not text:
        return 0.0
    marked = pieces.MARK + text.replace(" ", pieces.MARK)
    best = [0.0] + [float("-inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        for begin in range(max(0, end - 20), end):
            score = model.scores.get(marked[begin:end])
            if score is None and end - begin == 1:
                score = model.unknown
            if score is not None:
                best[end] = max(best[end], best[begin] + score)
    return best[-1]


def score(ids, model) -> float:
    """Score of a path; the bytes of a character that no piece covers cost once."""
    total = 0.0
    for i in ids:
        if i in model.bytes_of:
            total += model.unknown if model.bytes_of[i] & 0xC0 != 0x80 else 0.0
        else:
            total += model.scores[model.names[i]]
    return total


def test_best_path_and_round_trip(spark, model):
    texts = [r.text for r in table(spark, SF, "documents").limit(40).collect()]
    rnd = random.Random(2)
    texts += ["".join(rnd.choice("ab  \n\tthe日é①") for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    ids = pieces.encode_texts(texts, model)
    for text, own in zip(texts, ids, strict=True):
        assert score(own.tolist(), model) == pytest.approx(brute(text, model))
    ends = [0]
    for own in ids:
        ends.append(ends[-1] + len(own))
    import numpy as np

    assert model.decode_all(np.concatenate(ids), np.array(ends)) == texts


def test_against_the_library(spark, model):
    """The same scores as the library's n-best search with the vocabulary as a unigram model."""
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    proto = model_pb2.ModelProto()
    proto.ParseFromString(open(model_file(), "rb").read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor()
    library.LoadFromSerializedProto(proto.SerializeToString())
    words = sorted({w for r in table(spark, SF, "documents").limit(20).collect() for w in r.text.split()})[:300]
    same = 0
    for word in words:
        theirs = library.nbest_encode_as_ids(word, 1)[0]
        own = pieces.encode_texts([word], model)[0].tolist()
        assert score(own, model) >= score(theirs, model) - 1e-3
        same += own == theirs
    assert same >= 0.97 * len(words)


def test_query(spark):
    got = op7_sentencepiece(spark, SF).collect()
    assert len(got) == table(spark, SF, "documents").count()
    assert all(r.round_trip for r in got)


def test_odd_texts(spark, model):
    texts = [*ODD, " lead", "trail ", "a  b", "▁", "x▁y"]
    coded = pieces.encode(documents(spark, texts), model_file())
    got = by_id(pieces.decode(coded, model_file()))
    for k, text in enumerate(texts):
        assert got[k]["decoded"] == (text or "").replace("▁", " ")
    assert got[0]["piece_ids"] == [] and got[1]["piece_ids"] == []
    assert pieces.encode(documents(spark, ["x"]).limit(0), model_file()).count() == 0


def test_foreign_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [-5, 10**6, 0, 1, 2]), (4, [3 + 0xE2])], "doc_id long, piece_ids array<int>")
    got = by_id(pieces.decode(df, model_file()))
    assert [got[k]["decoded"] for k in (1, 2, 3, 4)] == ["", "", "", "�"]


def test_ids_and_texts_from_one_worker(spark):
    """The same as encoding and then decoding, in one step of Python; decoding alone builds no trie."""
    texts = [*ODD, " lead", "a  b", "▁", "x▁y", *[f"text {k} of many" for k in range(600)]]
    docs = documents(spark, texts)
    once = pieces.encode(docs, model_file(), back="decoded")
    twice = pieces.decode(pieces.encode(docs, model_file()), model_file())
    assert once.columns == twice.columns and by_id(once) == by_id(twice)
    stage = corpus_pipeline.encode_pieces(spark, table(spark, SF, "documents"), SF)
    assert stage._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1
    fresh = pieces.Pieces(model_file())
    fresh.decode_all(np.array([300, 400]), np.array([0, 2]))
    assert "by_end" not in vars(fresh)


def test_runs_of_texts(spark, model, monkeypatch):
    """The same ids whatever texts share a run, and however the runs are put together."""
    texts = [r.text for r in table(spark, SF, "documents").limit(30).collect()] + [None, "", "a  b", "日 ①"]
    want = [own.tolist() for text in texts for own in pieces.encode_texts([text], model)]
    assert [own.tolist() for own in pieces.encode_texts(texts, model)] == want
    monkeypatch.setattr(pieces, "JOINED_WORDS", 7)
    assert [own.tolist() for own in pieces.encode_texts(texts, model)] == want
    assert pieces.encode_texts([], model) == []


def test_memory_is_linear_in_a_word(model):
    """A long text without spaces, and the same with another end."""
    import tracemalloc

    rnd = random.Random(4)
    long = "".join(rnd.choice("abcdefgh日é①=+/\n") for _ in range(20_000))
    texts = [long + "x", long + "yz"]
    tracemalloc.start()
    ids = pieces.encode_texts(texts, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
    ends = [0, len(ids[0]), len(ids[0]) + len(ids[1])]
    import numpy as np

    assert model.decode_all(np.concatenate(ids), np.array(ends)) == texts
    assert score(ids[0].tolist(), model) == pytest.approx(brute(texts[0], model))


def test_nothing_is_kept_from_run_to_run(model):
    import tracemalloc

    pieces.encode_texts(["warm"], model)
    tracemalloc.start()
    held = []
    for k in range(4):
        pieces.encode_texts([f"{k}" + "ab" * 30_000, " ".join(f"w{k}x{j}" for j in range(20_000))], model)
        held.append(tracemalloc.get_traced_memory()[0])
    tracemalloc.stop()
    assert max(held) < 1 << 20
