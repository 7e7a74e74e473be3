"""Toxicity by multiple-instance learning.

A text is a bag of sentences. A sentence's chance is the logistic function of the sum of the
weights of its words and of their first ``STEM`` bytes; the text's chance is the noisy-or of its sentences: ``1 - prod(1 - p)``. Only
labels of texts are needed to learn the weights, and the sentence scores then tell which
sentences offend.

Words and stems are hashed to ``2 ** BITS`` weights. Null counts as the empty text; a text without
words is one sentence without words. Labels other than 0 and 1 are left out. Several rows of one
text are scored alike. Without labels of both kinds every score is the share of label 1 (0 if
there are none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.arrays import ALNUM, Words, flat, hash_words, mix, pieces
from footfall.llm.tables import trimmed

BITS = 18
STEM = 5
#: Labelled rows that the model is fitted on at most, taken in hash order of id.
TRAIN_ROWS = 5000
#: A word has a weight if its share of toxic training texts is so many standard errors off
#: the overall share; without this the rare words of toxic texts are learnt by heart.
LEAST_Z = 4.0
ROUNDS = 150
THRESHOLD = 0.7
_STEM_SALT = np.uint64(0x9FB21C651E98DF25)
_ENDS = np.isin(np.arange(256), list(b".!?\n"))


def sentences(data: np.ndarray, at: np.ndarray, words: Words) -> np.ndarray:
    """Sentence number of each word; numbers go on through all texts of a batch. Words
    with an end mark or a text's end between them are of different sentences."""
    marks = np.concatenate([[0], np.cumsum(_ENDS[data])])
    if not len(words.start):
        return np.zeros(0, np.int64)
    new = np.zeros(len(words.start), bool)
    new[1:] = (marks[words.start[1:]] != marks[words.start[:-1]]) | (words.text[1:] != words.text[:-1])
    return np.cumsum(new)


def slots(words: Words) -> np.ndarray:
    """Slot of each word, then slot of each word's stem."""
    both = np.concatenate([mix(words.hash), mix(words.stem ^ _STEM_SALT)])
    return (both >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def sentence_scores(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, Words, np.ndarray]:
        """Chance of each sentence, the words and their sentence numbers."""
        words = hash_words(data, at, ALNUM, STEM)
        number = sentences(data, at, words)
        count = int(number[-1]) + 1 if len(number) else 0
        total = np.bincount(np.tile(number, 2), self.weights[slots(words)], count) + self.bias
        return _logistic(total), words, number

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        chance, words, number = self.sentence_scores(data, at)
        rows = len(at) - 1
        first = np.flatnonzero(np.diff(number, prepend=-1))  # first word of each sentence
        stays = np.bincount(words.text[first], np.log1p(-chance), rows)
        bare = np.diff(words.first) == 0
        stays[bare] = np.log1p(-_logistic(np.array([self.bias])))[0]
        return -np.expm1(stays)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 15)))


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> Model:
    """``bags``: label, sentence number and slot of each word and stem of a text.

    Maximises the likelihood of the text labels under noisy-or by Adam, with a small
    pull of all weights to zero."""
    weights = np.zeros(1 << BITS)
    share = float(np.mean([b[0] for b in bags])) if bags else 0.0
    if share in (0.0, 1.0):
        return Model(weights, 15.0 if share else -30.0)
    label = np.array([b[0] for b in bags], float)
    spread, toxic_texts = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for y, _, words in bags:
        own = np.unique(words)
        spread[own] += 1
        toxic_texts[own] += y
    off = (toxic_texts - spread * share) / np.sqrt(np.maximum(spread * share * (1 - share), 1e-9))
    used = np.abs(off) >= LEAST_Z
    text, sentence, slot, base = [], [], [], 0
    for number, (_, own, words) in enumerate(bags):
        known, place = np.unique(own, return_inverse=True)
        keep = used[words]
        pairs = np.unique(place[keep].astype(np.int64) << BITS | words[keep])
        sentence.append((pairs >> BITS) + base)
        slot.append(pairs & ((1 << BITS) - 1))
        text.append(np.full(max(1, len(known)), number))
        base += max(1, len(known))
    text, sentence, slot = (np.concatenate(x).astype(np.int64) for x in (text, sentence, slot))
    names, slot = np.unique(slot, return_inverse=True)
    first = np.flatnonzero(np.diff(text, prepend=-1))

    value = np.zeros(len(names) + 1)
    value[-1] = np.log(share / max(1.0, base / len(bags)))
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, rounds + 1):
        chance = _logistic(np.bincount(sentence, value[slot], base) + value[-1])
        stays = np.add.reduceat(np.log1p(-chance), first)
        toxic = np.maximum(-np.expm1(stays), 1e-9)
        # d loglik / d sentence logit = p * (y / toxic - 1)  for noisy-or
        slope = chance * (label / toxic - 1)[text]
        grad = np.empty_like(value)
        grad[:-1] = np.bincount(slot, slope[sentence], len(names)) - 0.02 * value[:-1]
        grad[-1] = slope.sum()
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        value += 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    weights[names] = value[:-1]
    return Model(weights, float(value[-1]))


def bags(docs: DataFrame, label_col: str, text_col: str) -> DataFrame:
    """Label, sentence numbers and slots of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                data, at = flat(piece.column(1))
                words = hash_words(data, at, ALNUM, STEM)
                number, slot = sentences(data, at, words), slots(words).reshape(2, -1)
                ends = pa.array(2 * words.first, pa.int32())
                # word and stem side by side, so that a text's are together
                yield pa.record_batch(
                    [
                        piece.column(0),
                        pa.ListArray.from_arrays(ends, pa.array(np.repeat(number, 2), pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(slot.T.ravel(), pa.int32())),
                    ],
                    names=["label", "sentence", "slot"],
                )

    picked = docs.select(F.col(label_col).cast("int").alias("label"), text_col)
    return picked.mapInArrow(trimmed(run), "label int, sentence array<int>, slot array<int>")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = TRAIN_ROWS,
) -> Model:
    """Fit on at most ``rows`` labelled texts: the first in hash order of the id."""
    order = F.xxhash64(F.col(id_col), F.lit(7))
    chosen = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .select(id_col, label_col).dropDuplicates([id_col])
        .orderBy(order, id_col).limit(rows)
    )
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)  # at most `rows` rows
    found = bags(texts, label_col, text_col).toArrow()
    got = [
        (y, np.array(s, np.int32), np.array(w, np.int32))
        for y, s, w in zip(
            found["label"].to_pylist(),
            (x.values.to_numpy() for x in found["sentence"]),
            (x.values.to_numpy() for x in found["slot"]),
            strict=True,
        )
    ]
    got.sort(key=lambda b: (b[0], len(b[1]), b[2].tobytes()))  # the same model for any order of rows
    return fit(got)


def score(
    docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD,
    keep: list[str] | None = None, located: bool = False,
) -> DataFrame:
    """``keep`` (all columns by default) with ``score`` and ``predicted`` (score at least the
    threshold); with ``located`` also ``offending``: spans (bytes of the UTF-8 text) and scores
    of the sentences at or above the threshold, or the highest one of a predicted text. No shuffle."""
    added = "score double, predicted int"
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    if located:
        added += ", offending array<struct<start: int, end: int, score: double>>"
    names = [part.split()[0] for part in added.split(", ")][:2] + ["offending"] * located
    kept = [c for c in (keep or docs.columns) if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                data, at = flat(piece.column(piece.schema.get_field_index(text_col)))
                chance = shared.value.scores(data, at)
                columns = [piece.column(piece.schema.get_field_index(c)) for c in kept]
                columns += [pa.array(chance, pa.float64()), pa.array(chance >= threshold, pa.bool_()).cast(pa.int32())]
                if located:
                    columns.append(pa.array(_offending(shared.value, data, at, chance, threshold), spans))
                yield pa.record_batch(columns, names=[*kept, *names])

    from pyspark.sql.types import StructType

    schema = StructType([docs.schema[c] for c in kept] + StructType.fromDDL(added).fields)
    return docs.select(*dict.fromkeys([*kept, text_col])).mapInArrow(trimmed(run), schema)


def _offending(model: Model, data, at, scores, threshold) -> list[list[dict]]:
    chance, words, number = model.sentence_scores(data, at)
    out: list[list[dict]] = [[] for _ in scores]
    if not len(number):
        return out
    first = np.flatnonzero(np.diff(number, prepend=-1))
    last = np.append(first[1:], len(number)) - 1
    text = words.text[first]
    begin = np.searchsorted(text, np.arange(len(scores) + 1))
    for row in np.flatnonzero(scores >= threshold):
        own = np.arange(begin[row], begin[row + 1])
        if len(own):
            picked = own[chance[own] >= threshold]
            for k in picked if len(picked) else [own[np.argmax(chance[own])]]:
                low, high = words.start[first[k]] - at[row], words.end[last[k]] - at[row]
                out[row].append({"start": int(low), "end": int(high), "score": float(chance[k])})
    return out
