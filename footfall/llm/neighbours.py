"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte trigrams (upper and lower case apart), hashed to ``SLOTS`` places, and
a few that tell how much of it is one word said three times and more in a row. A term counts
``log(1 + times)``, times the log of how rare it is among all texts of the table. The singular
vectors of a bounded sample of labelled texts span the latent space; the sample's vectors are
broadcast. Every text is compared with all of them by exact cosines, a block of texts at a time,
and the ``NEIGHBOURS`` nearest vote with the ``POWER``-th power of their cosine as weight. Texts at
the same distance (rounded to ``DIGITS``) all vote, so the order of the sample does not matter.

Null counts as the empty text. A text that resembles nothing (an empty one, say) scores the share
of label 1 in the sample, as does every text if the sample holds one label only; without labels
the score is 0. Labels other than 0 and 1 are left out, and so are ids that carry both. Of several
texts under one id the least is learnt from; each is scored for itself. A text above
``PIECE_BYTES`` is taken whole, in stretches cut at white space; terms across a cut do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.arrays import NON_SPACE, PIECE_BYTES, flat, hash_words, mix, per_text, pieces

BITS = 12
SLOTS = 1 << BITS
#: The last slots tell which share of the words repeats the two before: at least 1, 1/2, 1/4 ...
SHARES = 8
#: Labelled texts that are learnt from at most, the first in hash order of the id. So the
#: driver holds ``TRAIN_ROWS * SLOTS`` numbers, 64 MB.
TRAIN_ROWS = 4000
#: Dimensions of the latent space; the broadcast holds ``(TRAIN_ROWS + SLOTS) * LATENT`` numbers, 2 MB.
LATENT = 64
NEIGHBOURS, POWER, DIGITS = 15, 4, 5
THRESHOLD = 0.5
#: Texts compared at once.
ROWS = 256
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _stretches(data: np.ndarray) -> Iterator[np.ndarray]:
    begin = 0
    while begin < len(data):
        end = min(begin + PIECE_BYTES, len(data))
        if end < len(data):
            spaces = np.flatnonzero(_SPACES[data[begin:end]])
            end = begin + int(spaces[-1]) + 1 if len(spaces) else end
        yield data[begin:end]
        begin = end


def _counted(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Times of each trigram slot per text; words, and words that repeat the two before."""
    rows = len(at) - 1
    counts = np.zeros((rows, SLOTS), np.float32)
    if len(data) > 2:
        row = np.repeat(np.arange(rows), np.diff(at))
        wide = data.astype(np.uint64)
        code = mix(wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)) >> np.uint64(64 - BITS)
        inside = row[:-2] == row[2:]
        places = row[:-2][inside] * SLOTS + code[inside].astype(np.int64)
        counts += np.bincount(places, minlength=rows * SLOTS).reshape(rows, SLOTS)
    words = hash_words(data, at, NON_SPACE)
    again = np.zeros(len(words.hash), np.int64)
    if len(again) > 2:
        h, t = words.hash, words.text
        again[2:] = (h[2:] == h[1:-1]) & (h[1:-1] == h[:-2]) & (t[2:] == t[:-2])
    return counts, words.counts, per_text(again, words.first)


def term_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Times of each term in each text."""
    if len(at) == 2 and len(data) > PIECE_BYTES:
        parts = [_counted(s, np.array([0, len(s)])) for s in _stretches(data)]
        counts, words, again = (sum(p[k] for p in parts) for k in range(3))
    else:
        counts, words, again = _counted(data, at)
    for k in range(SHARES):
        counts[:, SLOTS - 1 - k] = np.where((again > 0) & (again * 2**k >= words), again, 0)
    return counts


def _blocks(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for piece in pieces(batch, text_col):
            for begin in range(0, piece.num_rows, ROWS):
                block = piece.slice(begin, ROWS)
                yield block, term_counts(*flat(block.column(block.schema.get_field_index(text_col))))


@dataclass
class Model:
    """``to_latent`` takes weighted term counts; ``vectors`` are of unit length."""

    rarity: np.ndarray
    to_latent: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def share(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.0

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(weighted(counts, self.rarity) @ self.to_latent)

    def votes(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if self.share in (0.0, 1.0):
            return np.full(len(counts), self.share)
        near = np.round(self.latent(counts) @ self.vectors.T, DIGITS)
        k = min(neighbours, near.shape[1])
        least = np.partition(near, near.shape[1] - k, axis=1)[:, -k][:, None]
        weight = np.where(near >= least, np.maximum(near, 0), 0).astype(float) ** POWER
        total = weight.sum(1)
        share = np.minimum(weight @ self.labels / np.maximum(total, 1e-300), 1.0)
        return np.where(total > 0, share, self.share)


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * rarity)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def fit(counts: np.ndarray, labels: np.ndarray, rarity: np.ndarray, latent: int = LATENT) -> Model:
    """Leading right singular vectors of the weighted counts, by subspace iteration."""
    rows = weighted(counts, rarity.astype(np.float32))
    rank = min(latent, len(rows))
    basis = np.zeros((SLOTS, 0), np.float32)
    if rank:
        start = np.random.default_rng(20240611).standard_normal((SLOTS, min(rank + 10, len(rows))))
        side = rows @ start.astype(np.float32)
        for _ in range(4):
            side, _r = np.linalg.qr(rows @ (rows.T @ side))
        basis = np.linalg.svd(side.T @ rows, full_matrices=False)[2][:rank].T
    basis = np.ascontiguousarray(basis, np.float32)
    return Model(rarity.astype(np.float32), basis, _unit(rows @ basis), labels.astype(float))


def rarity(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log of all texts over the texts that hold the term, over the whole table. The counts of a
    task are summed in it; as many rows as terms reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = np.zeros(SLOTS, np.int64), 0
        for block, counts in _blocks(batches, text_col):
            held += np.count_nonzero(counts, axis=0)
            texts += block.num_rows
        used = np.flatnonzero(held)
        yield pa.record_batch(
            [pa.array(np.append(used, SLOTS), pa.int32()), pa.array(np.append(held[used], texts), pa.int64())],
            names=["slot", "n"],
        )

    found = docs.select(text_col).mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    held = np.zeros(SLOTS + 1)
    for row in found.collect():  # SLOTS + 1 rows at most
        held[row.slot] = row.n
    return np.log((held[-1] + 1) / (held[:-1] + 1))


def _sampled(docs: DataFrame, text_col: str) -> pa.Table:
    """Label and non-zero term counts of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, counts in _blocks(batches, text_col):
            row, slot = np.nonzero(counts)
            ends = pa.array(np.searchsorted(row, np.arange(len(counts) + 1)), pa.int32())
            yield pa.record_batch(
                [
                    block.column(0),
                    block.column(1),
                    pa.ListArray.from_arrays(ends, pa.array(slot, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts[row, slot], pa.float32())),
                ],
                names=["place", "label", "slot", "times"],
            )

    return docs.mapInArrow(run, "place long, label int, slot array<int>, times array<float>").toArrow()


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAIN_ROWS,
) -> Model:
    """Learn from at most ``rows`` labelled texts; term rarities are those of all ``docs``."""
    place = F.xxhash64(F.col(id_col), F.lit(11))
    chosen = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(id_col).agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).alias("most"))
        .filter("label = most").select(id_col, "label", place.alias("place"))
        .orderBy("place", id_col).limit(rows)
    )
    # At most `rows` rows are broadcast; the texts of one id are reduced to one before they meet.
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)
    texts = texts.groupBy(id_col, "place", "label").agg(F.min(text_col).alias(text_col))
    found = _sampled(texts.select("place", "label", text_col), text_col).combine_chunks().sort_by("place")
    counts = np.zeros((found.num_rows, SLOTS), np.float32)
    if found.num_rows:
        slots, times = (found[c].combine_chunks() for c in ("slot", "times"))
        owner = np.repeat(np.arange(found.num_rows), np.diff(slots.offsets.to_numpy()))
        counts[owner, slots.flatten().to_numpy()] = times.flatten().to_numpy()
    return fit(counts, found["label"].to_numpy(), rarity(docs, text_col))


def score(
    docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) with ``score``, the weighted share of neighbours with
    label 1, and ``predicted`` (score at least the threshold). No shuffle."""
    added = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    kept = [c for c in (keep or docs.columns) if c not in added.fieldNames()]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, counts in _blocks(batches, text_col):
            votes = shared.value.votes(counts)
            columns = [block.column(block.schema.get_field_index(c)) for c in kept]
            columns += [pa.array(votes, pa.float64()), pa.array((votes >= threshold).astype(np.int32), pa.int32())]
            yield pa.record_batch(columns, names=[*kept, "score", "predicted"])

    schema = T.StructType([docs.schema[c] for c in kept] + added.fields)
    return docs.select(*dict.fromkeys([*kept, text_col])).mapInArrow(run, schema)
