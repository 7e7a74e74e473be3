"""SpotSigs fingerprints.

A spot is a common word (the anchor) with the chain of the next ``CHAIN`` content words after
it; the fingerprint of a text is the set of its spots, 32 bits each. Sets are partitioned by
length: with a floor on the likeness only sets of neighbouring partitions can reach it, and a
comparison ends as soon as what is left cannot reach the floor.

Null counts as the empty text. A text with words but without a spot has one signature made of
all its words; one with characters but no word, of its bytes; the empty text has none. Two empty
sets are alike (1), an empty and a full one are not (0).
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from footfall.llm.arrays import ALNUM, flat, hash_words, mix, pieces
from footfall.llm.tables import in_id_order

# The most frequent function words of four languages.
ANCHORS = {
    "en": "a an and are as at be but by for from had has have he her his i in is it its not of on "
    "or that the their they this to was were which will with you",
    "de": "als am an auch auf aus bei dass das dem den der des die ein eine einem einen er es für "
    "hat ich im in ist mit nicht noch sich sie sind und von vor war wie zu zum zur",
    "fr": "à au aux avec ce ces dans de des du elle en est et il je la le les mais ne ou où par pas "
    "plus pour qu que qui sa se ses son sur un une",
    "es": "al como con de del el en es esta la las lo los más no o para pero por que se sin su sus "
    "un una y",
}
CHAIN = 2
#: Length partitions grow by this factor.
LENGTH_STEP = 1.25
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def _anchor_hashes() -> np.ndarray:
    words = sorted({w for line in ANCHORS.values() for w in line.split()})
    return np.sort(_hashes_of(words))


def _hashes_of(words: list[str]) -> np.ndarray:
    data, at = flat(pa.array([" ".join(words)], pa.string()))
    return hash_words(data, at, ALNUM).hash


_anchors = _anchor_hashes()


def signatures(data: np.ndarray, at: np.ndarray, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct ``text number << 32 | signature`` of all texts."""
    words = hash_words(data, at, ALNUM)
    found = np.searchsorted(_anchors, words.hash)
    is_anchor = _anchors[np.minimum(found, len(_anchors) - 1)] == words.hash
    spots, content = np.flatnonzero(is_anchor), np.flatnonzero(~is_anchor)
    after = np.searchsorted(content, spots)
    whole = after + chain <= len(content)
    spots, after = spots[whole], after[whole]
    last = content[after + chain - 1]
    whole = words.text[last] == words.text[spots]
    spots, after = spots[whole], after[whole]
    total = words.hash[spots]
    for k in range(chain):
        total = total * _MULTIPLIER + words.hash[content[after + k]]
    keys = [(words.text[spots].astype(np.uint64) << np.uint64(32)) | (mix(total) >> np.uint64(32))]

    bare = np.ones(len(at) - 1, bool)
    bare[words.text[spots]] = False
    for row in np.flatnonzero(bare & (np.diff(at) > 0)):
        own = words.hash[words.first[row] : words.first[row + 1]]
        body = own.tobytes() if len(own) else data[at[row] : at[row + 1]].tobytes()
        value = int.from_bytes(hashlib.blake2b(body, digest_size=4).digest(), "little")
        keys.append(np.array([(int(row) << 32) | value], np.uint64))
    return np.unique(np.concatenate(keys))


def split(keys: np.ndarray, texts: int) -> list[np.ndarray]:
    """The signature set of each text."""
    ends = np.searchsorted(keys, np.arange(1, texts, dtype=np.uint64) << np.uint64(32))
    return np.split((keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), ends)


def encode(signature: np.ndarray) -> str:
    """``<set length>:<base64 of the sorted signatures>``"""
    return f"{len(signature)}:{base64.b64encode(signature.astype('<u4').tobytes()).decode()}"


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), "<u4")


def length_partition(n: int) -> int:
    """Number of the length partition; -1 for the empty set."""
    return -1 if n == 0 else int(math.log(n) / math.log(LENGTH_STEP) + 1e-9)


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets, or 0 where it is below ``floor``.

    Sets whose partitions are too far apart are not compared at all. Otherwise
    blocks of the smaller set are matched until the rest cannot reach the floor.
    """
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 1.0
    if not len(a):
        return 0.0
    if floor > 0:
        reach = math.ceil(-math.log(floor) / math.log(LENGTH_STEP))
        if length_partition(len(b)) - length_partition(len(a)) > reach or len(a) < floor * len(b):
            return 0.0
    block = len(a) if floor <= 0 else 256
    shared = 0
    for begin in range(0, len(a), block):
        part = a[begin : begin + block]
        found = np.minimum(np.searchsorted(b, part), len(b) - 1)
        shared += int((b[found] == part).sum())
        best = shared + len(a) - min(begin + block, len(a))
        if best < floor * (len(a) + len(b) - best):
            return 0.0
    value = shared / (len(a) + len(b) - shared)
    return value if value >= floor else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_signatures, length_partition, fingerprint`` of every text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                data, at = flat(piece.column(1))
                sets = split(signatures(data, at), piece.num_rows)
                yield pa.record_batch(
                    [
                        piece.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([length_partition(len(s)) for s in sets], pa.int32()),
                        pa.array([encode(s) for s in sets], pa.string()),
                    ],
                    names=[id_col, "n_signatures", "length_partition", "fingerprint"],
                )

    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_signatures long, length_partition int, fingerprint string"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def compare(pairs: DataFrame, left: str, right: str, floor: float = 0.0, out: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of two fingerprint columns (null where either is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (left, right))
            values = [
                None if x is None or y is None else likeness(decode(x), decode(y), floor)
                for x, y in zip(a, b, strict=True)
            ]
            yield pa.record_batch(
                [*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, out]
            )

    return pairs.mapInArrow(run, StructType([*pairs.schema.fields, StructField(out, DoubleType())]))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text beside its edited text and its successor.

    The edited text has its last ``n // 2`` characters replaced by as many first ones of the
    next text by id (after the last: the first; ids that repeat are ordered by text).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, still without its successor
        for batch in batches:
            for piece in pieces(batch, text_col):
                data, at = flat(piece.column(1))
                sets = split(signatures(data, at), piece.num_rows)
                texts = [t or "" for t in piece.column(1).to_pylist()]
                rows = list(
                    zip(piece.column(0).to_pylist(), texts, sets, piece.column(2).to_pylist(), strict=True)
                )
                rows = [held, *rows] if held else rows
                held = rows[-1]
                done = [(r, rows[k + 1]) for k, r in enumerate(rows[:-1]) if not r[3]]
                if done:
                    yield _compared(done)

    def _compared(done: list[tuple]) -> pa.RecordBatch:
        edited = []
        for (_, text, *_), (_, following, *_) in done:
            half = len(text) // 2
            edited.append(text[: len(text) - half] + following[:half])
        column = pa.array(edited, pa.string())
        sets = split(signatures(*flat(column)), len(edited))
        own, after = [r[2] for r, _ in done], [n[2] for _, n in done]
        return pa.record_batch(
            [
                pa.array([r[0] for r, _ in done], id_type),
                pa.array([len(r[1]) for r, _ in done], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([encode(s) for s in own], pa.string()),
                pa.array([encode(s) for s in sets], pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, sets, strict=True)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, after, strict=True)], pa.float64()),
                pa.array([length_partition(len(s)) for s in own], pa.int32()),
            ],
            names=[f.split()[0].strip("`") for f in schema.split(", ")],
        )

    kind = dict(docs.dtypes)[id_col]
    id_type = pa.int32() if kind == "int" else pa.string() if kind == "string" else pa.int64()
    schema = (
        f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, length_partition int"
    )
    ordered = in_id_order(docs.select(id_col, text_col), id_col, text_col)
    return ordered.select(id_col, text_col, "is_copy").mapInArrow(run, schema)
