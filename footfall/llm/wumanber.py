"""Benchmark decontamination by Wu-Manber search over words.

A window is ``size`` consecutive words of a benchmark item (all words of a shorter item). Windows
of one length form a pattern set. Its shift table, indexed by the hash of a block of two words,
tells how far the search may skip from a position; where it may not skip, the bucket of the
block's hash names the windows that end with it, and their words are compared one by one.

Null and texts without words have no words, no window and no hit. Equal windows of several items
count for each of them. Items with a null id mark words but are not listed. Repeated documents
give repeated rows. An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from footfall.llm.arrays import ALNUM, flat, hash_words, mix, per_text, pieces
from footfall.llm.tables import trimmed

SIZE = 10
#: Windows whose tables one Python worker holds at a time (about 150 bytes each). A larger
#: benchmark is searched in several passes over the same scan, each with its own tables.
WINDOWS_PER_PASS = 1_000_000
#: Words per search lane: all lanes of a piece advance together.
LANE = 256
ADDED = ["n_words", "n_hit", "items", "hit_runs"]
_BLOCK = np.uint64(0xA24BAED4963EE407)


class PatternSet:
    """Wu-Manber tables of the windows of one length.

    ``words``: one window per row, as word hashes; ``owner``: its item number.
    """

    def __init__(self, words: np.ndarray, owner: np.ndarray):
        self.length = words.shape[1]
        self.block = min(2, self.length)
        bits = max(12, int(np.ceil(np.log2(max(2, words.size)))) + 3)
        self.right = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.length - self.block + 1, np.int32)
        for end in range(self.block - 1, self.length):
            at = self.slot(words[:, end - self.block + 1 : end + 1])
            np.minimum.at(self.shift, at, self.length - 1 - end)
        suffix = self.slot(words[:, self.length - self.block :])
        order = np.argsort(suffix, kind="stable")
        self.words, self.owner, self.suffix = words[order], owner[order], suffix[order]

    def slot(self, blocks: np.ndarray) -> np.ndarray:
        total = blocks[:, 0]
        for k in range(1, blocks.shape[1]):
            total = total * _BLOCK + blocks[:, k]
        return (mix(total) >> self.right).astype(np.int64)

    def find(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(first word, item number)`` of every occurrence within a text."""
        total = hashes[self.block - 1 :].copy()
        if self.block == 2:
            total += hashes[:-1] * _BLOCK
        slots = (mix(total) >> self.right).astype(np.int64)  # by the block's last word
        lane_at, lane_end = self._lanes(first)
        stops = []
        position = lane_at
        while len(position):
            skip = self.shift[slots[position - self.block + 1]]
            stop = skip == 0
            if stop.any():
                stops.append(position[stop])
            position = position + np.maximum(skip, 1)
            alive = position < lane_end
            position, lane_end = position[alive], lane_end[alive]
        if not stops:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.concatenate(stops)
        slot = slots[ends - self.block + 1]
        low = np.searchsorted(self.suffix, slot, side="left")
        count = np.searchsorted(self.suffix, slot, side="right") - low
        begin = np.repeat(ends - self.length + 1, count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        window = np.repeat(low, count) + within
        for k in range(self.length):  # direct comparison, word by word
            same = hashes[begin + k] == self.words[window, k]
            begin, window = begin[same], window[same]
        return begin, self.owner[window]

    def _lanes(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window ends to search, as half-open ranges of at most ``LANE`` words."""
        low, high = first[:-1] + self.length - 1, first[1:]
        some = low < high
        low, high = low[some], high[some]
        lanes = -(-(high - low) // LANE)
        number = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(low, lanes) + number * LANE
        return at, np.minimum(at + LANE, np.repeat(high, lanes))


def pattern_sets(texts: list[str | None], size: int = SIZE) -> list[PatternSet]:
    """Pattern sets of the items, by window length; an item's number is its place."""
    data, at = flat(pa.array(texts, pa.string()))
    words = hash_words(data, at, ALNUM)
    by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for item in range(len(texts)):
        own = words.hash[words.first[item] : words.first[item + 1]]
        length = min(size, len(own))
        if length:
            rows = np.lib.stride_tricks.sliding_window_view(own, length)
            by_length.setdefault(length, []).append((rows, np.full(len(rows), item)))
    return [
        PatternSet(np.concatenate([r for r, _ in some]), np.concatenate([o for _, o in some]))
        for _, some in sorted(by_length.items())
    ]


def _passes(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list[tuple]]:
    """Items in groups of at most ``limit`` windows; the driver holds one group."""
    group, held = [], 0
    for row in benchmark.select(item_col, text_col).toLocalIterator():
        windows = len(row[1] or "") // 2  # more than it has words
        if group and held + windows > limit:
            yield group
            group, held = [], 0
        group.append((row[0], row[1]))
        held += windows
    if group:
        yield group


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    limit: int = WINDOWS_PER_PASS,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted as strings) and ``hit_runs``
    (first word and end of each run of hit words). ``keep``: the columns to return besides.
    No shuffle."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ADDED]
    found = docs.select(*names)
    plan = list(_passes(benchmark, item_col, item_text, limit)) or [[]]
    for number, group in enumerate(plan):
        shared = spark.sparkContext.broadcast(
            ([None if i is None else str(i) for i, _ in group], pattern_sets([t for _, t in group], size))
        )
        last = number == len(plan) - 1
        found = _one_pass(found, shared, text_col, number > 0, keep if last and keep else names)
    return found


def _one_pass(docs: DataFrame, shared, text_col: str, again: bool, kept: list[str]) -> DataFrame:
    fields = [docs.schema[c] for c in kept]
    added = StructType.fromDDL("n_words long, n_hit long, items array<string>, hit_runs array<array<int>>").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets = shared.value
        for batch in batches:
            for piece in pieces(batch, text_col):
                before = None
                if again:
                    before = [piece.column(piece.schema.get_field_index(c)).to_pylist() for c in ("items", "hit_runs")]
                columns = [piece.column(piece.schema.get_field_index(c)) for c in kept]
                data, at = flat(piece.column(piece.schema.get_field_index(text_col)))
                words = hash_words(data, at, ALNUM)
                yield pa.record_batch(
                    [*columns, *_hits(words, ids, sets, before)],
                    names=[*kept, *ADDED],
                )

    return docs.mapInArrow(trimmed(run), StructType(fields + added))


def _hits(words, ids: list[str | None], sets: list[PatternSet], before) -> list[pa.Array]:
    n = len(words.hash)
    delta = np.zeros(n + 1, np.int64)
    owners = [set() for _ in range(len(words.first) - 1)]
    for patterns in sets:
        if n < patterns.length:
            continue
        begin, item = patterns.find(words.hash, words.first)
        np.add.at(delta, begin, 1)
        np.add.at(delta, begin + patterns.length, -1)
        for text, number in np.unique(np.stack([words.text[begin], item]), axis=1).T:
            owners[text].add(ids[number])
    if before:
        for row, (items, runs) in enumerate(zip(*before, strict=True)):
            owners[row].update(items)
            for low, high in runs:
                delta[words.first[row] + low] += 1
                delta[words.first[row] + high] -= 1
    hit = np.cumsum(delta[:-1]) > 0
    listed = [sorted(o for o in own if o is not None) for own in owners]
    runs = []
    for row in range(len(owners)):
        low, high = words.first[row], words.first[row + 1]
        if not hit[low:high].any():
            runs.append([])
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit[low:high].astype(np.int8), [0]])))
        runs.append(edges.reshape(-1, 2).tolist())
    return [
        pa.array(words.counts, pa.int64()),
        pa.array(per_text(hit.astype(np.int64), words.first), pa.int64()),
        pa.array(listed, pa.list_(pa.string())),
        pa.array(runs, pa.list_(pa.list_(pa.int32()))),
    ]


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
