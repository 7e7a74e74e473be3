"""Removal of repeated byte strings across all texts, exact, with suffix arrays.

A byte is removed if a string of ``length`` bytes around it also starts earlier: in a text with a
smaller id, or earlier in its own. Matches never cross texts; all strings are judged on the
input.

* **Anchors.** In every string of ``length`` bytes one inner ``KMER`` of them has the smallest
  hash (the first of equals). Equal strings have equal anchors at equal places, so only strings
  around equal anchors need to be compared. Neighbouring strings share anchors: there is one
  for about 35 bytes. The strings of one anchor, one after the other, make a segment.
* **First pass.** Anchors and segment hashes are dealt out by anchor, packed. Anchors that occur
  once are done. Of equal segments all but the first are removed whole. (Within a batch this is
  settled before the shuffle, so that a frequent passage sends one entry per batch.) What is
  left to ask is the first of each of several unlike segments around one anchor.
* **Second pass.** The segments asked for are cut out of the texts and dealt out by anchor. A string
  holds its anchor, so of a segment only the part counts that agrees with another segment of the
  anchor, going left and right from there; parts shorter than a string are done, and of parts
  with the same bytes all but the first are removed whole. A suffix array of each block of unlike
  parts, built by grouping on Lyndon prefixes, puts equal strings side by side; all but the first
  are removed.

Null counts as the empty text. Equal rows are one text and have equal results; texts that share
an id are ordered by a hash of the text; a null id is below all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.arrays import _CODES, _powers, flat, mix, pieces
from footfall.llm.suffixes import suffix_array
from footfall.llm.tables import cut, shuffle_partitions

LENGTH = 100
KMER = 32
#: Bytes of segments that one suffix array is built of, at least one anchor's.
BLOCK_BYTES = 30_000
#: Bytes of segments that are cut to their common parts at a time, at least one anchor's.
COMPARED_BYTES = 2_000_000
#: Bytes whose anchors are found in one go; a longer text is taken in overlapping stretches.
MOST = 1 << 28
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def segments(data: np.ndarray, at: np.ndarray, length: int = LENGTH, kmer: int = KMER):
    """Runs of strings with one anchor: ``(anchor hash, segment hash, place, low, high)``; string
    starts ``low..high`` and the anchor's ``place`` are byte places in ``data``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    if n > MOST:
        held = []
        for base in range(0, n - length + 1, MOST - length + 1):
            stretch = data[base : base + MOST]
            *hashed, place, low, high = segments(stretch, np.clip(at - base, 0, len(stretch)), length, kmer)
            held.append((*hashed, place + base, low + base, high + base))
        return tuple(np.concatenate(c) for c in zip(*held, strict=True))
    by_place = np.uint64(MOST - 1)
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[data] * power[:-1], out=sums[1:])
    hashes = mix((sums[kmer:] - sums[: n - kmer + 1]) * inverse[: n - kmer + 1])
    width = length - kmer + 1
    best = (hashes & ~by_place) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[: len(best) - (width - span)], best[width - span :])
    whole = np.ones(len(best), bool)  # strings within one text
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        whole[max(a, b - length + 1) : b] = False
    start = np.flatnonzero(whole)
    place = (best[start] & by_place).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    low, place = start[first], place[first]
    high = start[np.append(first[1:], len(start)) - 1] if len(first) else none
    body = (sums[high + length] - sums[low]) * inverse[low]
    shape = ((place - low).astype(np.uint64) << np.uint64(32)) | (high - low).astype(np.uint64)
    return hashes[place], mix(mix(body) + shape * _SALT), place, low, high


#: Segments around one anchor from which on its strings are dealt out one by one, by their
#: own hash, instead of to one suffix array: a line that a third of all texts share would else
#: gather in one task.
CROWD = 1500
_FIRST = "anchors binary, segments binary, places binary, lows binary, highs binary, counts binary, ids binary, ties binary"
_FOUND = "id long, tie long, starts binary, lengths binary"
_ASKED = "anchor binary, place binary, low binary, high binary, crowded binary"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _by_text(ids: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts rows of one text together, and where each text begins in it."""
    order = np.lexsort((ties, ids))
    if not len(order):
        return order, order
    a, b = ids[order], ties[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def _packed_by_text(ids, ties, columns: list[np.ndarray]) -> list[tuple]:
    """``(id, tie, *packed columns)`` of each text."""
    if not len(ids):
        return []
    order, starts = _by_text(ids, ties)
    ends = np.append(starts[1:], len(order))
    sorted_ = [c[order] for c in columns]
    return [
        (int(ids[order[a]]), int(ties[order[a]]), *(c[a:b].tobytes() for c in sorted_))
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
    ]


def _runs(anchor, segment, ids, ties, place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order of anchor, segment and place; where equal segments begin; which
    entries stand elsewhere than the first of their equals."""
    order = np.lexsort((place, ties, ids, segment, anchor))
    a, s = anchor[order], segment[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
    starts = np.flatnonzero(new)
    head = starts[np.cumsum(new) - 1] if len(order) else starts
    i, t, p = ids[order], ties[order], place[order]
    later = (i != i[head]) | (t != t[head]) | (p != p[head])
    return order, starts, later


def _batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_names(schema))


def _first_pass(texts: DataFrame, parts: int, length: int, kmer: int, crowd: int) -> DataFrame:
    """Rows by text: ranges to remove, and anchors whose segments are asked for.
    ``texts``: ``id, tie, text``."""
    sent = f"part int, {_FIRST}, {_FOUND}"
    given = f"{_FOUND}, {_ASKED}"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, base = [], 0
            all_ids, all_ties = (batch.column(k).to_numpy() for k in (0, 1))
            for piece in pieces(batch, "text"):
                data, at = flat(piece.column(2))
                anchor, segment, place, low, high = segments(data, at, length, kmer)
                row = np.searchsorted(at, place, side="right") - 1
                held.append((anchor, segment, place - at[row], low - at[row], high - at[row], row + base))
                base += piece.num_rows
            if not held:
                continue
            anchor, segment, place, low, high, row = (np.concatenate(c) for c in zip(*held, strict=True))
            ids, ties = all_ids[row], all_ties[row]
            order, starts, later = _runs(anchor, segment, ids, ties, place)
            gone = order[later]
            rows = [
                (int(i % parts), *[None] * 8, i, t, s, n)
                for i, t, s, n in _packed_by_text(ids[gone], ties[gone], [low[gone], high[gone] - low[gone] + length])
            ]
            kept = order[starts]
            part = (anchor[kept] % np.uint64(parts)).astype(np.int64)
            kept = kept[np.lexsort((row[kept], part))]
            part = (anchor[kept] % np.uint64(parts)).astype(np.int64)
            edges = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edges)).tolist():
                own = kept[edges[p] : edges[p + 1]]
                first = np.flatnonzero(np.diff(row[own], prepend=-1))
                counts = np.diff(np.append(first, len(own))).astype(np.uint32)
                rows.append(
                    (
                        p, anchor[own].tobytes(), segment[own].tobytes(), place[own].astype(np.int64).tobytes(),
                        (place[own] - low[own]).astype(np.uint16).tobytes(), (place[own] - high[own]).astype(np.int16).tobytes(),
                        counts.tobytes(), ids[own[first]].tobytes(), ties[own[first]].tobytes(), None, None, None, None,
                    )
                )
            yield _batch_of(rows, sent)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            packed = batch.column(1).is_valid()
            through = batch.filter(pc.invert(packed)).select([9, 10, 11, 12])
            none = [pa.nulls(through.num_rows, pa.binary())] * 5
            yield pa.record_batch([*through.columns, *none], names=_names(given))
            picked = batch.filter(packed)
            rows += zip(*(picked.column(k).to_pylist() for k in range(1, 9)), strict=True)
        if not rows:
            return
        kinds = [np.uint64, np.uint64, np.int64, np.uint16, np.int16, np.uint32, np.int64, np.int64]
        anchor, segment, place, before, after, counts, ids, ties = (
            np.concatenate([np.frombuffer(r[k], kind) for r in rows]) for k, kind in enumerate(kinds)
        )
        ids, ties = np.repeat(ids, counts), np.repeat(ties, counts)
        low, high = place - before, place - after
        order, starts, later = _runs(anchor, segment, ids, ties, place)
        gone = order[later]
        out = [
            (*r, *[None] * 5)
            for r in _packed_by_text(ids[gone], ties[gone], [low[gone], high[gone] - low[gone] + length])
        ]
        heads = order[starts]
        new = np.ones(len(heads), bool)
        new[1:] = anchor[heads][1:] != anchor[heads][:-1]
        unlike = np.diff(np.append(np.flatnonzero(new), len(heads)))
        unlike = np.repeat(unlike, unlike)
        asked, many = heads[unlike > 1], (unlike[unlike > 1] > crowd).astype(np.uint8)
        out += [
            (i, t, None, None, *rest)
            for i, t, *rest in _packed_by_text(
                ids[asked], ties[asked], [anchor[asked], place[asked], low[asked], high[asked], many]
            )
        ]
        yield _batch_of(out, given)

    return texts.mapInArrow(emit, sent).repartition(parts, "part").mapInArrow(settle, given)


def _second_pass(asked: DataFrame, parts: int, length: int) -> DataFrame:
    """Ranges from suffix arrays, and the strings of crowded anchors with their hashes.
    ``asked``: ``id, tie, text, asks``."""
    sent = "part int, anchors binary, ids binary, ties binary, lows binary, befores binary, sizes binary, body binary, string binary, string_ids binary, string_ties binary, string_places binary"
    given = f"{_FOUND}, string long, place long"

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, list] = {}
            strings: list[tuple] = []
            for i, t, text, asks in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                body = text.encode()
                anchor, place, low, high, many = (
                    np.concatenate([np.frombuffer(a[n], kind) for a in asks])
                    for n, kind in (("anchor", np.uint64), ("place", np.int64), ("low", np.int64), ("high", np.int64), ("crowded", np.uint8))
                )
                for key, own, a, b, crowded in zip(*(c.tolist() for c in (anchor, place, low, high, many)), strict=True):
                    if crowded:
                        strings.append((key, i, t, a, body[a : b + length]))
                    else:
                        held.setdefault(key % parts, []).append((key, i, t, a, own - a, body[a : b + length]))
            rows = [
                (
                    p, np.array([s[0] for s in some], np.uint64).tobytes(),
                    *(np.array([s[k] for s in some], np.int64).tobytes() for k in (1, 2, 3)),
                    np.array([s[4] for s in some], np.uint16).tobytes(),
                    np.array([len(s[5]) for s in some], np.uint32).tobytes(), b"".join(s[5] for s in some), *[None] * 4,
                )
                for p, some in held.items()
            ]
            if strings:
                rows += _single_strings(strings, parts, length)
            yield _batch_of(rows, sent)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            picked = batch.filter(batch.column(1).is_valid())
            rows += zip(*(picked.column(k).to_pylist() for k in range(1, 8)), strict=True)
            alone = batch.filter(batch.column(8).is_valid())
            for packed in zip(*(alone.column(k).to_pylist() for k in range(8, 12)), strict=True):
                string, ids, ties, places = (pa.array(np.frombuffer(p, np.int64)) for p in packed)
                none = pa.nulls(len(string), pa.binary())
                yield pa.record_batch([ids, ties, none, none, string, places], names=_names(given))
        if not rows:
            return
        columns = [np.concatenate([np.frombuffer(r[k], kind) for r in rows]) for k, kind in enumerate((np.uint64, np.int64, np.int64, np.int64, np.uint16, np.uint32))]
        body = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
        del rows
        for found in _blocks(*columns, body, length):
            yield _batch_of([(*r, None, None) for r in _packed_by_text(*found[:2], list(found[2:]))], given)

    return asked.mapInArrow(cut_out, sent).repartition(parts, "part").mapInArrow(sort, given)


def _single_strings(strings: list[tuple], parts: int, length: int) -> list[tuple]:
    """Every string of the segments of crowded anchors by itself: hash and place."""
    data = np.frombuffer(b"".join(s[4] for s in strings), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(s[4]) for s in strings])])
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * power[:-1], out=sums[1:])
    counts = np.diff(at) - length + 1
    number = np.repeat(np.arange(len(strings)), counts)
    shift = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = at[number] + shift
    key = mix((sums[start + length] - sums[start]) * inverse[start])
    ids, ties, lows = (np.array([s[k] for s in strings], np.int64) for k in (1, 2, 3))
    part = (key % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    out = []
    for p in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[p] : edges[p + 1]]
        packed = (key[own].view(np.int64), ids[number[own]], ties[number[own]], (lows[number] + shift)[own])
        out.append((p, *[None] * 7, *(c.tobytes() for c in packed)))
    return out


def _blocks(anchor, ids, ties, lows, befores, sizes, body, length: int) -> Iterator[tuple]:
    """Ranges to remove ``(ids, ties, starts, lengths)``, block by block. All segments of an
    anchor are in one block."""
    sizes = sizes.astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    order = np.argsort(anchor, kind="stable")
    for a, b in _anchor_runs(anchor[order], sizes[order], COMPARED_BYTES):
        some = order[a:b]
        left, size = _common(anchor[some], befores[some].astype(np.int64), sizes[some], begin[some], body)
        kept = size >= length
        some, left, size = some[kept], left[kept], size[kept]
        low, at = lows[some] + left, begin[some] + left
        for c, d in _anchor_runs(anchor[some], size, BLOCK_BYTES):
            own = slice(c, d)
            yield _block(ids[some[own]], ties[some[own]], low[own], size[own], at[own], body, length)


def _anchor_runs(anchor: np.ndarray, sizes: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole anchors (sorted) that hold ``least`` bytes or are the last."""
    if not len(anchor):
        return
    ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
    total = np.cumsum(sizes)
    begin = done = 0
    for end in ends.tolist():
        if total[end - 1] - done >= least or end == len(anchor):
            yield begin, end
            begin, done = end, total[end - 1]


def _common(anchor, before, sizes, begin, body) -> tuple[np.ndarray, np.ndarray]:
    """The part of each segment (its offset and size) that agrees with another segment of its
    anchor, going left and right from the anchor's place. Anchors are sorted."""
    left = _agreeing(anchor, before, begin + before - 1, -1, body)
    right = _agreeing(anchor, sizes - before, begin + before, 1, body)
    return before - left, left + right


def _agreeing(anchor, sizes, begin, step: int, body) -> np.ndarray:
    """How many of the ``sizes`` bytes from ``begin`` on, in direction ``step``, each row has in
    common with another row of its anchor: in sorted order, with one of its two neighbours."""
    width = int(sizes.max(initial=0))
    along = np.arange(width)
    inside = along < sizes[:, None]
    # One above the byte, 0 past the end: a row's end agrees with nothing but another row's end.
    symbols = np.where(inside, body[np.where(inside, begin[:, None] + step * along, 0)].astype(np.uint16) + 1, 0)
    keys = symbols.astype(">u2").view(f"V{2 * width}").reshape(-1) if width else np.zeros(len(sizes), "V1")
    number = np.cumsum(np.append(True, anchor[1:] != anchor[:-1])[: len(anchor)])
    by_bytes = np.argsort(keys, kind="stable")
    order = by_bytes[np.argsort(number[by_bytes], kind="stable")]
    sorted_ = symbols[order]
    unlike = sorted_[1:] != sorted_[:-1]
    shared = np.where(unlike.any(axis=1), unlike.argmax(axis=1), width) if width else np.zeros(max(len(order) - 1, 0), np.int64)
    shared = np.where(number[order][1:] == number[order][:-1], shared, 0)
    best = np.zeros(len(order), np.int64)
    best[:-1] = shared
    best[1:] = np.maximum(best[1:], shared)
    out = np.empty(len(order), np.int64)
    out[order] = np.minimum(best, sizes[order])
    return out


def _block(ids, ties, lows, sizes, begin, body, length: int) -> tuple:
    texts, starts = _by_text(ids, ties)
    rank = np.zeros(len(ids), np.int64)
    rank[texts] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(texts))))
    order = np.lexsort((lows, rank))
    seen: dict[bytes, int] = {}
    head = np.array([seen.setdefault(body[begin[k] : begin[k] + sizes[k]].tobytes(), k) for k in order.tolist()], np.int64)
    later = order[(rank[order] != rank[head]) | (lows[order] != lows[head])]
    own = np.fromiter(seen.values(), np.int64, len(seen))
    found = _sorted_block(ids[own], ties[own], rank[own], lows[own], sizes[own], begin[own], body, length)
    return tuple(np.concatenate([c[later], f]) for c, f in zip((ids, ties, lows, sizes), found, strict=True))


def _sorted_block(ids, ties, rank, lows, sizes, begin, body, length: int) -> tuple:
    """`_block` of parts with unlike bytes; ``rank``: places of their texts."""
    at = np.cumsum(sizes + 1) - (sizes + 1)  # one end mark after each segment
    symbols = np.zeros(int((sizes + 1).sum()) + length, np.int64)
    number = np.repeat(np.arange(len(sizes)), sizes)
    shift = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[at[number] + shift] = body[begin[number] + shift].astype(np.int64) + 1
    used = len(symbols) - length
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    offset = np.arange(used) - at[owner]
    whole = sizes[owner] - offset >= length
    ordered = np.array(suffix_array(symbols[:used].tolist()), np.int64)
    ordered = ordered[whole[ordered]]
    strings = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.int16), length)
    new = np.ones(len(ordered), bool)
    for k in range(1, len(ordered), 4096):
        some = ordered[k : k + 4096]
        new[k : k + 4096] = (strings[some] != strings[ordered[k - 1 : k - 1 + len(some)]]).any(axis=1)
    # Places in order of text and byte: equal keys are the same place of equal rows.
    _, key = np.unique(np.stack([rank[owner[ordered]], lows[owner[ordered]] + offset[ordered]]), axis=1, return_inverse=True)
    key = key.reshape(-1)
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(key, np.flatnonzero(new)) if len(key) else key
    gone = np.sort(ordered[key != least[group]]) if len(key) else ordered
    if not len(gone):
        return ids[:0], ties[:0], lows[:0], lows[:0]
    first = np.ones(len(gone), bool)
    first[1:] = (gone[1:] != gone[:-1] + 1) | (owner[gone[1:]] != owner[gone[:-1]])
    low = gone[first]
    high = gone[np.append(np.flatnonzero(first)[1:], len(gone)) - 1]
    return ids[owner[low]], ties[owner[low]], lows[owner[low]] + offset[low], high - low + length


def _later_strings(strings: DataFrame, length: int) -> DataFrame:
    """Strings of crowded anchors that also start earlier, as ranges by text."""
    place = F.struct("id", "tie", "place")
    first = strings.groupBy("string").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    later = strings.join(first.select("string", "first"), "string").filter(place != F.col("first"))
    return later.select("id", "tie", F.col("place").alias("start"), F.lit(length).cast("long").alias("length"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, kmer: int = KMER, crowd: int = CROWD,
    with_text: bool = False,
) -> DataFrame:
    """Per row: ``n_bytes, n_removed, n_spans, kept_sha256`` and, with ``with_text``, the bytes
    that are ``kept``."""
    parts = shuffle_partitions(docs.sparkSession)
    lowest = -(1 << 63)
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(id_col).alias("own"),
    )
    long = texts.filter(F.octet_length("text") >= length)
    first = cut(_first_pass(long.select("id", "tie", "text"), parts, length, kmer, crowd), "anchors")
    asks = first.filter("anchor is not null").groupBy("id", "tie").agg(
        F.collect_list(F.struct("anchor", "place", "low", "high", "crowded")).alias("asks")
    )
    asked = long.select("id", "tie", "text").join(asks, ["id", "tie"])
    second = cut(_second_pass(asked, parts, length), "strings")
    packed = first.filter("starts is not null").select("id", "tie", "starts", "lengths").unionByName(
        second.filter("starts is not null").select("id", "tie", "starts", "lengths")
    )
    single = _later_strings(second.filter("string is not null").select("string", "id", "tie", "place"), length)
    ranges = packed.groupBy("id", "tie").agg(
        F.collect_list("starts").alias("starts"), F.collect_list("lengths").alias("lengths")
    )
    alone = single.groupBy("id", "tie").agg(
        F.collect_list("start").alias("at"), F.collect_list("length").alias("size")
    )
    ranges = ranges.join(alone, ["id", "tie"], "full_outer")
    given = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts, lengths, at, size in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
                body = text.encode()
                low = np.concatenate([np.array(at or [], np.int64), *(np.frombuffer(s, np.int64) for s in starts or [])])
                long_ = np.concatenate([np.array(size or [], np.int64), *(np.frombuffer(s, np.int64) for s in lengths or [])])
                kept, spans = _without(body, low, long_)
                row = (len(body), len(body) - len(kept), spans, hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_text else row)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [()] * (4 + with_text)
            yield pa.record_batch(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=False))], names=[id_col, *_names(given)]
            )

    whole = texts.join(ranges, ["id", "tie"], "left").select("own", "text", "starts", "lengths", "at", "size")
    return whole.mapInArrow(apply, f"`{id_col}` {dict(docs.dtypes)[id_col]}, {given}")


def _without(body: bytes, low: np.ndarray, size: np.ndarray) -> tuple[bytes, int]:
    """The bytes outside all ranges, and the number of runs that were removed."""
    if not len(low):
        return body, 0
    change = np.zeros(len(body) + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, low + size, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(body, np.uint8)[~gone].tobytes(), spans
