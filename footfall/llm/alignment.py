"""Alignment of two tokenizers over the same bytes.

A text is encoded by a byte-level BPE vocabulary (A) and by a SentencePiece model (B), both with a
space before it. All tokens of both are sorted by their first byte; a group ends where a start
reaches the running maximum of the ends before it, so groups are the shortest stretches that both
sides cut alike. Within a group every A token is linked with every B token.

Neither tokenizer joins a space to a letter, digit or mark before it, so a text falls into units
that begin with such a space and are encoded alike wherever they stand. Each distinct unit of a
pack of texts is encoded and aligned once, and a text's tokens, groups and links are those of its
units in order.

How many texts hold a pair of ids linked is counted over the whole table: a pack (texts of about
``PACK_BYTES``, or one longer text) lists each of its pairs once with its texts, these are summed
by pair, and the sums go back to the packs. So what is shuffled follows the packs' distinct pairs
and not the links. Links that come from ids repeated in one group are counted, not written out.
Memory is linear in a pack; a text's own size bounds the last step, too.

A null or empty text has no tokens, nor has one whose tokens of either side do not spell the space
and the text (one with U+2581, say). Rows are independent: equal ids are separate rows. Columns
of the result hide input columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.arrays import flat, per_text, pieces
from footfall.llm.tables import cut

PACK_BYTES = 2 << 20
#: A pair of ids as one number.
_SHIFT = 32
_MASK = (1 << _SHIFT) - 1
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
#: How byte-level vocabularies of this format cut a text; a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Units of code points below this are cut alike by every Unicode version.
_SETTLED = "\u0300"


def _bytes_of_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Side:
    """An encoder of units and the bytes of each id."""

    encode: object
    spelled: list[bytes]

    def __post_init__(self):
        self.lengths = np.array([len(s) for s in self.spelled], np.int64)


@cache
def byte_side(path: str) -> Side:
    """The encoder of a byte-level vocabulary file.

    Where the k-th merge makes the k-th id after the single bytes, merging by listed pairs and
    merging by the rank of the joined bytes give the same ids. Units of Latin letters, digits and
    marks are then encoded by rank, which returns plain lists and is several times as fast;
    others (their letters might be told apart by another Unicode version) by the file itself.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = _bytes_of_letters()
    vocabulary = tokenizer.get_vocab()
    spelled = [b""] * tokenizer.get_vocab_size()
    for token, at in vocabulary.items():
        spelled[at] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    with open(path, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    bytes_first = sorted(spelled[:256]) == [bytes([b]) for b in range(256)]
    ranked = bytes_first and all(vocabulary[token] == 256 + k for k, token in enumerate(joined))

    def by_file(units: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    if not ranked:
        return Side(by_file, spelled)
    ranks = {token: k for k, token in enumerate(spelled[: 256 + len(merges)])}
    by_rank = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(units: list[str]) -> list[list[int]]:
        found = [by_rank.encode_ordinary(u) if max(u) < _SETTLED else None for u in units]
        others = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(others, by_file([units[k] for k in others]), strict=True):
            found[k] = ids
        return found

    return Side(encode, spelled)


@cache
def piece_side(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = [
        bytes([int(model.id_to_piece(k)[1:-1], 16)]) if model.is_byte(k)
        else model.id_to_piece(k).replace("▁", " ").encode()
        for k in range(model.vocab_size())
    ]
    space = [model.piece_to_id("▁")]

    def encode(units: list[str]) -> list[list[int]]:
        # The model adds the unit's first space itself, but not to an empty text.
        found = model.encode([u[1:] for u in units], num_threads=1)
        return [ids or space for ids in found]

    return Side(encode, spelled)


def _unit_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where units begin: at each text, and at a space behind a printable ASCII byte or one of
    the letters U+00C0 to U+00FF."""
    before = np.zeros(len(data), bool)
    if len(data) > 1:
        last = data[:-1]
        before[1:] = (last > 32) & (last < 127)
        before[2:] |= (data[:-2] == 0xC3) & (last[1:] >= 0x80)
    begins = before & (data == 32)
    begins[at[:-1][np.diff(at) > 0]] = True
    return np.flatnonzero(begins)


def groups_of(
    a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group number, side (0, 1) and id of all tokens, by group, side and place."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    side, ids = np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), bool)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.cumsum(opens) - 1
    inner = np.argsort(group * 2 + side[order], kind="stable")
    order = order[inner]
    return group[inner], side[order], ids[order]


@dataclass
class Units:
    """What is known of each distinct unit of a pack."""

    good: np.ndarray  # both sides spell it
    counts: dict[str, np.ndarray]
    text: list[str]  # its groups as text
    first: np.ndarray  # its pairs are pair[first[i]:first[i + 1]]
    pair: np.ndarray
    times: np.ndarray


def _tokens(side: Side, units: list[str], data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, unit number of each, and which units they spell."""
    listed = side.encode(units)
    unit = np.repeat(np.arange(len(units)), [len(x) for x in listed])
    plain = list(chain.from_iterable(listed))
    ids = np.array(plain, np.int64)
    if b"".join(map(side.spelled.__getitem__, plain)) == data:
        good = np.bincount(unit, side.lengths[ids], len(units)).astype(np.int64) == np.diff(at)
        if good.all():
            return ids, unit, good
    good = np.array(
        [b"".join([side.spelled[k] for k in x]) == data[lo:hi] for x, lo, hi in zip(listed, at, at[1:], strict=False)], bool
    )
    return ids, unit, good


def _placed(side: Side, ids: np.ndarray, unit: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of tokens that spell their units."""
    length = side.lengths[ids]
    end = np.cumsum(length)
    first = np.searchsorted(unit, np.arange(len(at) - 1))
    before = np.append(0, end)[first]
    start = end - length - before[unit] + at[:-1][unit]
    return start, start + length


@cache
def _written(size: int) -> list[str]:
    return [f"{k}{mark}" for k in range(size) for mark in ",|;"]


def align_units(units: pa.Array, one: Side, other: Side) -> Units:
    body, at = flat(units)
    data, listed = body.tobytes(), units.to_pylist()
    a, a_unit, a_good = _tokens(one, listed, data, at)
    b, b_unit, b_good = _tokens(other, listed, data, at)
    good = a_good & b_good
    a, a_unit, b, b_unit = a[good[a_unit]], a_unit[good[a_unit]], b[good[b_unit]], b_unit[good[b_unit]]
    a_start, a_end = _placed(one, a, a_unit, at)
    b_start, b_end = _placed(other, b, b_unit, at)
    group, side, ids = groups_of(a, a_start, a_end, b, b_start, b_end)
    n = len(listed)
    n_groups = int(group[-1]) + 1 if len(group) else 0
    in_a = np.bincount(group[side == 0], minlength=n_groups)
    in_b = np.bincount(group[side == 1], minlength=n_groups)
    # A group's unit is that of its A tokens; groups and A tokens are in the same order.
    owner = a_unit[np.cumsum(in_a) - in_a] if n_groups else np.zeros(0, np.int64)

    def total(values):
        return np.bincount(owner, values, n).astype(np.int64)

    counts = {"n_a": total(in_a), "n_b": total(in_b), "n_groups": total(None), "n_links": total(in_a * in_b)}

    # Ids with what follows them: a comma, the bar between the sides, or the end of the group.
    last = np.ones(len(group), bool)
    last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
    names = _written(max(len(one.spelled), len(other.spelled)))
    written = list(map(names.__getitem__, (ids * 3 + last * (1 + side)).tolist()))
    ends = np.cumsum(counts["n_a"] + counts["n_b"])
    text = ["".join(written[lo:hi]) for lo, hi in zip([0, *ends.tolist()], ends.tolist(), strict=False)]

    # Distinct ids of each group and side with their times, then all pairs of a group.
    key, times = np.unique((group * 2 + side) << _SHIFT | ids, return_counts=True)
    g, s, k = key >> (_SHIFT + 1), key >> _SHIFT & 1, key & _MASK
    b_kinds = np.bincount(g[s == 1], minlength=n_groups)
    b_first = np.cumsum(b_kinds) - b_kinds
    left_g, left_k, left_t = g[s == 0], k[s == 0], times[s == 0]
    right_k, right_t = k[s == 1], times[s == 1]
    many = b_kinds[left_g]
    which = np.repeat(np.arange(len(left_g)), many)
    right = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + b_first[left_g][which]
    pair = left_k[which] << _SHIFT | right_k[right]
    pair_times = left_t[which] * right_t[right]
    # Groups of one unit may share a pair; they are summed per text later.
    first = np.searchsorted(owner[left_g][which], np.arange(n + 1)) if n_groups else np.zeros(n + 1, np.int64)
    return Units(good, counts, text, first, pair, pair_times)


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their times summed."""
    order = np.argsort(key)
    key, times = key[order], times[order]
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    return key[heads], np.add.reduceat(times, heads) if len(heads) else times


@dataclass
class Pack:
    """Counts of each text, its groups as text, and its pairs (codes into ``pairs``) with times."""

    counts: dict[str, np.ndarray]
    text: list[str]
    first: np.ndarray
    code: np.ndarray
    times: np.ndarray
    pairs: np.ndarray
    holders: np.ndarray


def align_pack(texts: pa.Array, one: Side, other: Side) -> Pack:
    none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    texts = pc.fill_null(texts.cast(pa.large_string()), none)
    texts = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(none, texts, space))
    data, at = flat(texts)
    rows = len(texts)
    starts = _unit_starts(data, at)
    row = np.searchsorted(at, starts, side="right") - 1
    offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    every = pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(np.ascontiguousarray(data)))
    coded = every.dictionary_encode()
    unit = coded.indices.to_numpy().astype(np.int64)
    known = align_units(coded.dictionary, one, other)
    bad = np.zeros(rows, bool)
    bad[row[~known.good[unit]]] = True
    keep = ~bad[row]
    row, unit = row[keep], unit[keep]
    first = np.searchsorted(row, np.arange(rows + 1))
    counts = {c: per_text(known.counts[c][unit], first) for c in _COUNTS}
    unit_list = unit.tolist()
    text = ["".join([known.text[u] for u in unit_list[lo:hi]])[:-1] for lo, hi in zip(first, first[1:], strict=False)]

    key, often = np.unique(row << _SHIFT | unit, return_counts=True)
    doc, place = key >> _SHIFT, key & _MASK
    many = np.diff(known.first)[place]
    which = np.repeat(np.arange(len(doc)), many)
    at_pair = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + known.first[place][which]
    pairs, code = np.unique(known.pair, return_inverse=True)
    key, times = _summed(doc[which] << _SHIFT | code[at_pair], often[which] * known.times[at_pair])
    doc, code = key >> _SHIFT, key & _MASK
    holders = np.bincount(code, minlength=len(pairs))
    return Pack(counts, text, np.searchsorted(doc, np.arange(rows + 1)), code, times, pairs, holders)


def _lists(first: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def _aligned(docs: DataFrame, text_col: str, a_file: str, b_file: str, kept: list[str]) -> DataFrame:
    """Rows of texts (``pairs`` null), and one row a pack with its pairs and their holders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = byte_side(a_file), piece_side(b_file)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch, text_col, PACK_BYTES):
                found = align_pack(piece.column(piece.schema.get_field_index(text_col)), one, other)
                columns = {f"k_{c}": piece.column(piece.schema.get_field_index(c)) for c in kept}
                columns |= {c: pa.array(found.counts[c], pa.int64()) for c in _COUNTS}
                columns["groups_sha256"] = pa.array(
                    [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in found.text], pa.string()
                )
                columns["code"] = _lists(found.first, found.code, pa.int32())
                columns["times"] = _lists(found.first, found.times, pa.int64())
                rows = piece.num_rows
                columns["pack"] = pa.array(np.full(rows, number), pa.int64())
                columns["pairs"] = pa.nulls(rows, pa.list_(pa.int64()))
                columns["holders"] = pa.nulls(rows, pa.list_(pa.int64()))
                yield pa.record_batch(columns)
                listed = {name: pa.nulls(1, column.type) for name, column in columns.items()}
                listed["pack"] = pa.array([number], pa.int64())
                for name, values in (("pairs", found.pairs), ("holders", found.holders)):
                    listed[name] = _lists(np.array([0, len(values)]), values, pa.int64())
                yield pa.record_batch(listed)
                number += 1

    schema = T.StructType(
        [T.StructField(f"k_{c}", docs.schema[c].dataType) for c in kept]
        + [T.StructField(c, T.LongType()) for c in _COUNTS]
        + [T.StructField("groups_sha256", T.StringType())]
        + [T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.LongType()))]
        + [T.StructField("pack", T.LongType())]
        + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "holders")]
    )
    return docs.select(*dict.fromkeys([*kept, text_col])).mapInArrow(run, schema)


def _entries(aligned: DataFrame) -> DataFrame:
    """``in_pack, code, pair, holders`` of each distinct pair of a pack."""
    zipped = F.posexplode(F.arrays_zip("pairs", "holders")).alias("code", "entry")
    return aligned.filter("pairs is not null").select(F.col("pack").alias("in_pack"), zipped).select(
        "in_pack", "code", F.col("entry.pairs").alias("pair"), F.col("entry.holders").alias("holders")
    )


def _totals(entries: DataFrame) -> DataFrame:
    """``pair``, the texts of the whole table that hold it, and whether no other pair of its A id
    is held by more. An A id has as many pairs as B has ids at most."""
    sums = entries.groupBy("pair").agg(F.sum("holders").alias("total"))
    of_a = Window.partitionBy(F.shiftright("pair", _SHIFT))
    return sums.withColumn("best", F.col("total") == F.max("total").over(of_a))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a_id, b_id, documents, best`` of every pair of ids that a text holds linked."""
    return _totals(_entries(aligned)).select(
        F.shiftright("pair", _SHIFT).cast("int").alias("a_id"),
        F.col("pair").bitwiseAND(F.lit(_MASK)).cast("int").alias("b_id"),
        F.col("total").alias("documents"), "best",
    )


def align(
    docs: DataFrame, a_file: str, b_file: str, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) with the numbers of tokens, groups and links of each text,
    ``groups_sha256`` of its groups as ``a1,a2|b1;a3|b2``, ``n_best`` (links whose pair is the
    most frequent of its A id) and ``count_sum`` (the texts holding each link's pair, summed)."""
    added = [*_COUNTS, "n_best", "count_sum", "groups_sha256"]
    kept = [c for c in (keep or docs.columns) if c not in added]
    aligned = cut(_aligned(docs, text_col, a_file, b_file, kept), "aligned")
    entries = _entries(aligned)
    told = entries.select("in_pack", "code", "pair").join(_totals(entries), "pair").drop("pair")
    texts = aligned.filter("pairs is null").drop("pairs", "holders")

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        total = np.zeros(right.num_rows, np.int64)
        best = np.zeros(right.num_rows, bool)
        at = right["code"].to_numpy()
        total[at], best[at] = right["total"].to_numpy(), right["best"].to_numpy()
        left = left.combine_chunks()
        code, times = (left[c].combine_chunks() for c in ("code", "times"))
        first = code.offsets.to_numpy().astype(np.int64)
        first, code, times = first - first[0], code.flatten().to_numpy(), times.flatten().to_numpy()
        sums = {"n_best": per_text(times * best[code], first), "count_sum": per_text(times * total[code], first)}
        columns = {c: left[f"k_{c}"] for c in kept} | {c: left[c] for c in [*_COUNTS, "groups_sha256"]}
        columns |= {c: pa.array(v, pa.int64()) for c, v in sums.items()}
        return pa.table({c: columns[c] for c in [*kept, *added]})

    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [T.StructField(c, T.LongType()) for c in added[:-1]]
        + [T.StructField("groups_sha256", T.StringType())]
    )
    return texts.groupBy("pack").cogroup(told.groupBy("in_pack")).applyInArrow(joined, schema)
