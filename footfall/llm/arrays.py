"""Whole-batch text helpers: word and window hashes of many texts at once, with numpy.

Texts stay UTF-8 bytes in the Arrow buffer they arrive in; nothing here loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled in one go; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(20240517).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_tables = {"pow": np.ones(1, np.uint64), "inv": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables["pow"]) < n:
        size = max(n, 2 * PIECE_BYTES)
        for name, base in (("pow", _BASE), ("inv", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _tables[name] = np.multiply.accumulate(factors)
    return _tables["pow"][:n], _tables["inv"][:n]


def forget_powers() -> None:
    """Free the tables of powers; they are made anew when they are needed."""
    _tables.update(pow=np.ones(1, np.uint64), inv=np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(is_word) -> np.ndarray:
    """Byte to its lower-case word byte, 0 for a separator. 255 never occurs in
    UTF-8, so it stands in for a zero byte that belongs to a word."""
    lower = np.arange(256)
    lower[65:91] += 32
    lower[0] = 255
    return np.where([is_word(b) for b in range(256)], lower, 0).astype(np.uint8)


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z in lower case.
ALNUM = _table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
#: ``[^\x20\x09-\x0D]+`` of the text with A-Z in lower case.
NON_SPACE = _table(lambda b: b != 32 and not 9 <= b <= 13)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return body, at - at[0]


def pieces(batch: pa.RecordBatch, text: str, max_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about ``max_bytes`` of text."""
    _, at = flat(batch.column(batch.schema.get_field_index(text)))
    begin, rows = 0, batch.num_rows
    while begin < rows:
        end = int(np.searchsorted(at, at[begin] + max_bytes, side="right")) - 1
        end = min(max(end, begin + 1), rows)
        yield batch.slice(begin, end - begin)
        begin = end


@dataclass
class Words:
    """Words of several texts: byte span, text number and 64-bit hash of each.
    ``first[i]:first[i + 1]`` are the words of text ``i``; ``stem``: the hash of each word's first
    bytes, if asked for."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    stem: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def hash_words(data: np.ndarray, at: np.ndarray, table: np.ndarray = ALNUM, stem: int = 0) -> Words:
    low = table[data]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low != 0
    edge = np.zeros(len(low) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    power, inverse = _powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_CODES[low] * power[:-1], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    first = np.searchsorted(starts, at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    stems = mix((sums[np.minimum(ends, starts + stem)] - sums[starts]) * inverse[starts]) if stem else None
    return Words(starts, ends, text, hashes, first, stems)


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start (word number) and hash of every run of ``size`` words within one text."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(_BASE) + words.hash[k : k + n]
    at = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
    return at, mix(total[at])


def byte_window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``data[i:i + size]`` for every i; windows may cross texts."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * power[:-1], out=sums[1:])
    n = len(data) - size + 1
    return mix((sums[size:] - sums[:n]) * inverse[:n])


def decoded(data: np.ndarray, at: np.ndarray, row: int) -> str:
    return data[at[row] : at[row + 1]].tobytes().decode("utf-8", "replace")


def per_text(values: np.ndarray, first: np.ndarray, ufunc=np.add) -> np.ndarray:
    """``ufunc`` over each text's values, 0 for a text without any."""
    out = np.zeros(len(first) - 1, values.dtype)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = ufunc.reduceat(values, first[:-1][full])
    return out
