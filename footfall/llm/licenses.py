"""License scans: exact phrases and fuzzy short notices.

A notice may differ from the text by up to ``errors`` edits (characters put in, left out or
replaced). It is split into ``errors + 1`` seeds: by the pigeonhole principle one of them occurs
unchanged in any such copy. Seeds are searched exactly; around each hit the regex library's
bounded-error matching verifies the copy and reports its span and its errors.

Null counts as the empty text, which has no words and no labels. Spans are in code points.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from footfall.llm.arrays import ALNUM, Words, flat, hash_words, per_text, pieces

# Phrases whose words stand for a license, and short notices of one.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
NOTICES = [
    ("released under the mit license", "mit", 3),
    ("licensed under the mit license", "mit", 3),
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit", 6),
    ("licensed under the apache license, version 2.0", "apache", 4),
    ("this work is licensed under the gnu general public license, version 3", "gpl", 6),
    ("gnu general public license as published by the free software foundation", "gpl", 6),
    ("gnu lesser general public license", "lgpl", 2),
    ("licensed under cc by-nc 4.0", "cc-by-nc", 2),
    ("licensed under cc by-sa 4.0", "cc-by-sa", 1),
    ("licensed under cc by 4.0", "cc-by", 1),
    ("creative commons attribution-noncommercial 4.0 international", "cc-by-nc", 5),
    ("creative commons attribution 4.0 international", "cc-by", 3),
    ("redistribution and use in source and binary forms, with or without modification", "bsd", 6),
    ("mozilla public license, version 2.0", "mpl", 3),
    ("eclipse public license", "epl", 2),
    ("spdx-license-identifier: mit", "mit", 1),
    ("spdx-license-identifier: apache-2.0", "apache", 1),
    ("spdx-license-identifier: gpl-3.0", "gpl", 1),
    ("all rights reserved.", "proprietary", 1),
]
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def seeds(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of the notice with their places; every copy within
    ``errors`` edits holds one of them unchanged."""
    parts = errors + 1
    cuts = [len(notice) * k // parts for k in range(parts + 1)]
    return [(low, notice[low:high]) for low, high in zip(cuts, cuts[1:], strict=False)]


@cache
def _plan() -> tuple[list[tuple], dict[bytes, list[tuple[int, int]]]]:
    rules, by_seed = [], {}
    for number, (notice, label, errors) in enumerate(NOTICES):
        body = regex.escape(notice, literal_spaces=True)
        levels = [regex.compile(f"(?:{body}){{e<={n}}}") for n in range(errors + 1)]
        rules.append((notice, label, errors, levels))
        for place, seed in seeds(notice, errors):
            by_seed.setdefault(seed.encode(), []).append((number, place))
    return rules, by_seed


def _copies(text: str, levels: list) -> list[tuple[int, int, int]]:
    """``(start, end, errors)`` of all copies in a text, those with the fewest errors first and
    from left to right: what is between them holds no copy of fewer errors, so one pass for each
    number of errors finds the rest."""
    if not levels[-1].search(text):
        return []
    found, gaps = [], [(0, len(text))]
    for level in levels:
        left = []
        for low, high in gaps:
            for m in level.finditer(text, low, high):
                found.append((m.start(), m.end(), sum(m.fuzzy_counts)))
                left.append((low, m.start()))
                low = m.end()
            left.append((low, high))
        gaps = [g for g in left if g[0] < g[1]]
    return found


def fuzzy_notices(low: bytes) -> list[tuple[int, int, str, int]]:
    """``(start, end, label, errors)`` of notices in a lower-cased UTF-8 text, in code
    points, by start; of overlapping finds of one label the one with fewest errors."""
    rules, by_seed = _plan()
    windows: dict[int, list[list[int]]] = {}
    for seed, uses in by_seed.items():
        at = low.find(seed)
        while at >= 0:
            for number, place in uses:
                notice, _, errors, _ = rules[number]
                # a code point takes up to four bytes
                begin = max(0, at - 4 * (place + errors))
                end = min(len(low), at + 4 * (len(notice) - place + errors))
                open_ = windows.setdefault(number, [])
                open_.append([begin, end])
            at = low.find(seed, at + 1)
    if not windows:
        return []
    # Code points before each byte.
    places = np.zeros(len(low) + 1, np.int32)
    np.cumsum(np.frombuffer(low, np.uint8) & 0xC0 != 0x80, out=places[1:])
    found = []
    for number, spans in windows.items():
        _, label, _, levels = rules[number]
        spans.sort()
        merged = [spans[0]]
        for begin, end in spans[1:]:
            if begin <= merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([begin, end])
        for begin, end in merged:
            while begin and low[begin] & 0xC0 == 0x80:
                begin -= 1
            while end < len(low) and low[end] & 0xC0 == 0x80:
                end += 1
            base = int(places[begin])
            text = low[begin:end].decode("utf-8", "replace")
            found += [(base + start, base + stop, label, errors) for start, stop, errors in _copies(text, levels)]
    return _best(found)


def _best(found: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    kept: dict[str, list[tuple]] = {}  # by start; finds of one label do not overlap
    for hit in sorted(found, key=lambda h: (h[3], h[0] - h[1], h[0])):
        own = kept.setdefault(hit[2], [])
        at = bisect_left(own, hit[0], key=lambda k: k[0])
        if (at == 0 or own[at - 1][1] <= hit[0]) and (at == len(own) or hit[1] <= own[at][0]):
            own.insert(at, hit)
    return sorted(h for own in kept.values() for h in own)


@cache
def _phrase_hashes() -> list[tuple[np.ndarray, str]]:
    out = []
    for phrase, label in PHRASES.items():
        words = hash_words(*flat(pa.array([phrase], pa.string())), ALNUM)
        out.append((words.hash, label))
    return out


def phrase_places(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """``(first word, phrase number)`` of every place where a phrase stands."""
    starts, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for number, (phrase, _) in enumerate(_phrase_hashes()):
        n = len(words.hash) - len(phrase) + 1
        if n <= 0:
            continue
        at = np.flatnonzero(words.hash[:n] == phrase[0])
        for k in range(1, len(phrase)):
            at = at[words.hash[at + k] == phrase[k]]
        at = at[words.text[at] == words.text[at + len(phrase) - 1]]
        starts.append(at)
        numbers.append(np.full(len(at), number))
    start, number = np.concatenate(starts), np.concatenate(numbers)
    order = np.lexsort((number, start))
    return start[order], number[order]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the phrases' places and labels, the fuzzy notices with spans, all labels and a
    score: 1 for an exact phrase, else 1 less the share of edited characters of the best notice.
    No shuffle."""
    schema = (
        f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_words long, n_base long, first_word long, "
        "last_word long, base_labels string, labels string, score double, "
        "notices array<struct<start: int, end: int, label: string, errors: int>>"
    )
    names = [part.split()[0].strip("`") for part in schema.split(", ")][:8] + ["notices"]
    notice_type = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("errors", pa.int32())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels_of = [label for _, label in _phrase_hashes()]
        for batch in batches:
            for piece in pieces(batch, text_col):
                data, at = flat(piece.column(1))
                words = hash_words(data, at, ALNUM)
                start, number = phrase_places(words)
                text = words.text[start]
                edges = np.searchsorted(text, np.arange(piece.num_rows + 1))
                base = [sorted({labels_of[n] for n in number[a:b]}) for a, b in zip(edges, edges[1:], strict=False)]
                low = data.tobytes().translate(_LOWER)
                notices = [fuzzy_notices(low[a:b]) for a, b in zip(at, at[1:], strict=False)]
                own = start - words.first[text]
                full = np.diff(edges) > 0
                lowest, highest = per_text(own, edges, np.minimum), per_text(own, edges, np.maximum)
                yield pa.record_batch(
                    [
                        piece.column(0),
                        pa.array(words.counts, pa.int64()),
                        pa.array(np.diff(edges), pa.int64()),
                        pa.array(lowest, pa.int64(), mask=~full),
                        pa.array(highest, pa.int64(), mask=~full),
                        pa.array([",".join(b) for b in base], pa.string()),
                        pa.array(
                            [",".join(sorted({*b, *(n[2] for n in ns)})) for b, ns in zip(base, notices, strict=True)],
                            pa.string(),
                        ),
                        pa.array(
                            [1.0 if b else max((1 - n[3] / (n[1] - n[0]) for n in ns), default=0.0) for b, ns in zip(base, notices, strict=True)],
                            pa.float64(),
                        ),
                        pa.array([[dict(zip(("start", "end", "label", "errors"), n, strict=True)) for n in ns] for ns in notices], notice_type),
                    ],
                    names=names,
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
