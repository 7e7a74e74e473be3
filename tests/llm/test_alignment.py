"""Alignment of two tokenizers, against whole texts encoded one by one."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from footfall.llm import alignment
from footfall.llm.queries import model_file, op13_alignment
from footfall.llm.tables import table
from tests.llm.helpers import ODD, SF, documents

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
FILES = model_file(A_FILE), model_file(B_FILE)
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(FILES[0])
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def spelled(text, one, other):
    """Ids and byte strings of both sides, or nothing if either does not spell the text."""
    if not text:
        return [], []
    letters = alignment._bytes_of_letters()
    e = one.encode(" " + text, add_special_tokens=False)
    a = [(k, bytes(letters[c] for c in token)) for k, token in zip(e.ids, e.tokens, strict=True)]
    b = []
    for k in other.encode(text):
        piece = other.id_to_piece(k)
        b.append((k, bytes([int(piece[1:-1], 16)]) if other.is_byte(k) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    return a, b


def ends(tokens):
    at, out = 0, []
    for _, data in tokens:
        at += len(data)
        out.append(at)
    return out


def expected(texts):
    one, other = encoders()
    groups = []
    for text in texts:
        a, b = spelled(text, one, other)
        cuts = sorted(set(ends(a)) & set(ends(b)))
        parts = []
        for side in (a, b):
            own = [[] for _ in cuts]
            for (k, _), end in zip(side, ends(side), strict=True):
                own[bisect_left(cuts, end)].append(k)
            parts.append(own)
        groups.append(list(zip(*parts, strict=True)))
    links = [Counter((x, y) for left, right in own for x in left for y in right) for own in groups]
    held = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for own, pairs in zip(groups, links, strict=True):
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in own)
        out.append((
            sum(len(left) for left, _ in own), sum(len(right) for _, right in own), len(own), sum(pairs.values()),
            sum(n for p, n in pairs.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in pairs.items()),
            hashlib.sha256(text.encode()).hexdigest() if own else "",
        ))
    return out, held


TEXTS = [
    *ODD, "x ", "  two  spaces   here ", "tab\tline\nend\r\n", "<s>hi</s> <|endoftext|> <unk> <0x41>", "a▁b", "▁",
    "Ein Größe été déjà Ünï", "emoji 👩‍👩‍👧 and 日本語テキスト です", "don't we'll I'm", " nbsp　wide space",
    "1234567 89.5% $$$ ### ---- ====", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ﬁne ligature", "é combining",
    "def f(x):\n    return x  # comment\n\n\n", " leading", "\n\n \n", "Ñandú Ñandú", "﻿mark", "é a à b ÿ c × d",
]


def test_against_whole_texts(spark):
    want, held = expected(TEXTS)
    docs = documents(spark, TEXTS)
    out = alignment.align(docs, *FILES)
    assert out.columns == ["doc_id", "text", "lang", "n_words", "items", "score", *COLUMNS]
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in out.collect()}
    for k, text in enumerate(TEXTS):
        assert got[k] == want[k], text
    assert sum(not w[0] for w in want) >= 4  # null, empty, and two with U+2581
    counts = alignment.pair_counts(alignment._aligned(docs, "text", *FILES, []))
    assert {(r.a_id, r.b_id): r.documents for r in counts.collect()} == held


def test_random_texts_in_small_packs(spark, monkeypatch):
    monkeypatch.setattr(alignment, "PACK_BYTES", 200)
    draw = random.Random(5)
    signs = ["a", "b", "the", "Ü", "ß", " ", " ", " ", "  ", "\n", ".", "'s", "7", " ", "　", "日", "👍", "\x00", "\x85", "-"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(60))) for _ in range(150)]
    want, _ = expected(texts)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align(documents(spark, texts), *FILES).collect()}
    assert [got[k] for k in range(len(texts))] == want


def test_groups_by_hand():
    def side(ends):
        ends = np.array(ends)
        return np.arange(len(ends)), np.append(0, ends[:-1]), ends

    group, which, ids = alignment.groups_of(*side([2, 3, 6, 7, 9]), *side([2, 4, 6, 8, 9]))
    assert list(zip(group.tolist(), which.tolist(), ids.tolist(), strict=True)) == [
        (0, 0, 0), (0, 1, 0), (1, 0, 1), (1, 0, 2), (1, 1, 1), (1, 1, 2), (2, 0, 3), (2, 0, 4), (2, 1, 3), (2, 1, 4)]


def test_no_piece_crosses_a_word_start():
    """Units of B are whole words only if no piece has a space behind another character."""
    _, other = encoders()
    names = [other.id_to_piece(k) for k in range(other.vocab_size())]
    assert not [n for n in names if "▁" in n.lstrip("▁")]


def test_a_long_text_of_many_repeats(spark):
    text = "abc de" * 3000 + " the end" * 40_000 + "é" * 2000
    want, _ = expected([text])
    (row,) = alignment.align(documents(spark, [text]), *FILES).collect()
    assert tuple(row[c] for c in COLUMNS) == want[0]


def test_many_repeated_ids_in_one_group():
    """Links of a group are counted by distinct ids."""
    one = alignment.Side(lambda units: [[0] * 3000 for _ in units], [b"aa"])
    other = alignment.Side(lambda units: [[0, *[1] * 1999, 0] for _ in units], [b"a", b"aa" + b"a"])
    found = alignment.align_units(pa.array(["a" * 6000], pa.large_string()), one, other)
    assert not found.good[0]
    other = alignment.Side(lambda units: [[0, *[1] * 2999, 0] for _ in units], [b"a", b"aa"])
    found = alignment.align_units(pa.array(["a" * 6000], pa.large_string()), one, other)
    assert found.counts["n_groups"][0] == 1 and found.counts["n_links"][0] == 3000 * 3001
    assert sorted(zip(found.pair.tolist(), found.times.tolist(), strict=True)) == [(0, 6000), (1, 3000 * 2999)]


def test_empty_table_and_repeated_rows(spark):
    assert alignment.align(documents(spark, ["a"]).limit(0), *FILES).collect() == []
    docs = documents(spark, ["some text", "some text", None])
    want, _ = expected(["some text"] * 4)
    got = alignment.align(docs.unionByName(docs), *FILES, keep=["text"]).filter("text is not null").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == want




def test_the_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    want, _ = expected(list(texts.values()))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op13_alignment(spark, SF).collect()}
    assert got == dict(zip(texts, want, strict=True))


def test_both_encoders_of_a_give_the_same_ids():
    """Every entry of the vocabulary, and random strings of settled letters."""
    side, (one, _) = alignment.byte_side(FILES[0]), encoders()
    draw = random.Random(9)
    units = [s.decode() for s in side.spelled if s.isascii()]
    signs = [chr(c) for c in range(768)] + list(" aeiou'st\n") * 20
    units += ["".join(draw.choice(signs) for _ in range(draw.randrange(1, 30))) for _ in range(20_000)]
    want = [e.ids for e in one.encode_batch_fast(units, add_special_tokens=False)]
    assert side.encode(units) == want
