"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text becomes ``▁`` for the start and for each space, and is cut into marked words: marks
followed by other characters. No piece goes past the end of such a word, so the best path
of a text is the chain of its words' best paths. Arrow numbers the distinct words of a run of texts
and sorts them; walking them in order is a depth-first walk of their trie: the forward scores of the characters a
word shares with the one before are reused, and only the rest is computed. Each prefix has its last
piece only, so memory is linear in the longest word.

The best path has the highest sum of piece scores; of equal ones, the one whose last piece
is longer (then the same for what is before it). A character that no piece covers costs
``min score - 10`` and is written as its bytes. Null and the empty text have no pieces and decode
to the empty text; every other text decodes to itself, but for ``▁`` itself, which is read as
a space, as the library does.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from footfall.llm.arrays import flat, pieces
from footfall.llm.tables import trimmed

MARK = "▁"
#: Bytes of text whose words are told apart in one go; a longer text is taken by itself.
RUN_BYTES = 2 << 20
#: Words whose ids are put together in one go, one text's at least.
JOINED_WORDS = 1 << 18
#: Lists of ids decoded in one go.
DECODED_LISTS = 256


class Pieces:
    """Vocabulary of a SentencePiece model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        scores = [model.get_score(i) for i in range(size)]
        plain = [i for i in range(size) if i not in special]
        self.scores = {self.names[i]: scores[i] for i in plain}
        self.ids = {self.names[i]: i for i in plain}
        self.unknown = min(self.scores.values(), default=0.0) - 10.0
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.packed = {name: i.to_bytes(4, sys.byteorder) for name, i in self.ids.items()}
        self.special = special - set(self.byte_ids)
        self.bodies: np.ndarray | None = None

    @cached_property
    def by_end(self) -> dict[str, tuple]:
        """Trie of the pieces read from their ends, a space for each mark: a character leads to
        (what may stand to its left, score and packed id of the piece that begins here). It is the
        larger part of a model's memory, and decoding does without."""
        root: dict = {}
        for name in self.ids:
            node = root
            for char in reversed(name.replace(MARK, " ")):
                node = node.setdefault(char, {})
            node[""] = name

        def closed(node: dict) -> dict[str, tuple]:
            out = {}
            for char, below in node.items():
                name = below.pop("", None)
                out[char] = (closed(below) or None, self.scores.get(name), self.packed.get(name))
            return out

        return closed(root)

    def encode_sorted(self, words: Iterable[str]) -> list[bytes]:
        """The best path (ids as packed 32-bit numbers) of each word, a space for each mark;
        words come in ascending order."""
        best = [0.0]  # best score of each prefix of the current word,
        back = [0]  # where its last piece begins,
        tail: list[bytes] = [b""]  # and the ids of that piece
        before = ""
        ending, unknown = self.by_end.get, self.unknown
        out = []
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], back[shared + 1 :], tail[shared + 1 :]
            for last in range(shared, len(word)):
                begin = at = last
                top, ids = best[last] + unknown, None
                found = ending(word[last])
                while found is not None:
                    more, score, packed = found
                    if score is not None:
                        score += best[begin]
                        if score >= top:
                            top, at, ids = score, begin, packed
                    if more is None or not begin:
                        break
                    begin -= 1
                    found = more.get(word[begin])
                if ids is None:
                    ids = np.array([self.byte_ids[b] for b in word[last].encode()], np.int32).tobytes()
                best.append(top)
                back.append(at)
                tail.append(ids)
            at, parts = len(word), []
            while at:
                parts.append(tail[at])
                at = back[at]
            parts.reverse()
            out.append(b"".join(parts))
            before = word
        return out

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of the lists ``ids[ends[k]:ends[k + 1]]``."""
        if self.bodies is None:
            bodies = [self._body(i) for i in range(len(self.names))]
            self.body_at = np.concatenate([[0], np.cumsum([len(b) for b in bodies])])
            self.bodies = np.frombuffer(b"".join(bodies), np.uint8)
        known = (ids >= 0) & (ids < len(self.names))
        low = self.body_at[np.where(known, ids, 0)]
        size = np.where(known, self.body_at[np.where(known, ids, 0) + 1] - low, 0)
        at = np.concatenate([[0], np.cumsum(size)])
        data = self.bodies[np.repeat(low - at[:-1], size) + np.arange(at[-1])].tobytes()
        out = []
        for a, b in zip(at[ends[:-1]], at[ends[1:]], strict=True):
            if data[a : a + 1] == b" " and a < b:
                a += 1
            out.append(data[a:b].decode("utf-8", "replace"))
        return out

    def _body(self, i: int) -> bytes:
        if i in self.bytes_of:
            return bytes([self.bytes_of[i]])
        return b"" if i in self.special else self.names[i].replace(MARK, " ").encode()


@cache
def load(model_file: str) -> Pieces:
    return Pieces(model_file)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The marked words of all texts, a space for each mark, and where each text's words begin."""
    texts = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
    data, at = flat(texts)
    space = data == 32
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[at[:-1][np.diff(at) > 0]] = True
    begin = np.flatnonzero(begins)
    offsets = np.append(begin, len(data)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    return words, np.searchsorted(begin, at)


def encode_column(texts: pa.Array, model: Pieces) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(row, end row, ids, where each text's ids begin)`` of runs of texts."""
    words, first = _words(texts)
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    bodies = model.encode_sorted(coded.dictionary.take(order).to_pylist())
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) // 4
    begins = np.cumsum(sizes) - sizes
    all_ids = np.frombuffer(b"".join(bodies), np.int32)
    place = np.empty(len(order), np.int64)  # of each distinct word in ascending order
    place[order.to_numpy()] = np.arange(len(order))
    number = coded.indices.to_numpy()
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(first, first[row] + JOINED_WORDS, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        own = place[number[first[row] : first[end]]]
        size = sizes[own]
        at = np.concatenate([[0], np.cumsum(size)])
        ids = all_ids[np.repeat(begins[own] - at[:-1], size) + np.arange(at[-1])]
        yield row, end, ids, at[first[row : end + 1] - first[row]]
        row = end


def encode_texts(texts: list[str | None], model: Pieces) -> list[np.ndarray]:
    """Ids of each text."""
    runs = encode_column(pa.array(texts, pa.string()), model)
    return [ids[a:b] for _, _, ids, ends in runs for a, b in zip(ends.tolist(), ends[1:].tolist())]


def _decoded(ids: np.ndarray, ends: np.ndarray, model: Pieces) -> pa.Array:
    texts = []
    for begin in range(0, len(ends) - 1, DECODED_LISTS):
        own = ends[begin : begin + DECODED_LISTS + 1]
        texts += model.decode_all(ids[own[0] : own[-1]], own - own[0])
    return pa.array(texts, pa.string())


def encode(
    docs: DataFrame,
    model_file: str,
    text_col: str = "text",
    out: str = "piece_ids",
    keep: list[str] | None = None,
    back: str | None = None,
) -> DataFrame:
    """``keep`` (all columns but ``out`` and ``back`` by default) and the ids of the text. No shuffle.

    ``back`` names a column for the text that these ids decode to, as :func:`decode` gives it, but
    by the same worker: two steps in Python in a row keep twice the workers and models."""
    new = [out, *([back] if back else [])]
    kept = [c for c in (keep or docs.columns) if c not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_file)
        for batch in batches:
            for part in pieces(batch, text_col, RUN_BYTES):
                for row, end, ids, ends in encode_column(part.column(part.schema.get_field_index(text_col)), model):
                    yield pa.record_batch(
                        [
                            *(part.column(part.schema.get_field_index(c)).slice(row, end - row) for c in kept),
                            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                            *([_decoded(ids, ends, model)] if back else []),
                        ],
                        names=[*kept, *new],
                    )

    types = f"`{out}` array<int>" + (f", `{back}` string" if back else "")
    schema = StructType([docs.schema[c] for c in kept] + StructType.fromDDL(types).fields)
    needed = list(dict.fromkeys([*kept, text_col]))
    return docs.select(*needed).mapInArrow(trimmed(run), schema)


def decode(df: DataFrame, model_file: str, ids_col: str = "piece_ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but ``out`` by default) and the text of the ids; null ids give
    the empty text."""
    kept = [c for c in (keep or df.columns) if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_file)
        for batch in batches:
            for begin in range(0, batch.num_rows, DECODED_LISTS):
                part = batch.slice(begin, DECODED_LISTS)
                lists = part.column(part.schema.get_field_index(ids_col))
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
                texts = model.decode_all(lists.flatten().to_numpy(zero_copy_only=False), ends)
                yield pa.record_batch(
                    [*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(texts, pa.string())],
                    names=[*kept, out],
                )

    schema = StructType([df.schema[c] for c in kept] + StructType.fromDDL(f"`{out}` string").fields)
    return df.mapInArrow(trimmed(run), schema)
