"""N-gram Jaccard join by parity sketches.

A text is the set of its distinct word shingles, as 64-bit hashes. Two sets link when
``100 * |A & B| >= 75 * |A | B|``. Then their symmetric difference is at most
``(|A| + |B|) / 7``, which bounds the Hamming distance of parity sketches from above.

* **Sketch.** In a size band (sizes of one power of two) the elements are spread over ``m`` blocks;
  a block's value is the XOR of its elements' hashes. An element in only one of two sets changes
  one block, so two linked sets differ in at most ``T`` blocks: of any ``T + 1`` blocks of a set
  one is the same in the other (pigeonhole). A band also takes the sets just below it that can
  link into it.
* **Certificate.** A set of which ``T + 1`` blocks occur in no other set links with nothing. One
  packed shuffle of block values settles this for nearly all texts; their sets are never moved.
* **Rounds.** The rest are compared block by block. Sets that share a block with a leader are
  verified against it, and linked ones become one component. A block is then settled if its
  other sets are of one component.
* **Rare elements.** What still lacks ``T + 1`` settled blocks is compared by a second exact
  pigeonhole, over elements in one order, rare ones first. A set of ``n`` elements has at least
  ``3n / 4`` of them in common with any link, and ``6n / 7`` with one that is not smaller. So the
  first common element is among the first ``n // 4 + 1`` of the larger set and the first
  ``n // 7 + 1`` of the smaller one; texts of one template that differ by too much for a link meet
  in their template's elements only, which come last. An element that many sets have is
  cut into cells of at most about ``SLICE`` sets a side, spread by Spark. Sets of a cell are verified
  if their bit sketches are near enough. (Many sets that have the same elements in front are
  still compared each with each, cell by cell.)
* **Verification** counts the common elements exactly.

Equal sets are one node throughout. Null and empty texts, and rows with a null id, link with
nothing. Rows that share an id are one document: what links to any of them links to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from footfall.llm.arrays import NON_SPACE, flat, hash_words, mix, per_text, pieces, window_hashes
from footfall.llm.graph import connected
from footfall.llm.tables import cut, shuffle_partitions, trimmed

WORDS = 5
#: Links need 100 * common >= PERCENT * union; the bounds of the module are for 75.
PERCENT = 75
#: Blocks per needed block: room for blocks that are empty or common.
ROOM = 1.5
SPARE = 12
MAX_SKETCH_BITS = 1 << 15
#: Sets of one element on either side of a cell.
SLICE = 4000
#: Counters that put the elements in order: a hash of the element, so they are bounded.
COUNTERS = 1 << 22
#: Block keys of a part that are sorted at a time.
KEYS_AT_ONCE = 400_000
LOW_BITS = np.uint64(40)
_LOW = np.uint64((1 << 40) - 1)
_SALT = np.uint64(0xE7037ED1A0B428DB)
_MAX = np.int64((1 << 63) - 1)


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin."""
    words = hash_words(data, at, NON_SPACE)
    start, value = window_hashes(words, size)
    text = words.text[start]
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = []
        for row in short:
            total = np.uint64(0)
            for h in words.hash[words.first[row] : words.first[row + 1]]:
                with np.errstate(over="ignore"):
                    total = total * _SALT + h
            whole.append(total ^ np.uint64(counts[row]))
        text = np.concatenate([text, short])
        value = np.concatenate([value, mix(np.array(whole, np.uint64))])
        order = np.argsort(text, kind="stable")
        text, value = text[order], value[order]
    first = np.searchsorted(text, np.arange(len(at)))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.searchsorted(text[new], np.arange(len(at)))


def node_ids(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, the same for equal sets."""
    total = per_text(mix(sets ^ _SALT), first)
    return mix(total + np.diff(first).astype(np.uint64) * _SALT).view(np.int64)


def band_plan(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(set number, band, blocks)`` of each band that a set takes part in."""
    some = np.flatnonzero(sizes > 0)
    own = np.floor(np.log2(sizes[some] + 0.5)).astype(np.int64)
    above = 4 * sizes[some] >= 3 * (2 << own)
    number = np.concatenate([some, some[above]])
    band = np.concatenate([own, own[above] + 1])
    order = np.argsort(number, kind="stable")
    number, band = number[order], band[order]
    most = (2 * ((2 << band) - 1)) // 7
    return number, band, np.ceil(ROOM * (most + 1)).astype(np.int64) + SPARE


def needed(size, band):
    """Blocks that settle a set in a band: one more than its largest difference to a link."""
    partner = np.minimum((2 << band) - 1, 4 * size // 3)
    return (size + partner) // 7 + 1


def block_keys(
    sets: np.ndarray, first: np.ndarray, filled: dict[int, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(key, entry)`` of every block that is not empty, and ``(set number, band)`` of the
    entries, one for each band of each set. Blocks in ``filled`` (by band) have a key even
    where they are empty."""
    number, band, blocks = band_plan(np.diff(first))
    keys, entry = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    sizes = np.diff(first)[number]
    ends = np.cumsum(sizes)
    if len(number):
        element = np.repeat(first[number] - (ends - sizes), sizes) + np.arange(ends[-1])
        value = sets[element]
        whose = np.repeat(np.arange(len(number)), sizes)
        # Elements are sorted by hash, so blocks taken from the high bits are in order.
        block = ((value >> np.uint64(32)) * blocks[whose].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(value), bool)
        new[1:] = (block[1:] != block[:-1]) | (whose[1:] != whose[:-1])
        at = np.flatnonzero(new)
        parity = np.bitwise_xor.reduceat(mix(value * _SALT), at)
        place = (band[whose[at]].astype(np.uint64) << np.uint64(32)) | block[at]
        keys.append(mix(parity + mix(place)))
        entry.append(whose[at])
        full = np.unique((whose[at].astype(np.uint64) << np.uint64(32)) | block[at])
        for wide, extra in (filled or {}).items():
            rows = np.flatnonzero(band == wide).astype(np.uint64)
            pairs = np.add.outer(rows << np.uint64(32), extra.astype(np.uint64)).ravel()
            pairs = pairs[~np.isin(pairs, full)]
            place = np.uint64(wide << 32) | (pairs & np.uint64(0xFFFFFFFF))
            keys.append(mix(mix(place)))
            entry.append((pairs >> np.uint64(32)).astype(np.int64))
    keys, entry = np.concatenate(keys), np.concatenate(entry)
    if filled:
        order = np.argsort(entry, kind="stable")
        keys, entry = keys[order], entry[order]
    return keys, entry, number, band


def thin_blocks(sets: np.ndarray, first: np.ndarray) -> set[tuple[int, int]]:
    """``(band, block)`` of the empty blocks of sets that have fewer full blocks than
    they need: rare, but these have to be compared by empty blocks too."""
    number, band, blocks = band_plan(np.diff(first))
    _, entry, *_ = block_keys(sets, first)
    full = np.bincount(entry, minlength=len(number))
    out = set()
    for k in np.flatnonzero(full < needed(np.diff(first)[number], band)):
        own = sets[first[number[k]] : first[number[k] + 1]]
        block = ((own >> np.uint64(32)) * np.uint64(blocks[k])) >> np.uint64(32)
        out |= {(int(band[k]), int(b)) for b in np.setdiff1d(np.arange(blocks[k], dtype=np.uint64), block)}
    return out


# --- packed shuffle of block keys -----------------------------------------------------------

_PACKED = "low4 binary, low1 binary, counts binary, nodes binary, comps binary, sizes binary, bands binary, weights binary"
_NAMES = [p.split()[0] for p in _PACKED.split(", ")]


def _pack(keys: np.ndarray, entry: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[tuple]:
    """``(part, low4, low1, counts, *columns)``: the keys of one part, in order of their entries,
    the number of keys of each entry there, and the entries' values."""
    part = ((keys >> LOW_BITS) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    keys, entry, part = keys[order] & _LOW, entry[order], part[order]
    edges = np.searchsorted(part, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[p], edges[p + 1]
        own = entry[a:b]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        yield (
            p,
            (keys[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
            (keys[a:b] >> np.uint64(32)).astype(np.uint8).tobytes(),
            _planes(np.diff(np.append(starts, b - a))),
            *(c[own[starts]].tobytes() for c in columns),
        )


def _planes(counts: np.ndarray) -> bytes:
    """32-bit counts, their lowest bytes first and their highest last: most are small, so what
    is sent shrinks to a byte each."""
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(rows: list[bytes]) -> np.ndarray:
    return np.concatenate([np.frombuffer(r, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel() for r in rows])


class _Part:
    """What reached one task: the nodes' entries (one for each band), and their keys."""

    def __init__(self, rows: list[tuple]):
        def column(k: int, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(r[k + 1], kind) for r in rows])

        lengths = np.array([len(r[2]) for r in rows])
        self.prefix = np.repeat(np.array([r[0] for r in rows], np.uint32), lengths)
        self.low4, self.low1 = column(0, np.uint32), column(1, np.uint8)
        node, comp, size, band = column(3, np.int64), column(4, np.int64), column(5, np.uint32), column(6, np.uint8)
        # One entry for a node in a band, however many copies of its text there are.
        code = mix(node.view(np.uint64) + band.astype(np.uint64) * _SALT)
        _, where, same = np.unique(code, return_index=True, return_inverse=True)
        self.node, self.comp, self.size, self.band = node[where], comp[where], size[where], band[where]
        # Leaders: the largest weight first, then by a hash.
        self.lead = ((np.uint64(0xFFFF) - column(7, np.uint16)[where].astype(np.uint64)) << np.uint64(48))
        self.entry_of = np.repeat(same.astype(np.int32), _from_planes([r[3] for r in rows]))

    def groups(self) -> Iterator[_Groups]:
        """The keys in ranges, so that one range's arrays are in memory at a time."""
        turns = max(1, -(-len(self.low4) // KEYS_AT_ONCE))
        for turn in range(turns):
            own = slice(None) if turns == 1 else np.flatnonzero(self.low4 % np.uint32(turns) == turn)
            key = self.low4[own].astype(np.uint64) | (self.low1[own].astype(np.uint64) << np.uint64(32))
            key |= self.prefix[own].astype(np.uint64) << LOW_BITS
            if len(key):
                yield _Groups(self, key, self.entry_of[own])


class _Groups:
    """Keys of a part, equal ones together."""

    def __init__(self, part: _Part, key: np.ndarray, entry: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.part, self.key, self.entry = part, key[order], entry[order]
        self.starts = np.flatnonzero(np.concatenate([[True], self.key[1:] != self.key[:-1]]))
        self.lengths = np.diff(np.append(self.starts, len(key)))

    def block_ids(self) -> np.ndarray:
        return self.key[self.starts].view(np.int64)

    def settled(self, rest: np.ndarray | None = None) -> np.ndarray:
        """Which groups hold sets of one component only; of their members only ``rest`` counts."""
        comp = self.part.comp[self.entry]
        low, high = (comp, comp) if rest is None else (np.where(rest, comp, _MAX), np.where(rest, comp, ~_MAX))
        return np.minimum.reduceat(low, self.starts) >= np.maximum.reduceat(high, self.starts)

    def leaders(self, turn: int) -> np.ndarray:
        """Which keys belong to the leader of their group in this turn: one node of the group,
        the same in every round."""
        rank = mix(self.part.node[self.entry].view(np.uint64) ^ np.uint64(turn)) >> np.uint64(16)
        rank |= self.part.lead[self.entry] if turn == 1 else np.uint64(0)
        return rank == np.repeat(np.minimum.reduceat(rank, self.starts), self.lengths)

    def credits(self, settled: np.ndarray) -> np.ndarray:
        """Settled groups of each entry; copies of a text within a group count once."""
        member = np.repeat(settled, self.lengths)
        group = np.repeat(np.arange(len(self.starts)), self.lengths)[member]
        entries = len(self.part.node)
        pairs = np.unique(group * entries + self.entry[member])
        return np.bincount(pairs % entries, minlength=entries)


_ABOVE = np.uint64(1)


def _tags(node: np.ndarray, above: np.ndarray) -> np.ndarray:
    """What tells a node's two bands apart: the lowest bit of its id gives way."""
    return (node.view(np.uint64) & ~_ABOVE) | above.astype(np.uint64)


def _home(tags: np.ndarray, parts: int) -> np.ndarray:
    """The part where all about a node meets, from either of its tags or from its id."""
    return ((tags >> _ABOVE) % np.uint64(parts)).astype(np.int32)


_TAGGED = "low4 binary, low1 binary, counts binary, tags binary"


def _first_pass(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """Rows ``(id, n, node)`` of all documents and ``(n, node, band, missing)`` of all nodes that
    lack blocks of their own.

    With many parts a set's keys go to as many of them, so what goes with each key counts: only
    the set's tag. Sizes and the numbers of full blocks go once, with the document, and only
    the blocks that other sets have too are sent back."""
    kind = dict(docs.dtypes)[id_col]
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    doc_names = ["part", "id", "n", "node", "full", "wide"]
    doc = f"part int, id {kind}, n long, node long, full int, wide int"
    doc_types = [pa.int32(), id_type, pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def packed(rows: list[tuple], columns: int) -> list[pa.Array]:
        """Rows ``(part, *binary columns)`` beside the empty columns of documents."""
        part, *rest = list(zip(*rows, strict=True)) or [()] * (columns + 1)
        none = [pa.nulls(len(rows), t) for t in doc_types[1:]]
        return [pa.array(part, pa.int32()), *none, *(pa.array(c, pa.binary()) for c in rest)]

    def apart(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, list[tuple]]:
        """The documents of a batch and its packed rows."""
        is_doc = batch.column(6).is_null()
        sent = batch.filter(pc.invert(is_doc))
        columns = (sent.column(k).to_pylist() for k in (0, *range(6, batch.num_columns)))
        return batch.filter(is_doc), list(zip(*columns, strict=True))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*doc_names, "low4", "low1", "counts", "tags"]
        for batch in batches:
            held, base = [], 0
            for piece in pieces(batch, text_col):
                sets, first = shingle_sets(*flat(piece.column(1)))
                sizes, node = np.diff(first), node_ids(sets, first)
                bare = (sizes == 0) | piece.column(0).is_null().to_numpy(zero_copy_only=False)
                keys, entry, number, _ = block_keys(sets, first)
                above = np.diff(number, prepend=-1) == 0
                full = np.zeros((2, piece.num_rows), np.int32)
                full[above.astype(np.int64), number] = np.bincount(entry, minlength=len(number))
                yield pa.record_batch(
                    [
                        pa.array(_home(node.view(np.uint64), parts)), piece.column(0), pa.array(sizes, pa.int64()),
                        pa.array(node, pa.int64(), mask=bare), pa.array(full[0]), pa.array(full[1]),
                        *([pa.nulls(piece.num_rows, pa.binary())] * 4),
                    ],
                    names=names,
                )
                if bare.any():
                    kept = ~bare[number][entry]
                    keys, entry = keys[kept], entry[kept]
                held.append((keys, entry + base, _tags(node[number], above)))
                base += len(number)
            if held:
                keys, entry, tags = (np.concatenate(h) for h in zip(*held, strict=True))
                yield pa.record_batch(packed(list(_pack(keys, entry, parts, tags)), 4), names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows = [*doc_names, "tags", "shared"], []
        for batch in batches:
            own, sent = apart(batch)
            rows += sent
            yield pa.record_batch([*own.columns[:6], *([pa.nulls(own.num_rows, pa.binary())] * 2)], names=names)
        for part in sorted({r[0] for r in rows}):
            tags, shared = _shared_blocks([r[1:] for r in rows if r[0] == part])
            home = _home(tags, parts)
            order = np.argsort(home, kind="stable")
            edges = np.searchsorted(home[order], np.arange(parts + 1))
            back = [
                (p, tags[order[edges[p] : edges[p + 1]]].tobytes(), _planes(shared[order[edges[p] : edges[p + 1]]]))
                for p in np.flatnonzero(np.diff(edges)).tolist()
            ]
            yield pa.record_batch(packed(back, 2), names=names)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows, nodes = ["id", "n", "node", "band", "missing"], [], []
        for batch in batches:
            own, sent = apart(batch)
            rows += [r[1:] for r in sent]
            none = [pa.nulls(own.num_rows, t) for t in (pa.int32(), pa.int64())]
            yield pa.record_batch([*own.columns[1:4], *none], names=names)
            some = own.filter(own.column(3).is_valid())
            nodes.append(np.stack([some.column(k).to_numpy().astype(np.int64) for k in (2, 3, 4, 5)]))
        if nodes:
            node, size, band, missing = _lacking_own(np.concatenate(nodes, axis=1), rows)
            yield pa.record_batch(
                [pa.nulls(len(node), id_type), pa.array(size), pa.array(node), pa.array(band.astype(np.int32)), pa.array(missing)],
                names=names,
            )

    return (
        docs.select(id_col, text_col).mapInArrow(trimmed(emit), f"{doc}, {_TAGGED}")
        .repartitionById(parts, "part").mapInArrow(trimmed(count), f"{doc}, tags binary, shared binary")
        .repartitionById(parts, "part").mapInArrow(trimmed(total), f"id {kind}, n long, node long, band int, missing long")
    )


def _shared_blocks(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """``tag, shared``: how many keys of a set in a part's rows ``(low4, low1, counts, tags)`` other
    sets have too, where there are any. Copies of a text are one set."""
    low4, low1, sent = (np.frombuffer(b"".join(r[k] for r in rows), kind) for k, kind in ((0, np.uint32), (1, np.uint8), (3, np.uint64)))
    tags, same = np.unique(sent, return_inverse=True)
    entry_of = np.repeat(same.astype(np.int32), _from_planes([r[2] for r in rows]))
    shared = np.zeros(len(tags), np.int64)
    turns = max(1, -(-len(low4) // KEYS_AT_ONCE))
    for turn in range(turns):
        own = slice(None) if turns == 1 else np.flatnonzero(low4 % np.uint32(turns) == turn)
        key = low4[own].astype(np.uint64) | (low1[own].astype(np.uint64) << np.uint64(32))
        if len(key):
            order = np.argsort(key, kind="stable")
            key, entry = key[order], entry_of[own][order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            mixed = np.minimum.reduceat(entry, starts) < np.maximum.reduceat(entry, starts)
            member = np.repeat(mixed, np.diff(np.append(starts, len(key))))
            shared += np.bincount(entry[member], minlength=len(tags))
    some = shared > 0
    # Each copy of a text sent the same keys.
    return tags[some], (shared // np.bincount(same, minlength=len(tags)))[some]


def _lacking_own(docs: np.ndarray, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``node, size, band, missing`` of the nodes with fewer blocks of their own than they need;
    ``docs``: size, node and full blocks in both bands; ``rows``: tags and shared blocks."""
    _, where = np.unique(docs[1], return_index=True)
    docs = docs[:, where]
    number, band, _ = band_plan(docs[0])
    above = np.diff(number, prepend=-1) == 0
    size, node = docs[0][number], docs[1][number]
    full = docs[2 + above, number]
    if rows:
        tags, same = np.unique(np.frombuffer(b"".join(r[0] for r in rows), np.uint64), return_inverse=True)
        shared = np.bincount(same, _from_planes([r[1] for r in rows]), len(tags)).astype(np.int64)
        own = _tags(node, above)
        place = np.minimum(np.searchsorted(tags, own), len(tags) - 1)
        full = full - np.where(tags[place] == own, shared[place], 0)
    missing = needed(size, band) - full
    short = missing > 0
    return node[short], size[short], band[short], missing[short]


_CREDITS = "nodes binary, sizes binary, bands binary, credits binary"


def _packed_credits(part: _Part, credit: np.ndarray, parts: int) -> list[tuple]:
    """``(part, *packed columns)``: the credits of one part, dealt out by node."""
    goes = part.node % parts
    order = np.argsort(goes, kind="stable")
    edges = np.searchsorted(goes[order], np.arange(parts + 1))
    columns = (part.node, part.size.astype(np.uint32), part.band, credit.astype(np.uint32))
    return [
        (p, *(c[order[edges[p] : edges[p + 1]]].tobytes() for c in columns))
        for p in np.flatnonzero(np.diff(edges)).tolist()
    ]


def _lacking(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``node, size, band, missing`` where a node's credits are fewer than it needs."""
    kinds = (np.int64, np.uint32, np.uint8, np.uint32)
    node, size, band, credit = (np.concatenate([np.frombuffer(r[k], kind) for r in rows]) for k, kind in enumerate(kinds))
    code = mix(node.view(np.uint64) + band.astype(np.uint64) * _SALT)
    _, where, same = np.unique(code, return_index=True, return_inverse=True)
    node, size, band = node[where], size[where].astype(np.int64), band[where].astype(np.int32)
    missing = needed(size, band.astype(np.int64)) - np.bincount(same, credit, len(where)).astype(np.int64)
    short = missing > 0
    return node[short], size[short], band[short], missing[short]


#: Bits that tell which ids may be open, for each open one, and at most.
BITS, MAX_BITS = 16, 1 << 27


def _marks(ids: DataFrame) -> np.ndarray:
    """Bits in bytes, set where the hash of an id (column ``hash``) falls: no id is missed, and few
    others pass. At most 16 MB, however many ids there are."""
    bits = min(MAX_BITS, max(1 << 16, 1 << (BITS * ids.count()).bit_length()))
    wide = 1 << 16

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(batch.column(0).to_numpy().view(np.uint64) % np.uint64(bits)).astype(np.int64)
            edges = np.searchsorted(at, np.arange(0, bits + wide, wide))
            some = np.flatnonzero(np.diff(edges)).tolist()
            places = [(at[edges[p] : edges[p + 1]] % wide).astype(np.uint16).tobytes() for p in some]
            yield pa.record_batch([pa.array(some, pa.int32()), pa.array(places, pa.binary())], names=["part", "places"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(p, np.zeros(wide, bool))[np.frombuffer(places, np.uint16)] = True
        packed = [np.packbits(x).tobytes() for x in found.values()]
        yield pa.record_batch([pa.array(list(found), pa.int32()), pa.array(packed, pa.binary())], names=["part", "bits"])

    parts = shuffle_partitions(ids.sparkSession)
    marked = ids.select("hash").mapInArrow(trimmed(mark), "part int, places binary").repartition(parts, "part")
    out = np.zeros(bits // 8, np.uint8)
    for p, packed in marked.mapInArrow(trimmed(join), "part int, bits binary").collect():
        out[p * wide // 8 : (p + 1) * wide // 8] = np.frombuffer(packed, np.uint8)
    return out


def _open_sets(docs: DataFrame, id_col: str, text_col: str, reps: DataFrame) -> DataFrame:
    """``node, n, body`` (sorted 64-bit hashes) and ``weight`` of the nodes in ``reps``
    (``node, rep, weight``). Texts stay where they are: only the sets of ids that are
    marked as open are moved."""
    marks = docs.sparkSession.sparkContext.broadcast(_marks(reps.select(F.xxhash64("rep").alias("hash"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = marks.value
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) % np.uint64(8 * len(held))
            open_ = (held[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1
            for piece in pieces(batch.filter(pa.array(open_ == 1)), "text"):
                sets, first = shingle_sets(*flat(piece.column(1)))
                bodies = [sets[x:y].tobytes() for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.record_batch(
                    [
                        pa.array(node_ids(sets, first), pa.int64()), pa.array(np.diff(first), pa.int64()),
                        pa.array(bodies, pa.binary()),
                    ],
                    names=["node", "n", "body"],
                )

    texts = docs.select(F.xxhash64(id_col).alias("hash"), F.col(text_col).alias("text"))
    made = texts.mapInArrow(trimmed(run), "node long, n long, body binary")
    # Joined by node alone, so that copies meet without another shuffle.
    return made.join(reps.select("node", "weight"), "node").dropDuplicates(["node"])


def _sets_of(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, at = flat(bodies)
    return np.frombuffer(data.tobytes(), np.uint64), at // 8


def _thin_blocks(sets: DataFrame) -> dict[int, np.ndarray]:
    """`thin_blocks` of all open nodes, by band. Their number is bounded by the blocks of the
    bands and the tasks: it follows the longest text, not the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(set().union(*(thin_blocks(*_sets_of(batch.column(2))) for batch in batches)))
        yield pa.record_batch(
            [pa.array([b for b, _ in found], pa.int32()), pa.array([k for _, k in found], pa.int32())],
            names=["band", "block"],
        )

    rows = sets.select("node", "n", "body").mapInArrow(trimmed(run), "band int, block int").collect()
    out: dict[int, set[int]] = {}
    for band, block in rows:
        out.setdefault(band, set()).add(block)
    return {band: np.array(sorted(some)) for band, some in out.items()}


def _dealt(sets: DataFrame, parts: int, filled: dict[int, np.ndarray]) -> DataFrame:
    """The block keys of open nodes (``node, n, body, comp``), dealt out by part."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", *_NAMES]
        for batch in (b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500)):
            flat_sets, first = _sets_of(batch.column(2))
            keys, entry, number, band = block_keys(flat_sets, first, filled)
            node, size, comp, weight = (batch.column(k).to_numpy()[number] for k in (0, 1, 3, 4))
            values = (node, comp, size.astype(np.uint32), band.astype(np.uint8), weight.astype(np.uint16))
            rows = list(_pack(keys, entry, parts, *values))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.record_batch([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=names)

    picked = sets.select("node", "n", "body", "comp", "weight").mapInArrow(trimmed(emit), f"part int, {_PACKED}")
    return picked.repartitionById(parts, "part")


def _rows_of(batches: Iterator[pa.RecordBatch]) -> list[tuple]:
    return [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]


def _stars(dealt: DataFrame, parts: int, turn: int) -> DataFrame:
    """Pairs ``(a, b)`` of a leader and another component's node that share a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        rows = _rows_of(batches)
        for part, some in ((p, g) for p in ([_Part(rows)] if rows else []) for g in p.groups()):
            open_ = ~some.settled()
            own = np.repeat(open_, some.lengths)
            entry, lengths = some.entry[own], some.lengths[open_]
            group = np.repeat(np.arange(len(lengths)), lengths)
            node, comp, size = part.node[entry], part.comp[entry], part.size[entry].astype(np.int64)
            at = np.flatnonzero(some.leaders(turn)[own])
            leader = np.zeros(len(lengths), np.int64)
            leader[group[at]] = at  # copies of one node have one rank: any of them
            yield _pairs(node, comp, size, np.arange(len(node)), leader[group])

    return _distinct(dealt.mapInArrow(trimmed(_packing(run, parts)), _PAIRS), parts)


def _pairs(node, comp, size, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pairs of the members ``x`` and ``y`` that are of two components and can link."""
    fits = (comp[x] != comp[y]) & (100 * np.minimum(size[x], size[y]) >= PERCENT * np.maximum(size[x], size[y]))
    a, b = node[x[fits]], node[y[fits]]
    return np.stack([np.minimum(a, b), np.maximum(a, b)])


def _once(pair: np.ndarray) -> np.ndarray:
    """The columns of ``pair`` without repeats."""
    pair = pair[:, np.lexsort(pair)]
    new = np.ones(pair.shape[1], bool)
    new[1:] = (pair[:, 1:] != pair[:, :-1]).any(axis=0)
    return pair[:, new]


_PAIRS = "part int, a binary, b binary"
#: Pairs that a task holds before it passes them on.
PAIRS_AT_ONCE = 500_000


def _packing(run, parts: int):
    """Pairs found by ``run`` without repeats, packed by the part that they go to."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        pair = _once(np.concatenate(held, axis=1))
        part = (mix(pair[0].view(np.uint64) ^ mix(pair[1].view(np.uint64))) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        rows = [
            (p, pair[0][order[edges[p] : edges[p + 1]]].tobytes(), pair[1][order[edges[p] : edges[p + 1]]].tobytes())
            for p in np.flatnonzero(np.diff(edges)).tolist()
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        types = (pa.int32(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "a", "b"])

    def all_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for pair in run(batches):
            held.append(pair)
            count += pair.shape[1]
            if count > PAIRS_AT_ONCE:
                held = [_once(np.concatenate(held, axis=1))]
                count = held[0].shape[1]
                if 2 * count > PAIRS_AT_ONCE:
                    yield packed(held)
                    held, count = [], 0
        if held:
            yield packed(held)

    return all_


def _distinct(packed: DataFrame, parts: int) -> DataFrame:
    """``a, b``: every pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 0), np.int64)
        for batch in batches:
            more = np.stack([np.frombuffer(b"".join(batch.column(k).to_pylist()), np.int64) for k in (1, 2)])
            seen = _once(np.concatenate([seen, more], axis=1))
        yield pa.record_batch([pa.array(seen[0]), pa.array(seen[1])], names=["a", "b"])

    return packed.repartitionById(parts, "part").mapInArrow(trimmed(run), "a long, b long")


def _unsettled(dealt: DataFrame, parts: int, turns: int) -> DataFrame:
    """Nodes that lack settled blocks after that many turns of `_stars`."""

    def credit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows_of(batches)
        if rows:
            part = _Part(rows)
            total = np.zeros(len(part.node), np.int64)
            for some in part.groups():
                # Leaders have been compared with all others of their group.
                led = [some.leaders(t) for t in range(1, turns + 1)] or [np.zeros(len(some.key), bool)]
                total += some.credits(some.settled(~np.logical_or.reduce(led)))
            columns = list(zip(*_packed_credits(part, total, parts), strict=True))
            yield pa.record_batch(
                [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                names=["part", *(p.split()[0] for p in _CREDITS.split(", "))],
            )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r[1:] for r in _rows_of(batches)]
        if rows:
            yield pa.record_batch([pa.array(np.unique(_lacking(rows)[0]))], names=["node"])

    packed = dealt.mapInArrow(trimmed(credit), f"part int, {_CREDITS}")
    return packed.repartitionById(parts, "part").mapInArrow(trimmed(total), "node long")


def _slot(elements: np.ndarray) -> np.ndarray:
    return (mix(elements ^ _SALT) % np.uint64(COUNTERS)).astype(np.int64)


def _fronts(sets: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(element, set number, place)`` of the first ``n // 4 + 1`` elements of each set, by
    their counters and then by hash."""
    whose = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((sets, counts[_slot(sets)], whose))
    place = np.arange(len(sets)) - first[whose]
    front = place <= np.diff(first)[whose] // 4
    return sets[order][front], whose[front], place[front]


def _counters(sets: DataFrame, parts: int, order=None) -> np.ndarray:
    """Sets that have an element, by the element's slot; with ``order`` (a broadcast of these
    counters) only the sets that have it among their first ``n // 7 + 1``. A counter is shared by
    several elements; it bounds the count of each from above."""
    pieces_ = 64
    wide = COUNTERS // pieces_

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            elements, first = _sets_of(batch.column(0))
            if order is not None:
                elements, whose, place = _fronts(elements, first, order.value)
                elements = elements[place <= np.diff(first)[whose] // 7]
            slot, n = np.unique(_slot(elements), return_counts=True)
            total[slot] += n.astype(np.int32)
        some = [k for k in range(pieces_) if total[k * wide : (k + 1) * wide].any()]
        yield pa.record_batch(
            [pa.array(some, pa.int32()), pa.array([total[k * wide : (k + 1) * wide].tobytes() for k in some], pa.binary())],
            names=["part", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(counts, np.int32)
        yield pa.record_batch(
            [pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())],
            names=["part", "counts"],
        )

    kind = "part int, counts binary"
    summed = sets.select("body").mapInArrow(trimmed(count), kind).repartition(parts, "part").mapInArrow(trimmed(add), kind)
    out = np.zeros(COUNTERS, np.int32)
    for k, counts in summed.collect():
        out[k * wide : (k + 1) * wide] = np.frombuffer(counts, np.int32)
    return out


_CELLS = "key long, i int, j int, node long, comp long, n int, front boolean, sketch binary"


def _cells(sets: DataFrame, parts: int, slice_: int = SLICE) -> DataFrame:
    """The sets (``node, n, body, comp``) in the cells of their elements and bands: on one side
    those with the element among their first ``n // 7 + 1`` (``front``), on the other those with
    it among their first ``n // 4 + 1``."""
    context = sets.sparkSession.sparkContext
    order = context.broadcast(_counters(sets, parts))
    fronts = context.broadcast(_counters(sets, parts, order))
    names = [p.split()[0] for p in _CELLS.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, indexed = order.value, fronts.value
        for batch in (b.slice(k, 200) for b in batches for k in range(0, b.num_rows, 200)):
            node, size, comp = (batch.column(k).to_numpy() for k in (0, 1, 3))
            flat_sets, first = _sets_of(batch.column(2))
            number, band, _ = band_plan(np.diff(first))
            sketch = pa.array([parity_sketch(flat_sets[first[i] : first[i + 1]], b) for i, b in zip(number, band, strict=True)], pa.binary())
            element, whose, place = _fronts(flat_sets, first, held)
            slot = _slot(element)
            # An element of one set only, or first in none, makes no pair.
            useful = (held[slot] > 1) & (indexed[slot] > 0)
            element, whose, place, slot = element[useful], whose[useful], place[useful], slot[useful]
            # An entry for each band of the set.
            begin, end = np.searchsorted(number, [whose, whose + 1])
            times = end - begin
            entry = np.repeat(begin, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            element, whose, place, slot = (np.repeat(x, times) for x in (element, whose, place, slot))
            key = mix(element + mix(band[entry].astype(np.uint64) ^ _SALT)).view(np.int64)
            rows_of, columns_of = -(-indexed[slot] // slice_), -(-held[slot] // slice_)
            spread = mix(node[whose].view(np.uint64) ^ element)
            ahead = np.flatnonzero(place <= size[whose] // 7)
            # One cell of each column for the front side, one of each row for the other.
            for some, front, own, other in ((ahead, True, rows_of, columns_of), (np.arange(len(key)), False, columns_of, rows_of)):
                step = max(1, 200_000 // int(other[some].max(initial=1)))
                for k in range(0, len(some), step):
                    part = some[k : k + step]
                    copies = other[part]
                    at = np.repeat(part, copies)
                    across = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                    along = (spread[at] % own[at].astype(np.uint64)).astype(np.int64)
                    i, j = (along, across) if front else (across, along)
                    yield pa.record_batch(
                        [
                            pa.array(key[at]), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                            pa.array(node[whose[at]]), pa.array(comp[whose[at]]), pa.array(size[whose[at]].astype(np.int32)),
                            pa.array(np.full(len(at), front)), sketch.take(pa.array(entry[at])),
                        ],
                        names=names,
                    )

    dealt = sets.select("node", "n", "body", "comp").mapInArrow(trimmed(emit), _CELLS).repartition(parts, "key", "i", "j")
    return dealt.sortWithinPartitions("key", "i", "j")


def _near_pairs(sets: DataFrame, parts: int, slice_: int = SLICE) -> DataFrame:
    """Pairs of nodes of two components that meet in a cell and whose parity sketches do not
    rule a link out: the sketches' Hamming distance is at most the sets' symmetric
    difference, and that at most ``(|A| + |B|) / 7``. Only these pairs leave the task."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Rows in runs that end with a cell, and where the cells begin."""
        rest: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            new = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
            if last is not None and (cell[:, 0] != last).any():
                new = np.concatenate([[0], new])
            last = cell[:, -1]
            if not len(new):
                rest.append(batch)
                continue
            if rest or new[0]:
                yield pa.Table.from_batches([*rest, batch.slice(0, new[0])]), np.zeros(1, np.int64)
            if len(new) > 1:
                yield pa.Table.from_batches([batch.slice(new[0], new[-1] - new[0])]), new[:-1] - new[0]
            rest = [batch.slice(new[-1])]
        if rest:
            yield pa.Table.from_batches(rest), np.zeros(1, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for rows, starts in whole(batches):
            node, comp, size, front = (rows.column(k).to_numpy() for k in (3, 4, 5, 6))
            size = size.astype(np.int64)
            low, high = (f.reduceat(comp, starts) for f in (np.minimum, np.maximum))
            both = np.logical_or.reduceat(front, starts) & ~np.logical_and.reduceat(front, starts)
            ends = np.append(starts[1:], len(node))
            for k in np.flatnonzero((low < high) & both).tolist():
                at = np.arange(starts[k], ends[k])
                left, right = at[front[at]], at[~front[at]]
                body = rows.column(7).slice(starts[k], ends[k] - starts[k]).to_pylist()
                sketch = np.frombuffer(b"".join(body), np.uint64).reshape(len(at), -1)
                one, two = sketch[left - starts[k]], sketch[right - starts[k]]
                step = max(1, (1 << 21) // two.size)
                for begin in range(0, len(left), step):
                    x, y = left[begin : begin + step], right
                    apart = np.bitwise_count(one[begin : begin + step, None] ^ two[None]).sum(axis=2, dtype=np.int64)
                    near = (7 * apart <= size[x][:, None] + size[y][None]) & (size[x][:, None] <= size[y][None])
                    i, j = np.nonzero(near)
                    yield _pairs(node, comp, size, x[i], y[j])

    return _distinct(_cells(sets, parts, slice_).mapInArrow(trimmed(_packing(run, parts)), _PAIRS), parts)


def parity_sketch(own: np.ndarray, band: int) -> bytes:
    """A bit per element, toggled: at least as many bits as a set of the band has elements."""
    bits = min(max(64, 2 << band), MAX_SKETCH_BITS)
    at = (mix(own) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) % 2).astype(np.uint8)).tobytes()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (left, at), (right, to) = _sets_of(batch.column(2)), _sets_of(batch.column(3))
            kept = []
            for row in range(batch.num_rows):
                x, y = left[at[row] : at[row + 1]], right[to[row] : to[row + 1]]
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[place] == x).sum())
                if 100 * common >= PERCENT * (len(x) + len(y) - common):
                    kept.append(row)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

    one = sets.select(F.col("node").alias("a"), F.col("body").alias("left"))
    two = sets.select(F.col("node").alias("b"), F.col("body").alias("right"))
    whole = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")
    return whole.mapInArrow(trimmed(run), "a long, b long")


def _labelled(sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return sets.withColumn("comp", F.col("node"))
    return sets.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 1) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row for each row of ``docs``; the component is
    named by the smallest id in it."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    passed = cut(_first_pass(docs, id_col, text_col, parts), "parity")
    rows = passed.filter("band is null").select("id", "n", "node")
    unsettled = passed.filter("band is not null")
    known = rows.filter("node is not null")
    reps = known.groupBy("node").agg(F.min("id").alias("rep"))
    # The share of its blocks that other sets have too: an original has a larger one than its
    # edited copies, so it leads.
    share = F.least(F.max(F.col("missing") / F.col("n")), F.lit(1.0))
    common = unsettled.groupBy("node").agg((share * 60000).cast("int").alias("weight"))
    reps = cut(reps.join(common, "node"), "reps")
    sets = cut(_open_sets(docs, id_col, text_col, reps), "sets")

    # Nodes of one id are one document.
    same = known.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("top"), F.collect_set("node").alias("all"))
    links = same.filter("a < top").select("a", F.explode("all").alias("b")).filter("a <> b")
    links, labels, tested = cut(links, "links"), None, None
    filled = _thin_blocks(sets)
    for turn in range(1, rounds + 1):
        dealt = _dealt(_labelled(sets, labels), parts, filled)
        pairs = _stars(dealt, parts, turn)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = cut(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        links = links.union(cut(_verified(pairs, sets), "links"))
        labels = connected(links)
    # A node that can still gain a link lacks settled blocks, and so does what it links to.
    lacking = _unsettled(_dealt(_labelled(sets, labels), parts, filled), parts, rounds).distinct()
    rest = cut(_labelled(sets, labels).join(lacking, "node", "left_semi"), "rest")
    pairs = _near_pairs(rest, parts)
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    links = links.union(cut(_verified(cut(pairs, "pairs"), rest), "links"))
    labels = connected(links)

    grouped = rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = grouped.filter("comp is not null").groupBy("comp").agg(F.min("id").alias("component_id"))
    return grouped.join(names, "comp", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
