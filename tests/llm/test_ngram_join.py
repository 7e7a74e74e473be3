"""The parity-sketch join."""

from __future__ import annotations

import random

import numpy as np
import pytest

from footfall.llm import parity
from footfall.llm.graph import connected
from footfall.llm.queries import op8_ngram_join
from footfall.llm.tables import table
from tests.llm.helpers import NON_SPACE, ODD, SF, documents, lower


def brute(docs):
    sets = []
    for i, text in docs:
        words = NON_SPACE.findall(lower(text))
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
        sets.append((i, own))
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders: dict = {}
    for n, (_, own) in enumerate(sets):
        for shingle in own:
            holders.setdefault(shingle, []).append(n)
    seen = set()
    for some in holders.values():
        for x in range(len(some)):
            for y in range(x):
                if (some[y], some[x]) in seen:
                    continue
                seen.add((some[y], some[x]))
                (i, a), (j, b) = sets[some[y]], sets[some[x]]
                if 100 * len(a & b) >= 75 * len(a | b):
                    low, high = sorted((find(i), find(j)))
                    parent[high] = low
    return sorted((i, len(own), find(i)) for i, own in sets)


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert result(op8_ngram_join(spark, SF)) == brute(docs)


def test_near_the_threshold(spark):
    """Groups of short and long texts with edits around the threshold, chains among them."""
    rnd = random.Random(8)
    texts = list(ODD)
    for _ in range(60):
        base = [rnd.choice("abcdefghij") * rnd.randint(1, 3) for _ in range(rnd.choice([1, 3, 5, 6, 7, 8, 10, 12, 20, 40, 120]))]
        for _ in range(rnd.randint(1, 6)):
            words = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                words[rnd.randrange(len(words))] = rnd.choice("klmnop")
            texts.append(" ".join(words))
    big = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    for _ in range(120):
        words = list(big)
        for _ in range(rnd.randint(1, 9)):
            words[rnd.randrange(200)] = f"x{rnd.randrange(10**6)}"
        texts.append(" ".join(words))
    docs = documents(spark, texts).repartition(3)
    want = brute(list(enumerate(texts)))
    assert result(parity.components(docs)) == want
    assert result(parity.components(docs, rounds=0)) == want


def test_repeated_and_null_ids(spark):
    long = " ".join(f"w{k}" for k in range(50))
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (5, long), (9, long), (None, long), (None, None), (9, long)]
    got = sorted(map(str, map(tuple, parity.components(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
    assert got == sorted(map(str, [(1, 2, 1), (5, 2, 1), (5, 46, 1), (9, 46, 1), (9, 46, 1), (None, 46, None), (None, 0, None)]))


def test_empty_table(spark):
    assert parity.components(documents(spark, ["x"]).limit(0)).count() == 0


def test_thin_sets_are_compared_by_empty_blocks(spark, monkeypatch):
    """With hardly any blocks to spare many sets lack full blocks; no link may be lost."""
    monkeypatch.setattr(parity, "SPARE", 0)
    monkeypatch.setattr(parity, "ROOM", 1.0)
    rnd = random.Random(5)
    sets, first = [], [0]
    for _ in range(200):
        sets.append(np.sort(np.array([rnd.getrandbits(64) for _ in range(rnd.randint(2, 12))], np.uint64)))
        first.append(first[-1] + len(sets[-1]))
    thin = parity.thin_blocks(np.concatenate(sets), np.array(first))
    assert thin
    filled: dict = {}
    for band, block in thin:
        filled.setdefault(band, []).append(block)
    filled = {b: np.array(sorted(x)) for b, x in filled.items()}
    _, entry, number, band = parity.block_keys(np.concatenate(sets), np.array(first), filled)
    full = np.bincount(entry, minlength=len(number))
    assert (full >= parity.needed(np.diff(first)[number], band)).all()


def test_blocks_bound_the_difference():
    """Linked sets differ in fewer blocks than either needs."""
    rnd = random.Random(6)
    for _ in range(200):
        size = rnd.randint(4, 300)
        common = [rnd.getrandbits(64) for _ in range(size)]
        extra = [rnd.getrandbits(64) for _ in range(size // 3)]
        cut = rnd.randint(0, len(extra))
        a, b = (np.sort(np.array(common + part, np.uint64)) for part in (extra[:cut], extra[cut:]))
        assert 100 * size >= 75 * (size + len(extra))
        sets, first = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        keys, entry, number, band = parity.block_keys(sets, first)
        own = {(n, w): set(keys[entry == e].tolist()) for e, (n, w) in enumerate(zip(number.tolist(), band.tolist(), strict=True))}
        shared = [w for n, w in own if n == 0 and (1, w) in own]
        assert shared
        for w in shared:
            for n, sizes in ((0, len(a)), (1, len(b))):
                assert len(own[(n, w)] - own[(1 - n, w)]) < parity.needed(sizes, w)


def test_connected(spark):
    rnd = random.Random(1)
    links = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (102, 100)] + [(rnd.randint(200, 240), rnd.randint(200, 240)) for _ in range(30)]
    links = [p for p in links if p[0] != p[1]]
    got = dict(tuple(r) for r in connected(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[k] == 1 for k in range(1, 61)) and got[102] == got[101] == 100
    assert all(got[a] == got[b] for a, b in links)
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
    assert pytest is not None


def _template_sets(spark, n):
    """Sets of 75 elements in common and 25 of their own (similar by 0.6), every tenth of them
    followed by one that links to it: ``(sets, links)``."""
    rnd = random.Random(3)
    core, rows, links = [rnd.getrandbits(64) for _ in range(75)], [], set()
    for k in range(n):
        own = core + [rnd.getrandbits(64) for _ in range(25)]
        rows.append((k, own))
        if k % 10 == 0:
            links.add((k, n + k))
            rows.append((n + k, own[:-8] + [rnd.getrandbits(64) for _ in range(8)]))
    packed = [(k, len(own), np.sort(np.array(own, np.uint64)).tobytes(), k, 0) for k, own in rows]
    return spark.createDataFrame(packed, "node long, n long, body binary, comp long, weight int").repartition(3), links


def test_sets_of_one_template_do_not_all_meet(spark):
    """The work follows the links, not the square of the template's sets."""
    n = 3000
    sets, links = _template_sets(spark, n)
    cells = parity._cells(sets, 4).groupBy("key", "i", "j").agg({"front": "count"}).collect()
    assert max(r[3] for r in cells) < 20
    assert sum(r[3] ** 2 for r in cells) < 100 * n
    assert {tuple(r) for r in parity._near_pairs(sets, 4).collect()} >= links


def test_cells_of_a_common_element_are_bounded(spark):
    """Subsets of one set have all their elements in common with many; no link is lost."""
    rnd = random.Random(4)
    core = [rnd.getrandbits(64) for _ in range(40)]
    some = [set(rnd.sample(core, rnd.randint(24, 36))) for _ in range(300)]
    packed = [(k, len(own), np.sort(np.array(sorted(own), np.uint64)).tobytes(), k, 0) for k, own in enumerate(some)]
    sets = spark.createDataFrame(packed, "node long, n long, body binary, comp long, weight int").repartition(3)
    assert max(r["count"] for r in parity._cells(sets, 4, 20).groupBy("key", "i", "j").count().collect()) <= 80
    want = {(x, y) for y in range(300) for x in range(y) if 4 * len(some[x] & some[y]) >= 3 * len(some[x] | some[y])}
    got = {tuple(r) for r in parity._verified(parity._near_pairs(sets, 4, 20), sets).collect()}
    assert got == want and want


def _moved(spark, df) -> int:
    """Bytes of the shuffles of a frame."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> dict[str, int]:
        found = disk.getAllFiles()
        files = [found.apply(k) for k in range(found.size())]
        return {f.getPath(): f.length() for f in files if f.getName().startswith("shuffle") and f.getName().endswith(".data")}

    before = shuffles()
    df.write.format("noop").mode("overwrite").save()
    return sum(size for name, size in shuffles().items() if name not in before)


def _unlike(spark, n: int):
    rnd = random.Random(9)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(300)) for _ in range(n)]
    return documents(spark, texts).repartition(2).localCheckpoint()


def test_more_parts_move_little_more(spark):
    """What goes along with a key is small, and only shared blocks are sent back."""
    docs = _unlike(spark, 600)
    few, many = (_moved(spark, parity._first_pass(docs, "doc_id", "text", parts)) for parts in (4, 150))
    assert many < 2.5 * few


def test_texts_that_are_not_open_stay(spark):
    docs = _unlike(spark, 600)
    passed = parity._first_pass(docs, "doc_id", "text", 4).filter("id = 5").selectExpr("node", "id rep", "1 weight").localCheckpoint()
    sets = parity._open_sets(docs, "doc_id", "text", passed)
    assert [(r.n, len(r.body)) for r in sets.collect()] == [(296, 8 * 296)]
    assert _moved(spark, sets) < 100_000


def test_copies_of_a_text_share_no_blocks():
    """Copies count as one set, however many reach a part, and other sets' keys count once each."""
    tags = np.array([2, 2, 4, 6, 2], np.uint64)
    keys = np.array([1, 2, 3, 1, 2, 3, 3, 4, 9, 8, 1, 2, 3], np.uint64)
    entry = np.array([0, 0, 0, 1, 1, 1, 2, 2, 3, 3, 4, 4, 4])
    (_, *row), = parity._pack(keys, entry, 1, tags)
    got = parity._shared_blocks([tuple(row)])
    assert dict(zip(*(x.tolist() for x in got), strict=True)) == {2: 1, 4: 1}
