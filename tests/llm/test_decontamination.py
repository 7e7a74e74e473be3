"""Wu-Manber search for benchmark windows."""

from __future__ import annotations

import hashlib
import random

from footfall.llm import wumanber
from footfall.llm.queries import op4_decontamination
from footfall.llm.tables import table
from tests.llm.helpers import ALNUM, ODD, SF, by_id, documents, lower


def brute(docs, items, size=10):
    windows = {}
    for i, text in items:
        words = ALNUM.findall(lower(text))
        length = min(size, len(words))
        for k in range(len(words) - length + 1 if length else 0):
            windows.setdefault(tuple(words[k : k + length]), set()).add(i)
    lengths = {len(w) for w in windows}
    out = {}
    for d, text in docs:
        words = ALNUM.findall(lower(text))
        hit, owners = set(), set()
        for length in lengths:
            for k in range(len(words) - length + 1):
                if (own := windows.get(tuple(words[k : k + length]))) is not None:
                    hit.update(range(k, k + length))
                    owners |= {str(o) for o in own if o is not None}
        out[d] = (len(words), len(hit), sorted(owners))
    return out


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    want = brute(docs, [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
    got = by_id(op4_decontamination(spark, SF))
    assert len(got) == len(want) and any(w[1] for w in want.values())
    for d, (n, hit, items) in want.items():
        row = got[d]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (n, hit, len(items), hit > 0)
        assert row["items_sha256"] == hashlib.sha256(",".join(items).encode()).hexdigest()


def test_small_vocabulary_in_passes(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))) for _ in range(60)] + ODD
    items = [(k, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 16)))) for k in range(25)]
    items += [(90, None), (None, "the the the"), (91, "THE, the! the"), (92, "a"), (93, "日本語 the end")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    want = brute(list(enumerate(texts)), items)
    for limit in (1_000_000, 20):
        got = by_id(wumanber.find_windows(documents(spark, texts), bench, limit=limit))
        assert {d: (r["n_words"], r["n_hit"], r["items"]) for d, r in got.items()} == want
    for row in got.values():
        assert sum(b - a for a, b in row["hit_runs"]) == row["n_hit"]


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = documents(spark, ["a b", None])
    assert wumanber.find_windows(docs.limit(0), bench).count() == 0
    assert [r.n_hit for r in wumanber.find_windows(docs, bench.limit(0)).collect()] == [0, 0]
