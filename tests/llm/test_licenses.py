"""License scans."""

from __future__ import annotations

import regex

from footfall.llm import licenses
from footfall.llm.queries import op5_licenses
from footfall.llm.tables import table
from tests.llm.helpers import ALNUM, ODD, SF, by_id, documents, lower


def brute(text):
    words = ALNUM.findall(lower(text))
    places = []
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        places += [(k, label) for k in range(len(words) - len(own) + 1) if words[k : k + len(own)] == own]
    starts = [k for k, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = by_id(op5_licenses(spark, SF))
    assert sorted(got) == sorted(docs)
    for d, text in docs.items():
        row = got[d]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == brute(text)
        assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))
        assert row["score"] == (1.0 if row["n_base"] else row["score"]) and 0 <= row["score"] <= 1


def test_odd_texts(spark):
    texts = [*ODD, "MIT license mit LICENSE", "gnu general public, license", "é mit\nlicense é"]
    got = by_id(licenses.scan_licenses(documents(spark, texts)))
    for k, text in enumerate(texts):
        row = got[k]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == brute(text)
    assert licenses.scan_licenses(documents(spark, ["x"]).limit(0)).count() == 0


def test_fuzzy_spans_and_errors():
    text = "é Licenced under the Apache Licence, Version 2,0 and more"
    found = licenses.fuzzy_notices(lower(text).encode())
    assert [(label, errors) for _, _, label, errors in found] == [("apache", 3)]
    start, end = found[0][:2]
    assert text[start:end] == "Licenced under the Apache Licence, Version 2,0"
    assert licenses.fuzzy_notices(b"licensed under nothing in particular") == []


def test_seeds_lose_no_copy():
    """Every text that the bounded-error pattern matches holds a seed."""
    for notice, _, errors in licenses.NOTICES:
        assert "".join(s for _, s in licenses.seeds(notice, errors)) == notice
        changed = list(notice)
        for k in range(errors):  # one edit in each of as many seeds
            changed[licenses.seeds(notice, errors)[k][0]] = "~"
        text = "".join(changed)
        assert regex.search(f"(?:{regex.escape(notice, literal_spaces=True)}){{e<={errors}}}", text)
        assert licenses.fuzzy_notices(text.encode())


def test_unlike_copies_in_one_text():
    """A better copy later in the text hides none before it."""
    copies = [
        "releasd under the mit license", "released under the mit license", "releasd undr the mit license",
        "released undr the mit license", "relesed undr the mitt license", "released under the mit license",
    ]
    for some in (copies[:3], copies, copies[::-1]):
        text = " ... ".join(some)
        found = licenses.fuzzy_notices(text.encode())
        assert [text[a:b] for a, b, *_ in found] == some
        assert [e for *_, e in found] == [{0: 1, 1: 0, 2: 2, 3: 1, 4: 3, 5: 0}[copies.index(c)] for c in some]


def test_thousands_of_notices_take_linear_time():
    import time

    one = "é" * 40 + " released under teh mit license; "
    n = 3000
    began = time.process_time()
    got = licenses.fuzzy_notices((one * n).encode())
    assert time.process_time() - began < 20
    alone = licenses.fuzzy_notices(one.encode())
    assert len(alone) == 1 and len(got) == n
    start, end, label, errors = alone[0]
    assert got == [(start + k * len(one), end + k * len(one), label, errors) for k in range(n)]
