from __future__ import annotations

import random

import pytest
from llm_fixtures import documents, plain_words, shingles, work  # noqa: F401

from rollcall.llm.decontamination import contaminated, decontaminated


@pytest.fixture
def benchmark_items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string").withColumnRenamed("x", "x")


def corpus():
    tries = random.Random(2)
    word = lambda: f"w{tries.randrange(3000)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([5, 6, 9, 20, 33, 80, 300, 1, 2, 4])]
    rows = []
    for item, text in items:
        words = text.split()
        for n in (0, 1, 2, len(words) // 20, len(words) // 8, len(words) // 4):
            own = list(words)
            for k in tries.sample(range(len(own)), min(n, len(own))):
                own[k] = word()
            around = [word() for _ in range(tries.choice([0, 50, 5000]))]
            at = tries.randrange(len(around) + 1)
            rows.append(" ".join(around[:at] + own + around[at:]))
        rows += [text.upper().replace(" ", " ,; "), " ".join(words[: len(words) // 2])]
    return items, list(enumerate(rows))


def test_equals_brute_force(documents, benchmark_items, work):
    items, rows = corpus()
    got = contaminated(documents(rows), benchmark_items(items), work)
    want = set()
    for doc, text in rows:
        for item, other in items:
            asked, n = shingles(plain_words(other), 5), len(plain_words(other))
            held = shingles(plain_words(text), min(n, 5), False)
            if 100 * len(held & asked) >= 80 * len(asked):
                want.add((doc, item, len(held & asked), len(asked)))
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got.collect()} == want
    assert got.count() == len(want) > 20


def test_nulls_ties_and_empty(documents, benchmark_items, work):
    text = "one two three four five six"
    rows = [(None, text), (1, text), (1, text), (2, None), (3, ""), (4, "one two"), (None, "nothing at all to be seen here")]
    items = [(None, text), (7, text), (8, None), (9, ""), (10, "one two")]
    got = contaminated(documents(rows), benchmark_items(items), work).collect()
    assert sorted((r.doc_id or -1, r.item_id or -1) for r in got) == [(-1, -1), (-1, 7), (-1, 10), (1, -1), (1, 7), (1, 10), (4, 10)]
    assert contaminated(documents(rows).limit(0), benchmark_items(items), work).collect() == []
    assert contaminated(documents(rows), benchmark_items(items).limit(0), work).collect() == []


def test_items_of_few_words(documents, benchmark_items, work):
    rows = [(1, "Yes"), (2, "no, yes: no"), (3, "yesno no"), (4, ""), (5, "a b c d"), (6, "x a b C D e"), (7, "a b c"), (8, "no yes")]
    items = [(1, "yes"), (2, "No yes!"), (3, "a b c d"), (4, "..."), (5, "d a")]
    got = contaminated(documents(rows), benchmark_items(items), work).collect()
    assert sorted((r.doc_id, r.item_id, r.n_shared, r.n_item, r.containment) for r in got) == [
        (d, i, 1, 1, 1.0) for d, i in [(1, 1), (2, 1), (2, 2), (5, 3), (6, 3), (8, 1), (8, 2)]
    ]


def test_filter(documents, benchmark_items, work):
    text = "one two three four five six"
    rows = [(None, text), (None, "clean"), (1, text + " and more"), (2, None), (2, text), (3, "clean words here")]
    frame = documents(rows)
    left = decontaminated(frame, benchmark_items([(7, text)]), work)
    assert left.columns == frame.columns
    assert sorted((r.doc_id or -1, r.text or "-") for r in left.collect()) == [(-1, "clean"), (2, "-"), (3, "clean words here")]
