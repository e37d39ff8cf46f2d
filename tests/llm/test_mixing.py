from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from llm_fixtures import CLASH, blank_words, work  # noqa: F401
from pyspark.sql import functions as F

from rollcall.llm.mixing import apportioned, mixed_documents, mixed_sources


def targets(sizes):
    """By hand: reshare what is above three times a source's size until nothing is."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {name: k % 3 + 1 for k, name in enumerate(names)}
    target, full, total = {}, set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        for s in free:
            target[s] = rest * weight[s] / sum(weight[f] for f in free)
        above = {s for s in free if target[s] > 3 * sizes[s] + 1e-9}
        if not above:
            return target
        for s in above:
            target[s] = 3 * sizes[s]
        full |= above


@pytest.fixture
def corpus(spark):
    def make(rows):
        names = "".join(f", {name} string" for name in CLASH)
        values = ["x"] * len(CLASH)
        frame = spark.createDataFrame(
            [(*row, len(row[1] or ""), *values) for row in rows], f"doc_id long, text string, source string, n_chars int{names}"
        )
        return frame.repartition(3)

    return make


def rows(seed=3):
    tries = random.Random(seed)
    out = []
    for k in range(600):
        source = tries.choice(["b", "a", "B", None, "tiny", "hot", "hot", "hot", "hot"])
        n = 1 if source == "tiny" else tries.choice([0, 1, 10, 100, 700])
        out.append((k, " ".join(f"w{k}.{i}" for i in range(n)), source))
    return [*out, (None, None, "a"), (None, "w x", "a"), (1000, "same", "b"), (1000, "same", "b"), (1001, "  lead  ", "a")]


def test_targets_sizes_and_limits(corpus, work):
    given = rows()
    got = mixed_sources(corpus(given), work, carry=("source",)).collect()
    sizes = Counter()
    for _, text, source in given:
        sizes[source] += len(blank_words(text))
    want, taken = targets(sizes), defaultdict(int)
    assert len(got) == len(given)
    for r in got:
        assert r.source_size == sizes[r.carried_source]
        assert abs(r.target - want[r.carried_source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken == r.passes * r.size + sum(p.stop - p.start for p in r.pieces)
        assert all(0 <= p.start < p.stop <= r.size for p in r.pieces)
        taken[r.carried_source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(32, 0.01 * target)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree_in_any_order(corpus, work, spark):
    one = mixed_sources(corpus(rows()), work).select("doc_id", "size", "taken")
    other = mixed_sources(corpus(rows()[::-1]).repartition(7), work).select("doc_id", "size", "taken")
    assert Counter(one.collect()) == Counter(other.collect())


def test_documents_hold_the_words_taken(corpus, work):
    given = rows()
    frame = corpus(given)
    taken = {}
    for r in mixed_sources(frame, work).collect():
        taken.setdefault(r.doc_id, Counter())[r.taken] += 1
    mixed = mixed_documents(frame, work)
    assert mixed.columns == frame.columns
    assert mixed.dtypes == frame.dtypes
    words, texts = Counter(), dict((k, t) for k, t, _ in given if k is not None)
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] += len(blank_words(r.text))
        if r.doc_id is not None:
            assert set(blank_words(r.text)) <= set(blank_words(texts[r.doc_id]))
            assert all(part in texts[r.doc_id] for part in [r.text] if len(blank_words(part)) == 1)
    for doc, counts in taken.items():
        assert words[doc] == sum(n * k for n, k in counts.items())


def test_apportionment_equals_highest_quotients(spark):
    tries = random.Random(5)
    cells = []
    for group in range(12):
        total = tries.choice([0, 1, 7, 100, 5000])
        for k in range(tries.choice([1, 2, 9, 40])):
            cells.append((group, k, float(tries.choice([0, 0.5, 3, 1000, tries.random() * 10**6])), total))
    frame = spark.createDataFrame(cells, "g int, k int, votes double, total long")
    got = {(r.g, r.k): r.seats for r in apportioned(frame, ["g"], [F.asc("k")]).collect()}
    for group in range(12):
        own = [c for c in cells if c[0] == group]
        quotients = sorted((-v / (2 * n + 1), k) for _, k, v, total in own if v for n in range(total + 1))
        won = Counter(k for _, k in quotients[: own[0][3]])
        assert {k: got[group, k] for _, k, _, _ in own} == {k: won[k] for _, k, _, _ in own}


def test_without_words_and_without_rows(corpus, work):
    got = mixed_sources(corpus([(1, None, "a"), (2, " ", None)]), work).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixed_sources(corpus([(1, "x", "a")]).limit(0), work).collect() == []
