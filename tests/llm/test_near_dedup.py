from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from llm_fixtures import blank_words, components, documents, shingles, work  # noqa: F401
from pyspark.sql import functions as F

from rollcall.llm import near_dedup
from rollcall.llm.near_dedup import agreement, band_keys, least_agreement, minima, near_duplicates, packed, without_near_duplicates


def edited(words, n, tries):
    out = list(words)
    for k in tries.sample(range(len(out)), n):
        out[k] = f"new{tries.randrange(10**6)}"
    return out


def expected(rows, size, percent):
    sets = {i: shingles(blank_words(t), size) for i, t in rows if i is not None}
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, components(sets, links)


def corpus(seed=1):
    tries = random.Random(seed)
    rows = []
    for base in range(12):
        words = [f"w{tries.randrange(400)}" for _ in range(tries.choice([5, 30, 120, 400]))]
        for _ in range(8):
            rows.append(" ".join(edited(words, tries.randrange(0, max(1, len(words) // 12)), tries)))
        rows += [" ".join(words).upper(), "\t\n".join(words)]
    rows += [None, "", " \n ", "one", "One", "one two", "x" * 5000, " ".join(f"long{k}" for k in range(30_000))]
    tries.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size", [4, 5])
def test_equals_brute_force(documents, work, size):
    rows = corpus()
    got = near_duplicates(documents(rows), work, size=size).collect()
    sets, component = expected(rows, size, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(sets[i]), component[i], component[i] == i) for i in sets
    }
    assert len(got) == len(rows)


def test_chain_without_the_smallest(documents, work):
    """Links among members of a key that aren't linked to its smallest member."""
    tries = random.Random(4)
    base = [f"w{k}" for k in range(100)]
    far = edited(base, 6, tries)
    rows = [(0, " ".join(base))] + [(k, " ".join(edited(far, 2, tries))) for k in range(1, 40)]
    rows += [(100 + k, " ".join(edited(base, 5, tries))) for k in range(40)]
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(rows), work, size=4).collect()}
    assert got == expected(rows, 4, 80)[1]


def test_blocks_of_a_key(documents, work, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    test_chain_without_the_smallest(documents, work)


def test_nulls_repeats_and_empty(documents, work):
    text = "a b c d e f g h i j"
    rows = [(None, text), (None, text), (3, text), (3, text), (5, text), (7, None), (None, None)]
    got = near_duplicates(documents(rows), work, size=4).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in got) == [
        (-1, 0, -1, True), (-1, 7, -1, True), (-1, 7, -1, True), (3, 7, 3, True), (3, 7, 3, True), (5, 7, 3, False),
        (7, 0, 7, True),
    ]
    assert near_duplicates(documents([(1, "a")]).limit(0), work).collect() == []


def test_filter_keeps_columns_and_one_of_each_group(documents, work):
    text = "a b c d e f g h i j"
    rows = [(None, text), (3, text), (3, text), (3, "other"), (5, text), (7, None), (8, "")]
    frame = documents(rows)
    left = without_near_duplicates(frame, work)
    assert left.columns == frame.columns
    assert sorted((r.doc_id or -1, r.text or "-") for r in left.collect()) == [
        (-1, text), (3, text), (3, "other"), (7, "-"), (8, "-"),
    ]


def test_estimate_follows_similarity(spark):
    tries = np.random.default_rng(0)
    rows = []
    for share in (0.2, 0.5, 0.8, 0.95):
        for _ in range(50):
            common = tries.integers(0, 2**64, int(1000 * share), dtype=np.uint64)
            sides = [np.concatenate((common, tries.integers(0, 2**64, (1000 - len(common)) // 2, dtype=np.uint64))) for _ in "ab"]
            a, b = (packed(minima(side)).view(np.int64).tolist() for side in sides)
            rows.append((share, a, b))
    frame = spark.createDataFrame(rows, "share double, a array<long>, b array<long>")
    found = frame.groupBy("share").agg(F.avg(near_dedup.estimated(agreement("a", "b"))).alias("mean"), F.min(agreement("a", "b")).alias("least"))
    for share, mean, least in found.collect():
        assert abs(mean - share) < 0.03
        assert share < 0.8 or least >= least_agreement(0.8)


def test_equal_sets_share_all_band_keys():
    x = np.arange(50, dtype=np.uint64)
    assert (band_keys(minima(x)) == band_keys(minima(x[::-1]))).all()
    assert len(set(band_keys(minima(x)).tolist())) == near_dedup.BANDS
