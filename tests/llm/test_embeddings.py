from __future__ import annotations

import duckdb
import numpy as np
import pytest
from llm_fixtures import components, work  # noqa: F401

from rollcall.llm import embeddings
from rollcall.llm.embeddings import fit_quantizer, linked_vectors
from rollcall.llm.oracle import STATEMENTS


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y") for i, v in rows],
        "vec_id long, embedding array<float>, rep string, links string",
    ).repartition(3)


def expected(rows, cosine=0.9):
    unit = {}
    width = max((len(v) for _, v in rows if v is not None), default=0)
    for n, (i, v) in enumerate(rows):
        fine = i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.zeros(width)
        if fine:
            x[: len(v)] = np.asarray(v, np.float32)
            unit[n] = x / np.linalg.norm(x)
    links = [(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= cosine]
    component = components({i for i, _ in rows if i is not None}, [(rows[a][0], rows[b][0]) for a, b in links])
    counts = np.zeros(len(rows), int)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    return sorted(
        ((i, int(counts[n]), component.get(i), i is None or component[i] == i) for n, (i, _) in enumerate(rows)), key=repr
    )


def corpus(n=600, width=24, spread=0.25, seed=9):
    tries = np.random.default_rng(seed)
    bases = tries.normal(size=(n // 4, width))
    rows = []
    for k in range(n):
        v = bases[tries.integers(len(bases) if k % 3 else 3)]
        rows.append((k, (v + tries.normal(size=width) * np.linalg.norm(v) / width**0.5 * tries.random() * spread * 2).tolist()))
    rows += [(n + k, rows[5][1]) for k in range(20)] + [(2 * n, (np.array(rows[6][1]) * 7).tolist())]
    return rows


def got(vectors, work, **options):
    found = linked_vectors(vectors, work, **options).collect()
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found), key=repr)


@pytest.mark.parametrize("block", [16, 256])
def test_equals_brute_force(spark, work, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "ASKING", 3 * block)
    rows = corpus()
    assert got(frame(spark, rows), work, reach=1.0) == expected(rows)


def test_small_sample_still_finds_all(spark, work):
    rows = corpus(seed=10)
    assert got(frame(spark, rows), work, bound=40, reach=1.0) == expected(rows)


def test_recall_of_the_default_reach(spark, work):
    """Partners just above the threshold, in random directions."""
    tries = np.random.default_rng(11)
    rows = []
    for k in range(1500):
        v = tries.normal(size=64)
        v /= np.linalg.norm(v)
        u = tries.normal(size=64)
        u -= (u @ v) * v
        u /= np.linalg.norm(u)
        rows += [(2 * k, v.tolist()), (2 * k + 1, (0.905 * v + (1 - 0.905**2) ** 0.5 * u).tolist())]
    want = expected(rows)
    found = got(frame(spark, rows), work)
    links = sum(x[1] for x in want)
    assert links >= 3000
    assert sum(x[1] for x in found) >= 0.99 * links
    assert all(a[1] <= b[1] for a, b in zip(found, want, strict=True))


def partnered(kind, n=1500, width=64, seed=12):
    """Vectors and partners at a cosine of 0.905, in directions that the kind prefers."""
    tries = np.random.default_rng(seed)
    steep = np.arange(1, width + 1) ** -(1.5 if kind == "steep" else 1.0)
    basis = tries.normal(size=(10, width)) if kind == "low" else None
    centres = tries.normal(size=(12, width))
    draw = {
        "anisotropic": lambda: tries.normal(size=width) * steep,
        "steep": lambda: tries.normal(size=width) * steep,
        "low": lambda: tries.normal(size=10) @ basis,
        "clustered": lambda: centres[tries.integers(12)] + tries.normal(size=width) * steep,
        "ragged": lambda: np.pad(tries.normal(size=(m := int(tries.integers(4, 9)))), (0, width - m)),
    }[kind]
    rows = []
    for k in range(n):
        v, u = draw(), draw()
        v /= np.linalg.norm(v)
        u -= (u @ v) * v
        u /= np.linalg.norm(u)
        pair = [v, 0.905 * v + (1 - 0.905**2) ** 0.5 * u]
        if kind == "ragged" and k:
            pair = [np.trim_zeros(x, "b") for x in pair]
        rows += [(2 * k + side, x.tolist()) for side, x in enumerate(pair)]
    return rows


@pytest.mark.parametrize("kind", ["anisotropic", "steep", "low", "clustered", "ragged"])
def test_links_in_preferred_directions(spark, work, kind):
    """None is lost with ``reach=1``, and one in a hundred at most by default."""
    rows = partnered(kind, n=700, width=384 if kind == "low" else 64)
    want, vectors = expected(rows), frame(spark, rows)
    assert got(vectors, work, reach=1.0) == want
    found = got(vectors, work)
    assert sum(x[1] for x in found) >= 0.99 * sum(x[1] for x in want)
    assert all(a[1] <= b[1] for a, b in zip(found, want, strict=True))


def test_default_reach_is_measured():
    """Isotropic partners cross few borders straight; in few dimensions they do."""
    tries = np.random.default_rng(2)
    wide, flat = tries.normal(size=(3000, 64)), np.pad(tries.normal(size=(3000, 2)), ((0, 0), (0, 62)))
    reach = []
    for x in (wide, flat):
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        reach.append(embeddings.calibrated(fit_quantizer(x, 50), x, 0.9))
    assert reach[0] < 0.6 < reach[1] <= 1


def test_the_sql_agrees_on_vectors_that_link(spark, work, tmp_path):
    rows = corpus(n=200)
    path = str(tmp_path / "embeddings.parquet")
    frame(spark, rows).write.parquet(path)
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
        result = connection.execute(STATEMENTS["op3_embedding_dedup"])
        at = [x[0] for x in result.description].index
        columns = [at(c) for c in ("vec_id", "n_links", "component_id", "kept")]
        want = sorted((tuple(row[k] for k in columns) for row in result.fetchall()), key=repr)
    assert sum(x[1] for x in want) > 200
    assert got(spark.read.parquet(path), work) == want


def test_equal_centroids_probe_each_other():
    centroids = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]])
    quantizer = embeddings.Quantizer(centroids, [], np.array([0, 2]))
    own, probes = quantizer.probes(np.array([[1.0, 0.0]]), 0.1)
    assert own.tolist() == [0] and probes[0].tolist() == [0, 1]


def test_unusable_vectors(spark, work):
    rows = [
        (1, [1, 0]), (2, [2, 0]), (None, [1, 0]), (3, None), (4, []), (5, [0, 0]), (6, [float("nan"), 1]), (7, [float("inf"), 1]),
        (8, [None, 1]), (9, [1]), (10, [0, 1]), (10, [0, 1]), (11, [1e-30, 0]), (12, [3e38, 0]),
    ]
    assert got(frame(spark, rows), work) == expected(rows)


def test_nothing_to_compare(spark, work):
    assert got(frame(spark, [(1, [1.0])]).limit(0), work) == []
    assert got(frame(spark, [(1, None), (None, [0.0])]), work) == [(1, 0, 1, True), (None, 0, None, True)]


def test_table_distances_are_those_of_the_codes():
    tries = np.random.default_rng(1)
    x = tries.normal(size=(500, 20))
    q = fit_quantizer(x, 5)
    codes = q.codes(x - q.centroids[2])
    stood_for = q.centroids[2] + q.decoded(codes)
    want = np.linalg.norm(x[:30, None] - stood_for[None], axis=2)
    assert np.allclose(q.distances(x[:30], 2, codes), want)


def test_several_sets_compare_fewer_pairs():
    """Isotropic partners meet in one of several sets with far less probing; the pairs grow slower than the rows' square."""
    tries, compared = np.random.default_rng(6), {}
    for n in (4000, 16000):
        x = tries.normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        sets, reach = embeddings.chosen(embeddings.fit_sets(x, n // embeddings.PER_LIST), x, 0.9)
        assert len(sets) > 1
        far = np.sqrt(0.2) * reach
        compared[n] = 0
        for q in sets:
            own, probes = q.probes(x[:1000], far)
            sizes = np.bincount(embeddings._squares(x, q.centroids).argmin(1), minlength=len(q.centroids))
            compared[n] += sum(int(sizes[p].sum()) for p in probes)
    assert compared[16000] < 3 * compared[4000]  # per row: with the square it would be 4
    assert compared[16000] < 0.06 * 16000 * 1000


@pytest.mark.parametrize("sets", [1, 2, 4])
def test_pairs_of_several_sets_count_once(spark, work, monkeypatch, sets):
    """Near copies meet in every set, far ones in some; no link counts twice."""
    monkeypatch.setattr(embeddings, "SETS", (sets,))
    monkeypatch.setattr(embeddings, "PER_LIST", 20)
    monkeypatch.setattr(embeddings, "REACHED", 1.0)
    rows = corpus(seed=13)
    found, want = got(frame(spark, rows), work), expected(rows)
    assert all(a[1] <= b[1] for a, b in zip(found, want, strict=True))
    assert sum(x[1] for x in found) >= 0.995 * sum(x[1] for x in want)
