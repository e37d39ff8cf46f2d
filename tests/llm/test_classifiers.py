from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from conftest import SMALL
from llm_fixtures import documents, work  # noqa: F401
from pyspark.sql import functions as F

from rollcall.llm import quality, toxicity
from rollcall.llm.labels import held_out, in_share, training_labels
from rollcall.llm.quality import STATISTICS, Bound, RuleEnsemble, fit_rules, of_quality, scored_quality, statistics
from rollcall.llm.toxicity import offending_sentences, scored_toxicity, train_toxicity

LARGER = SMALL.replace("0.001", "0.1")


def table(spark, name):
    return spark.read.parquet(f"{LARGER}/{name}.parquet")


def auc(rows):
    good = [s for s, y in rows if y]
    bad = [s for s, y in rows if not y]
    return np.mean([[(a > b) + (a == b) / 2 for b in bad] for a in good])


def held(scores, labels, label):
    rows = scores.join(labels, "doc_id").where("held_out").select("score", "predicted", label).collect()
    return rows, auc([(r.score, r[label]) for r in rows])


def test_split(spark):
    ids = [*range(-5, 40), None]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r[0]: r[1] for r in frame.select("doc_id", held_out(F.col("doc_id"))).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}


def test_labels_by_majority(spark):
    rows = [(1, 1), (1, 1), (1, 0), (3, 0), (3, 1), (4, None), (None, 1), (5, 7), (8, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, quality int")
    want = {(i, y) for i, y in ((1, 1), (8, 0)) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {tuple(r) for r in training_labels(frame, "quality", 100).collect()} == want


def test_quality_held_out(spark, work):
    labels = table(spark, "labels").drop("toxic")
    scores = scored_quality(table(spark, "documents"), labels, work).cache()
    rows, area = held(scores, labels, "quality")
    assert area > 0.98
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert scores.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.7 as int)").count() == 0


def test_compiled_rules_equal_the_fitted_ones(spark):
    texts = [r.text for r in table(spark, "documents").limit(300).collect()]
    x = quality._statistics(__import__("pyarrow").array(texts))
    y = (x[:, STATISTICS.index("upper")] > np.median(x[:, STATISTICS.index("upper")])).astype(float)
    model = fit_rules(x, y)
    assert 0 < len(model.rules) < 200 and len(model.text()) == len(model.rules)
    want = 1 / (1 + np.exp(-(model.intercept + sum(w * quality._holds(rule, x) for rule, w in model.rules))))
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = frame.select("k", statistics(F.col("text")).alias("s")).select("k", model.column("s").alias("p")).orderBy("k").collect()
    assert np.allclose([r.p for r in got], want)
    assert np.mean((want > 0.5) == (y > 0)) > 0.95


EDGE = [(None, None), (1, None), (2, ""), (2, ""), (3, "x" * 200_000), (4, "a b. " * 20_000), (5, "é \U0001f600 \x00")]


@pytest.mark.parametrize("labelled", [[], [(4, 1, 1)], [(None, None, None), (1, 0, 1), (4, 1, 0), (3, 1, 0), (5, 0, 1)]])
def test_edges(spark, documents, work, labelled):
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    for got in (scored_quality(documents(EDGE), labels, work), scored_toxicity(documents(EDGE), labels)):
        rows = got.collect()
        assert len(rows) == len(EDGE)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        empty = {r.score for r in rows if r.doc_id in (None, 1, 2)}
        assert len(empty) == 1
    assert scored_quality(documents(EDGE).limit(0), labels, work).collect() == []
    assert scored_toxicity(documents(EDGE).limit(0), labels).collect() == []


def test_quality_filter(spark, documents, work):
    frame = documents(EDGE)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert of_quality(frame, none, work).count() == len(EDGE)
    docs = table(spark, "documents")
    left = of_quality(docs.withColumn("stats", F.lit(1)), table(spark, "labels"), work)
    assert left.columns == [*docs.columns, "stats"]
    kept = table(spark, "labels").join(left, "doc_id").groupBy("quality").count()
    counts = {r.quality: r["count"] for r in kept.collect()}
    every = {r.quality: r["count"] for r in table(spark, "labels").groupBy("quality").count().collect()}
    assert counts[1] >= 0.99 * every[1] and counts.get(0, 0) <= 0.05 * every[0]


def test_toxicity_held_out(spark):
    labels = table(spark, "labels").drop("quality")
    scores = scored_toxicity(table(spark, "documents"), labels).cache()
    rows, area = held(scores, labels, "toxic")
    assert area > 0.9
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95


def test_sentences_are_located(spark, documents):
    tries = random.Random(12)
    word = lambda: f"w{tries.randrange(200)}"
    sentence = lambda: " ".join(word() for _ in range(8))
    rows, labels, places = [], [], {}
    for k in range(600):
        text = [sentence() for _ in range(tries.randrange(1, 12))]
        if k % 3 == 0:
            at = tries.randrange(len(text))
            text[at] = f"{word()} vile{tries.randrange(3)} {word()}"
            places[k] = at
        rows.append((k, ". ".join(text)))
        labels.append((k, int(k % 3 == 0)))
    frame = documents(rows)
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = train_toxicity(frame, given)
    found = offending_sentences(frame, model).collect()
    assert {(r.doc_id, r.place) for r in found} == set(places.items())
    assert all("vile" in r.sentence and r.probability >= 0.5 for r in found)
    scores = {r.doc_id: r for r in scored_toxicity(frame, given).collect()}
    assert all(scores[k].predicted == (k in places) for k in scores)
    assert all(scores[k].worst == at and scores[k].offending == 1 for k, at in places.items())


def test_noisy_or():
    model = toxicity.ToxicityModel({1: 2.0}, -1.0)
    features = np.array([[0, -1], [1, -1]], np.int32)
    bags = toxicity.Sentences(features, np.array([1, 1, 0]), np.array([0, 1, 3, 3]), np.array([0, 2, 3]))
    p = lambda z: 1 / (1 + np.exp(-z))
    assert np.allclose(model.scores(bags), [1 - (1 - p(1)) * (1 - p(1)), p(-1)])


def test_a_share_of_a_huge_table_is_not_empty(spark):
    rows = spark.range(1000).select("id")
    # As if there were 10^12 rows for each one of the bound: a fixed share of the hashes is left.
    assert rows.where(in_share(F.col("id"), 8000, 10**19, hashes=1 << 4)).count() > 0
    assert rows.where(in_share(F.col("id"), 8000, 10**13)).count() == 0
    assert rows.where(in_share(F.col("id"), 8000, 7000)).count() == 1000
    assert 0 < rows.where(in_share(F.col("id"), 100, 1000)).count() < 250


def test_plans_leave_the_driver_before_and_after_training(spark, documents, work, monkeypatch):
    steps, train, let_go = [], quality.train_quality, work.let_go
    monkeypatch.setattr(quality, "train_quality", lambda *given: (steps.append("train"), train(*given))[1])
    work.let_go = lambda: (steps.append("let go"), let_go())
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    frame = documents([(k, "a fine text. " * (k % 2 + 1)) for k in range(20)])
    assert quality.of_quality(frame, labels, work).columns == frame.columns
    assert steps == ["let go", "train", "let go"]


def test_many_rules_need_no_generated_code(spark, tmp_path):
    """As many rules as training may give are no code that is too long to compile, as a filter, too."""
    tries = np.random.default_rng(4)
    x = tries.random((200, len(STATISTICS)))
    rules = [
        frozenset(Bound(int(k), bool(tries.integers(2)), float(tries.random())) for k in tries.choice(len(STATISTICS), 3, False))
        for _ in range(600)
    ]
    model = RuleEnsemble(tuple((rule, float(tries.normal())) for rule in rules), 0.1)
    rows = [(k, "some text", tuple(map(float, row))) for k, row in enumerate(x)]
    kind = ", ".join(f"{name}: double" for name in STATISTICS)
    spark.createDataFrame(rows, f"k int, text string, s struct<{kind}>").write.parquet(str(tmp_path / "rows"))
    held = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        found = spark.read.parquet(str(tmp_path / "rows")).where(model.column("s") >= 0.5).select("k", "text").collect()
    finally:
        spark.conf.set("spark.sql.codegen.fallback", held)
    logit = np.full(len(x), model.intercept)
    for rule, weight in model.rules:
        logit += np.where(quality._holds(rule, x), weight, 0.0)
    assert sorted(r.k for r in found) == np.flatnonzero(1 / (1 + np.exp(-logit)) >= 0.5).tolist()
