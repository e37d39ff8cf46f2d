"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability from its words and their
beginnings, as languages inflect words at their ends, and the document is toxic unless all of its sentences are clean: P = 1 - prod(1 - p) (noisy-or).
Only documents have labels; the gradient of their likelihood reaches the sentences'
words through the noisy-or, and the sentences that carry a document's score are then
read off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.labels import held_out, sampled, training_labels
from rollcall.llm.words import NOT_ALPHANUMERIC, slices, text_column, words

#: Labelled rows that the classifier is fitted on, at most, and the features' hash range.
SAMPLE = 8_000
SLOTS = 1 << 21
THRESHOLD = 0.3
#: Lengths of word beginnings that are features beside the words themselves.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Features enter training from so many documents on, if they are commoner in toxic ones by this
#: chi-squared, and at most so many of the highest.
LEAST_DOCUMENTS, LEAST_CHI, FEATURES = 4, 15.0, 20_000
STEPS, RATE, PENALTY, START = 300, 0.1, 1e-4, -6.0

_ENDS = r"[.!?\n]"


@dataclass(frozen=True)
class Sentences:
    """Features of distinct words, the words in order, and where sentences and rows begin and end.

    A word has a slot for itself and for each of its beginnings, and -1 for those
    longer than the word.
    """

    features: np.ndarray
    words: np.ndarray
    sentences: np.ndarray
    rows: np.ndarray


def _slots(word: str) -> list[int]:
    own = [xxhash.xxh3_64_intdigest(word) % SLOTS]
    return own + [xxhash.xxh3_64_intdigest(word[:k], seed=k) % SLOTS if len(word) >= k else -1 for k in BEGINNINGS]


def _split(column: pa.Array) -> pa.ListArray:
    return pc.split_pattern_regex(text_column(column), _ENDS)


def _bags(column: pa.Array) -> Sentences:
    """Sentences end at . ! ? and line ends; words are lower-cased ASCII alphanumerics and all else that isn't ASCII."""
    parts = _split(column)
    values, places = words(parts.flatten(), NOT_ALPHANUMERIC)
    coded = values.dictionary_encode()
    features = [_slots(word) for word in coded.dictionary.to_pylist()]
    features = np.array(features, np.int32).reshape(-1, 1 + len(BEGINNINGS))
    rows = np.asarray(parts.offsets, np.int64)
    return Sentences(features, np.asarray(coded.indices, np.int64), places, rows - rows[0])


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _sums(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[places[1:]] - total[places[:-1]]


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of some slots, and the logit of a sentence without any of them."""

    weights: dict[int, float]
    start: float

    def sentence_logits(self, bags: Sentences) -> np.ndarray:
        dense = np.zeros(SLOTS + 1)  # the last one stands for -1
        dense[list(self.weights)] = list(self.weights.values())
        of_word = dense[bags.features].sum(axis=1)
        return self.start + _sums(of_word[bags.words], bags.sentences)

    def scores(self, bags: Sentences) -> np.ndarray:
        """Noisy-or of each row's sentences."""
        clean = _softplus(self.sentence_logits(bags))
        return np.clip(-np.expm1(-_sums(clean, bags.rows)), 0.0, 1.0)


def fit(slots: np.ndarray, sentence: np.ndarray, row: np.ndarray, y: np.ndarray) -> ToxicityModel:
    """Maximise the documents' likelihood under noisy-or, with small weights pulled to zero.

    ``slots`` and ``sentence`` say which sentence has which feature, ``row`` whose each sentence
    is. Without labels of both kinds, nothing has a weight.
    """
    if not len(y) or y.min() == y.max():
        return ToxicityModel({}, START)
    names, feature = np.unique(slots, return_inverse=True)
    w, start = np.zeros(len(names)), START
    m, v, m0, v0 = np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = start + np.bincount(sentence, w[feature], len(row))
        hazard = np.bincount(row, _softplus(z), len(y))
        pull = np.where(y > 0, -1 / np.expm1(np.clip(hazard, 1e-6, 50)), 1.0) / len(y)
        g = pull[row] / (1 + np.exp(-np.clip(z, -30, 30)))
        grad = np.bincount(feature, g[sentence], len(names))
        g0 = float(g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        m0, v0 = 0.9 * m0 + 0.1 * g0, 0.99 * v0 + 0.01 * g0**2
        rate = RATE * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step)
        scale = np.sqrt(v) + 1e-5
        w = w - rate * m / scale
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * PENALTY / scale)
        start -= rate * m0 / (v0**0.5 + 1e-5)
    return ToxicityModel({int(k): float(x) for k, x in zip(names, w, strict=True) if x}, float(start))


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, label and the distinct slots of each row."""
    for batch in slices(batches, 2):
        bags = _bags(batch.column(2))
        ends = bags.sentences[bags.rows]
        slots = [np.unique(bags.features[np.unique(bags.words[a:b])]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        slots = pa.array([x[x >= 0] for x in slots], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), slots], ["doc_id", "label", "slots"])


def _chosen_features(rows: DataFrame) -> np.ndarray:
    """Slots that are commoner in toxic rows, by chi-squared over rows that have them."""
    present = rows.mapInArrow(_present, "doc_id long, label int, slots array<int>")
    toxic, total = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    counts = present.select("label", F.explode("slots").alias("slot")).groupBy("slot")
    counts = counts.agg(F.sum("label").cast("double").alias("p"), F.count("*").cast("double").alias("n"))
    p, n, all_p, all_n = F.col("p"), F.col("n"), F.lit(float(toxic)), F.lit(float(total))
    chi = all_n * (p * (all_n - n - all_p + p) - (n - p) * (all_p - p)) ** 2 / (n * (all_n - n) * all_p * (all_n - all_p))
    commoner = (n >= LEAST_DOCUMENTS) & (n < all_n) & (p * all_n > n * all_p)
    best = counts.where(commoner).select("slot", chi.alias("chi")).where(F.col("chi") >= LEAST_CHI)
    found = best.orderBy(F.desc("chi"), "slot").limit(FEATURES).toPandas()["slot"]
    return np.sort(found.to_numpy(np.int32))


def _encoded(chosen: np.ndarray):
    """Per row the chosen features of its sentences, and the number of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(SLOTS + 1, bool)
        known[chosen] = True
        for batch in slices(batches, 2):
            bags = _bags(batch.column(2))
            of_word = known[bags.features]
            sentence = np.repeat(np.arange(len(bags.sentences) - 1), np.diff(bags.sentences))
            at = np.flatnonzero(of_word.any(axis=1)[bags.words])
            word, feature = np.nonzero(of_word[bags.words[at]])
            slots, sentence = bags.features[bags.words[at]][word, feature], sentence[at][word]
            ends = np.searchsorted(sentence, bags.rows)
            pieces = lambda x: [x[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            own = [x - start for x, start in zip(pieces(sentence), bags.rows[:-1], strict=True)]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pieces(slots), ints), pa.array(own, ints), pa.array(np.diff(bags.rows), pa.int32())],
                ["doc_id", "label", "slots", "sentence", "sentences"],
            )

    return run


def train_toxicity(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> ToxicityModel:
    """Fit on at most about ``bound`` rows of ``documents`` that have a training label."""
    text = F.col("text").cast("string").alias("text")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    rows = rows.join(training_labels(labels, "toxic", bound), "doc_id").select("doc_id", "label", "text")
    chosen = _chosen_features(rows)
    coded = rows.mapInArrow(
        _encoded(chosen), "doc_id long, label int, slots array<int>, sentence array<int>, sentences int"
    )
    found = sampled(coded, bound).toPandas()
    if not len(found):
        return ToxicityModel({}, START)
    sizes = found["sentences"].to_numpy(np.int64)
    first = np.cumsum(sizes) - sizes
    slots = np.concatenate([np.asarray(x, np.int64) for x in found["slots"]])
    sentence = np.concatenate([np.asarray(x, np.int64) + k for x, k in zip(found["sentence"], first, strict=True)])
    return fit(slots, sentence, np.repeat(np.arange(len(sizes)), sizes), found["label"].to_numpy(float))


def scored_toxicity(
    documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = SAMPLE, located: float = 0.5
) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, worst, offending per row of (doc_id, text).

    score is the noisy-or of all sentences of the whole text; predicted is 1 from
    ``threshold`` on. offending counts sentences of probability ``located`` or more, worst is
    the place of the likeliest sentence, from 0 (the first of equals).

    Null and empty texts are one empty sentence, whose score is the model's floor. A
    null doc_id isn't held out. Repeated rows score alike. Without training labels of
    both kinds all scores are the floor of their sentences. No rows give no rows.
    """
    model = documents.sparkSession.sparkContext.broadcast(train_toxicity(documents, labels, bound))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            bags = _bags(batch.column(2))
            logits = model.value.sentence_logits(bags)
            high = logits >= np.log(located / (1 - located))
            worst = [int(np.argmax(logits[a:b])) for a, b in zip(bags.rows[:-1], bags.rows[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(model.value.scores(bags)),
                    pa.array(np.diff(bags.rows), pa.int64()),
                    pa.array(worst, pa.int64()),
                    pa.array(_sums(high, bags.rows).astype(np.int64)),
                ],
                ["doc_id", "held_out", "score", "n_sentences", "worst", "offending"],
            )

    doc_id = F.col("doc_id").cast("long")
    rows = documents.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    scores = rows.mapInArrow(
        run, "doc_id long, held_out boolean, score double, n_sentences long, worst long, offending long"
    )
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scores.select("doc_id", "held_out", "score", predicted, "n_sentences", "worst", "offending")


def offending_sentences(documents: DataFrame, model: ToxicityModel, located: float = 0.5) -> DataFrame:
    """doc_id, place, sentence, probability of every sentence of probability ``located`` or more."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            bags = _bags(batch.column(1))
            p = 1 / (1 + np.exp(-np.clip(shared.value.sentence_logits(bags), -30, 30)))
            row = np.repeat(np.arange(len(bags.rows) - 1), np.diff(bags.rows))
            at = np.flatnonzero(p >= located)
            texts = _split(batch.column(1)).flatten().take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row[at])),
                    pa.array(at - bags.rows[row[at]], pa.int64()),
                    texts.cast(pa.string()),
                    pa.array(p[at]),
                ],
                ["doc_id", "place", "sentence", "probability"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, place long, sentence string, probability double")
