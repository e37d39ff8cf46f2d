"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Spark computes statistics of every text.
2. Shallow trees, each grown on a random part of a bounded labelled sample, give their
   paths as conjunctions of bounds on statistics (Friedman and Popescu 2008).
3. Lasso logistic regression weighs the rules; most weights are zero.
4. What is left becomes one Spark column expression that reads the rules as data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rollcall.llm.labels import held_out, sampled, training_labels
from rollcall.llm.tables import Workspace
from rollcall.llm.words import BLANKS, hashed, slices, text_bytes, text_column, words

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 20_000
THRESHOLD = 0.7
TREES, DEPTH, BINS, LEAF = 60, 3, 32, 3
PENALTY = 5e-4

#: Classes of bytes that texts are counted by.
_KINDS = {
    "upper": bytes(range(0x41, 0x5B)),
    "lower": bytes(range(0x61, 0x7B)),
    "digit": bytes(range(0x30, 0x3A)),
    "blank": BLANKS.replace(b"\n", b""),
    "line": b"\n",
    "stop": b".,;:",
    "call": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "mark": b"\"'()-",
}
_KIND = np.full(256, len(_KINDS), np.uint8)
_KIND[:0x80] = len(_KINDS) + 1
for _number, _bytes in enumerate(_KINDS.values()):
    _KIND[list(_bytes)] = _number
_CLASSES = len(_KINDS) + 2

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "line_words", "upper", "digit", "stop", "call", "bar", "symbol",
    "mark", "wide", "control", "distinct", "repeated", "top",
)


def _statistics(column: pa.Array) -> np.ndarray:
    """A row of statistics per text; all zero for a text without bytes."""
    texts = text_column(column)
    offsets, data = text_bytes(texts)
    kinds = _KIND[np.frombuffer(data, np.uint8)]
    values, rows = words(texts)
    word = hashed(values)
    out = np.zeros((len(texts), len(STATISTICS)))
    for i in range(len(texts)):
        size = int(offsets[i + 1] - offsets[i])
        if not size:
            continue
        n = np.bincount(kinds[offsets[i] : offsets[i + 1]], minlength=_CLASSES)
        upper, lower, digit, _, lines, stop, call, bar, symbol, mark, wide, control = n.tolist()
        own = word[rows[i] : rows[i + 1]]
        count = max(1, len(own))
        each = np.unique(own, return_counts=True)[1]
        out[i] = (
            np.log1p(size), np.log1p(len(own)), size / count, len(own) / (lines + 1), upper / max(1, upper + lower), digit / size,
            stop / size, call / size, bar / size, symbol / size, mark / size, wide / size, control / size,
            len(each) / count, np.count_nonzero(own[1:] == own[:-1]) / count, each.max(initial=0) / count,
        )
    return out


def _as_struct(text: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    parts = [_statistics(part.column(0)) for part in slices([batch], 0)]
    found = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
    return pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(STATISTICS))], list(STATISTICS))


def statistics(text: Column) -> Column:
    """The statistics of a text as a struct column."""
    kind = StructType([StructField(name, DoubleType()) for name in STATISTICS])
    return F.arrow_udf(_as_struct, kind)(text)


@dataclass(frozen=True)
class Bound:
    """One condition of a rule: a statistic above a value, or at most that value."""

    statistic: int
    above: bool
    value: float


Rule = frozenset[Bound]


def _grown(binned: np.ndarray, edges: list[np.ndarray], y: np.ndarray, tries: np.random.Generator) -> list[Rule]:
    """All paths of one tree: per node the split that lowers the squared error most."""
    rules: list[Rule] = []

    def grow(rows: np.ndarray, path: dict[tuple[int, bool], float], depth: int) -> None:
        if path:
            rules.append(frozenset(Bound(k, above, value) for (k, above), value in path.items()))
        if depth == DEPTH or len(rows) < 2 * LEAF or np.ptp(y[rows]) == 0:
            return
        best, found = 1e-9, None
        total, n = y[rows].sum(), len(rows)
        for k in tries.choice(binned.shape[1], max(1, binned.shape[1] // 2), replace=False):
            bins = binned[rows, k]
            left_n = np.cumsum(np.bincount(bins, minlength=BINS + 1))[:-1]
            left = np.cumsum(np.bincount(bins, y[rows], BINS + 1))[:-1]
            right_n = n - left_n
            fits = (left_n >= LEAF) & (right_n >= LEAF)
            gain = np.where(
                fits, left**2 / np.maximum(left_n, 1) + (total - left) ** 2 / np.maximum(right_n, 1) - total**2 / n, 0.0
            )
            at = int(np.argmax(gain))
            if gain[at] > best and at < len(edges[k]):
                best, found = gain[at], (int(k), at)
        if found:
            k, at = found
            above = binned[rows, k] > at
            value = float(edges[k][at])
            grow(rows[~above], path | {(k, False): value}, depth + 1)
            grow(rows[above], path | {(k, True): value}, depth + 1)

    grow(tries.choice(len(y), max(1, len(y) // 2), replace=False), {}, 0)
    return rules


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for b in rule:
        out &= x[:, b.statistic] > b.value if b.above else x[:, b.statistic] <= b.value
    return out


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of L1-penalised logistic regression, by accelerated proximal steps.

    ``x`` holds 0 and 1 in 32 bits, and is overwritten.
    """
    mean = x.mean(axis=0, dtype=np.float64)
    scale = np.sqrt(mean * (1 - mean)) + 1e-9
    # In place: x is the largest thing that the driver holds.
    z = x
    z -= mean.astype(np.float32)
    z /= scale.astype(np.float32)
    # A Lipschitz bound of the gradient by a few power iterations.
    v = np.ones(z.shape[1], np.float32)
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v) + 1e-9
    rate = 4.0 / max(1e-9, float(np.linalg.norm(z @ v) ** 2) / len(z) * 1.05 + 1)
    w, ahead = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    b = b_ahead = float(np.log(share / (1 - share)))
    t = 1.0
    for _ in range(steps):
        off = 1 / (1 + np.exp(-np.clip(z @ ahead.astype(np.float32) + b_ahead, -30, 30))) - y
        step = ahead - rate * (z.T @ off.astype(np.float32)) / len(y)
        new = np.sign(step) * np.maximum(0, np.abs(step) - rate * penalty)
        b_new = b_ahead - rate * float(off.mean())
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, b_ahead = new + (t - 1) / t_new * (new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = new, b_new, t_new
    return w / scale, b - float((w / scale * mean).sum())


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules over statistics."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def column(self, stats: str) -> Column:
        """The probability of label 1 from a struct column of statistics."""
        # Rules are data, not code: an expression of several hundred conditions would take more of the
        # driver's memory to plan than the training, and its code is too long to compile.
        side = lambda rule, above: [
            {"statistic": b.statistic, "value": b.value} for b in sorted(rule, key=lambda b: b.statistic) if b.above == above
        ]
        rules = [{"weight": w, "over": side(rule, True), "upto": side(rule, False)} for rule, w in self.rules]
        bounds = "array<struct<statistic:int,value:double>>"
        rules = F.from_json(F.lit(json.dumps(rules)), f"array<struct<weight:double,over:{bounds},upto:{bounds}>>")
        values = F.array(*(F.col(f"{stats}.{name}") for name in STATISTICS))

        def logit(x: Column) -> Column:
            def added(total: Column, rule: Column) -> Column:
                over = F.forall(rule["over"], lambda b: F.get(x, b["statistic"]) > b["value"])
                upto = F.forall(rule["upto"], lambda b: F.get(x, b["statistic"]) <= b["value"])
                return total + F.when(over & upto, rule["weight"]).otherwise(0.0)

            return F.aggregate(rules, F.lit(self.intercept), added)

        # A lambda's argument is computed once per row.
        return 1 / (1 + F.exp(-F.get(F.transform(F.array(values), logit), F.lit(0))))

    def text(self) -> list[str]:
        """The rules in words, the heaviest first."""
        return [
            f"{weight:+.3f}  " + " and ".join(
                sorted(f"{STATISTICS[b.statistic]} {'>' if b.above else '<='} {b.value:.4g}" for b in rule)
            )
            for rule, weight in sorted(self.rules, key=lambda x: -abs(x[1]))
        ]


UNTRAINED = RuleEnsemble((), 0.0)


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 5, penalty: float = PENALTY) -> RuleEnsemble:
    """Trees to rules to lasso weights. Without rows the score is 0.5; with one label, near it."""
    if not len(y):
        return UNTRAINED
    tries = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(edges[k], x[:, k], "left") for k in range(x.shape[1])], axis=1)
    rules = dict.fromkeys(rule for _ in range(TREES) for rule in _grown(binned, edges, y.astype(float), tries))
    if not rules:
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        return RuleEnsemble((), float(np.log(share / (1 - share))))
    # Rules that hold for the same rows of the sample are one.
    distinct: dict[bytes, Rule] = {}
    for rule in sorted(rules, key=lambda r: (len(r), sorted((b.statistic, b.above, b.value) for b in r))):
        distinct.setdefault(np.packbits(_holds(rule, x)).tobytes(), rule)
    kept = list(distinct.values())
    columns = np.empty((len(x), len(kept)), np.float32)
    for k, held in enumerate(distinct):
        columns[:, k] = np.unpackbits(np.frombuffer(held, np.uint8), count=len(x))
    weights, intercept = _lasso(columns, y, penalty)
    chosen = [(rule, float(w)) for rule, w in zip(kept, weights, strict=True) if abs(w) > 1e-6]
    return RuleEnsemble(tuple(chosen), float(intercept))


def train_quality(features: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> RuleEnsemble:
    """Fit on at most ``bound`` rows of ``features`` (doc_id, stats) that have a training label."""
    rows = features.join(training_labels(labels, "quality", bound), "doc_id").select("doc_id", "label", "stats.*")
    found = sampled(rows, bound).toPandas()
    return fit_rules(found[list(STATISTICS)].to_numpy(float), found["label"].to_numpy(float))


def with_statistics(documents: DataFrame, work: Workspace) -> DataFrame:
    """(doc_id, stats) of every document, written once."""
    return work.write(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), statistics(F.col("text").cast("string")).alias("stats")),
        "statistics",
    )


def scored_quality(
    documents: DataFrame, labels: DataFrame, work: Workspace, threshold: float = THRESHOLD, bound: int = SAMPLE
) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``documents`` (doc_id, text).

    score is the probability of label 1 by the statistics of the whole text alone;
    predicted is 1 from ``threshold`` on. Only labels outside the test split are learnt.

    Null texts score like empty ones: all their statistics are 0. A null doc_id isn't
    held out. Repeated rows score alike. Without training labels every score is 0.5. No
    rows give no rows. Other columns aren't read.
    """
    features = with_statistics(documents, work)
    model = train_quality(features, labels, bound)
    scores = features.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column("stats").alias("score"))
    return scores.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def of_quality(
    documents: DataFrame, labels: DataFrame, work: Workspace, threshold: float = THRESHOLD, bound: int = SAMPLE
) -> DataFrame:
    """The rows of ``documents``, all columns as they are, that score ``threshold`` or more.

    Without training labels nothing can be rejected, and all rows stay.
    """
    name = "stats"
    while name in documents.columns:
        name += "_"
    # Texts and their statistics are written together: one pass of Python over the texts.
    scored = work.write(documents.withColumn(name, statistics(F.col("text").cast("string"))), "measured")
    features = scored.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).alias("stats"))
    # Plans of what is over leave the driver before it trains, and those of the training before
    # the rules, a long expression, are planned.
    work.let_go()
    model = train_quality(features, labels, bound)
    work.let_go()
    if model != UNTRAINED:
        scored = scored.where(model.column(name) >= threshold)
    return scored.select(*documents.columns)
