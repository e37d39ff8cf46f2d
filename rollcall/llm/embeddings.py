"""Near-duplicate embeddings by product quantisation (Jégou, Douze and Schmid 2011).

1. Vectors become unit vectors; equal rows are one class with a count.
2. A bounded sample gives coarse centroids and, of the residuals to them, a codebook per
   subspace. Every vector gets its inverted list, its codes and its quantisation error. There
   may be several sets of lists, each around centroids of its own.
3. A vector probes the lists whose border lies near enough. A partner at the largest
   distance d may lie behind any border that is at most d away, but only if it lies straight
   behind it. How near those borders are that partners do lie behind is measured on the
   sample, in the directions that its vectors differ by (:func:`calibrated`). Partners have to
   meet in one of the sets only, so each set of several needs far fewer probes; the sample also
   says how many sets compare the fewest pairs (:func:`chosen`). With ``reach=1`` there is one
   set, of which all lists are probed that could hold a partner at all. Pairs that meet in
   several sets count in the first.
4. Within a list, a vector's distances to the codes come from its table of distances to the
   codebooks. A code farther than d plus its own error can't be a partner; the rest are
   decided by their exact cosine.

Lists are cut into blocks on both sides, so that no task holds a whole list, and a
block returns a row per linked vector, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import components
from rollcall.llm.tables import Workspace

#: Vectors that centroids and codebooks are fitted on, at most.
SAMPLE = 16_384
LISTS, SUBSPACES, CODES, ROUNDS = 4096, 8, 256, 8
#: Vectors of a list, and vectors that ask them, in one block.
BLOCK, ASKING = 256, 2048
COSINE = 0.9
#: Vectors of a list on average, as long as there are no more than LISTS of them.
PER_LIST = 50
#: Numbers of sets of lists that are tried, and rounds of k-means for those after the first.
SETS, LATER_ROUNDS = (1, 2, 4), 3
#: Vectors that the reach of probes is measured on, the share of partners to reach, and the margin.
MEASURED, REACHED, MARGIN = 4096, 0.999, 1.1
#: Room for rounding in bounds that must not lose a link.
ROUNDING = 1e-6


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """In slices: all distances at once would take gigabytes of the driver's memory."""
    return np.concatenate([_squares(x[at : at + 512], centres).argmin(1) for at in range(0, len(x), 512)])


def _clustered(x: np.ndarray, k: int, tries: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """k-means; a centre that nobody is nearest to stays where it was."""
    centres = x[tries.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest(x, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


@dataclass(frozen=True)
class Quantizer:
    """Coarse centroids, and a codebook of residuals for each subspace."""

    centroids: np.ndarray
    codebooks: list[np.ndarray]
    cuts: np.ndarray

    def codes(self, residuals: np.ndarray) -> np.ndarray:
        parts = [
            _squares(residuals[:, a:b], book).argmin(1)
            for a, b, book in zip(self.cuts[:-1], self.cuts[1:], self.codebooks, strict=True)
        ]
        return np.stack(parts, axis=1).astype(np.uint8)

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([book[codes[:, k]] for k, book in enumerate(self.codebooks)], axis=1)

    def distances(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """From each vector to what each code of list ``at`` stands for, by table look-ups."""
        residuals = x - self.centroids[at]
        total = np.zeros((len(x), len(codes)))
        for k, book in enumerate(self.codebooks):
            table = _squares(residuals[:, self.cuts[k] : self.cuts[k + 1]], book)
            total += table[:, codes[:, k]]
        return np.sqrt(total)

    def probes(self, x: np.ndarray, far: float) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each vector's list, and the later lists whose border lies within ``far``, its own first."""
        squares = _squares(x, self.centroids)
        own = squares.argmin(1)
        lists, place = np.unique(own, return_inverse=True)
        gaps = np.sqrt(_squares(self.centroids[lists], self.centroids))
        least = squares[np.arange(len(x)), own]
        # The border's distance times twice the gap, which is 0 between equal centroids.
        near = squares - least[:, None] <= 2 * gaps[place] * far + ROUNDING
        near &= np.arange(len(self.centroids)) > own[:, None]
        return own, [np.concatenate(([k], np.flatnonzero(row))) for k, row in zip(own, near, strict=True)]


def _needed(quantizer: Quantizer, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How far the probe of either vector of each pair has to reach to meet the other one's list."""
    lists = np.arange(len(quantizer.centroids))
    out = np.zeros(len(x))
    for at in range(0, len(x), 512):
        of_x, of_y = (_squares(v[at : at + 512], quantizer.centroids) for v in (x, y))
        a, b, row = of_x.argmin(1), of_y.argmin(1), np.arange(len(of_x))
        # The one in the earlier list asks.
        asks = np.where((a < b)[:, None], of_x, of_y)
        first, other = lists[np.minimum(a, b)], lists[np.maximum(a, b)]
        gap = np.sqrt(((quantizer.centroids[first] - quantizer.centroids[other]) ** 2).sum(1))
        beyond = (asks[row, other] - asks[row, first]) / (2 * np.where(gap > 0, gap, 1))
        out[at : at + 512] = np.where(a == b, 0.0, np.maximum(0.0, beyond))
    return out


def _reaches(sets: list[Quantizer], x: np.ndarray, cosine: float, seed: int = 4) -> list[float]:
    """What :func:`calibrated` says of the first set, the first two, and so on."""
    tries = np.random.default_rng(seed)
    x = x[tries.permutation(len(x))[:MEASURED]]
    own = _nearest(x, sets[0].centroids)
    by_list = np.argsort(own, kind="stable")
    begin, end = np.searchsorted(own[by_list], own), np.searchsorted(own[by_list], own, "right")
    # Two of the list, or of all where it has too few.
    few = end - begin < 3
    begin, end = np.where(few, 0, begin), np.where(few, len(x), end)
    turn = x[by_list[tries.integers(begin, end)]] - x[by_list[tries.integers(begin, end)]]
    turn -= (turn * x).sum(1, keepdims=True) * x
    length = np.linalg.norm(turn, axis=1)
    fine = length > ROUNDING
    if not fine.any():
        return [1.0] * len(sets)
    partner = cosine * x[fine] + np.sqrt(1 - cosine**2) * turn[fine] / length[fine, None]
    i, j = np.nonzero(np.triu(x @ x.T >= cosine, 1))
    some = tries.permutation(len(i))[: 4 * MEASURED]
    out = np.zeros(len(sets))
    for a, b in ((x[fine], partner), (x[i[some]], x[j[some]])):
        if len(a):
            least = np.minimum.accumulate([_needed(quantizer, a, b) for quantizer in sets])
            out = np.maximum(out, MARGIN * np.quantile(least, REACHED, axis=1) / np.sqrt(2 - 2 * cosine))
    return np.minimum(1.0, out).tolist()


def calibrated(quantizer: Quantizer, x: np.ndarray, cosine: float, others: tuple[Quantizer, ...] = ()) -> float:
    """The share of the largest distance between partners within which a border lies that a partner is behind.

    Measured on partners at the threshold, the farthest there are: each vector of a sample is turned
    towards the difference of two vectors of its own list, so that partners lie in the
    directions in which the data spreads; and on linked pairs of the sample itself, whichever
    takes more. With several sets of lists, one of them has to bring partners together.
    """
    return _reaches([quantizer, *others], x, cosine)[-1]


def chosen(sets: list[Quantizer], x: np.ndarray, cosine: float) -> tuple[list[Quantizer], float]:
    """So many of the sets that a vector is compared with the fewest others, and their reach."""
    reaches, far = _reaches(sets, x, cosine), np.sqrt(2 - 2 * cosine)
    x, best = x[:MEASURED], []
    for n in SETS:
        compared = 0
        for quantizer in sets[:n]:
            parts = [quantizer.probes(x[at : at + 512], far * reaches[n - 1]) for at in range(0, len(x), 512)]
            sizes = np.bincount(np.concatenate([own for own, _ in parts]), minlength=len(quantizer.centroids))
            compared += sum(int(sizes[lists].sum()) for _, probes in parts for lists in probes)
        best.append((compared, n))
    n = min(best)[1]
    return sets[:n], reaches[n - 1]


def fit_quantizer(x: np.ndarray, lists: int, seed: int = 3) -> Quantizer:
    tries = np.random.default_rng(seed)
    centroids = _clustered(x, lists, tries)
    residuals = x - centroids[_nearest(x, centroids)]
    cuts = np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int)
    books = [_clustered(residuals[:, a:b], CODES, tries) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return Quantizer(centroids, books, cuts)


def fit_sets(x: np.ndarray, lists: int, seed: int = 5) -> list[Quantizer]:
    """As many sets as are tried at most; the later ones have centroids of a part of the sample and the same codebooks."""
    tries, first = np.random.default_rng(seed), fit_quantizer(x, lists)
    part = max(4 * lists, MEASURED)
    later = (_clustered(x[tries.permutation(len(x))[:part]], lists, tries, LATER_ROUNDS) for _ in range(max(SETS) - 1))
    return [first, *(replace(first, centroids=c) for c in later)]


def _units(vectors: pd.Series, width: int) -> np.ndarray:
    """Unit vectors in double precision; shorter ones end in zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)  # else squares may overflow or vanish
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _keys(probes: pd.Series, lists: int) -> np.ndarray:
    """Row and list in one number, of the probes of each row to the first so many lists."""
    of_row = [p[p < lists].astype(np.int64) + k * lists for k, p in enumerate(map(np.asarray, probes))]
    return np.concatenate(of_row)


def _labelled(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of n reaches over the links i - j."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked_vectors(
    vectors: DataFrame, work: Workspace, cosine: float = COSINE, bound: int = SAMPLE, reach: float | None = None
) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, embedding).

    n_links counts the other rows at a cosine of ``cosine`` or more in double precision,
    component_id is the smallest vec_id reachable over such links, the own one included, and
    kept says that it is the row's own.

    Vectors that are null, empty, zero or hold null, NaN or infinite components link with
    nothing. Shorter vectors count as ending in zeros. Rows without a vec_id link with nothing,
    have a null component and stay kept. Equal rows are compared once and counted by their
    number. No rows give no rows. Other columns aren't read.

    ``reach`` is how much of the largest distance between partners may lie across one border:
    1 loses no link on any data. None, the default, measures on the sample how much it takes
    for all but a thousandth of the farthest partners, and in how many sets of lists they are best
    looked for.
    """
    spark = vectors.sparkSession
    kind = "array<double>"
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = fine & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    usable = F.coalesce(usable, F.lit(False))
    rows = vectors.select("vec_id", "embedding", usable.alias("usable"))
    rows = rows.withColumns({"print_1": F.xxhash64("embedding"), "print_2": F.xxhash64(F.lit(1), "embedding")})
    same = ["print_1", "print_2"]
    classes = work.write(
        rows.where("usable")
        .groupBy(*same)
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min_by("embedding", "vec_id").alias("embedding")),
        "classes",
    )
    count, width = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    lone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if not count:
        return lone
    sample = classes.where(F.pmod("print_1", F.lit(1 << 20)) < int(min(1.0, bound / count) * (1 << 20)) + 1)
    sample = sample.orderBy("print_1", "print_2").limit(bound).select("embedding").toPandas()["embedding"]
    far = float(np.sqrt(2 - 2 * cosine)) + ROUNDING
    lists = int(min(LISTS, max(1, round(count / PER_LIST))))
    sample = _units(sample, width)
    if reach is None:
        fitted, reach = chosen(fit_sets(sample, lists), sample, cosine)
    else:
        fitted = [fit_quantizer(sample, lists)]
    within, lists = far * min(1.0, reach), len(fitted[0].centroids)
    sets, length = spark.sparkContext.broadcast(fitted), len(fitted[0].codebooks)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.iloc[start : start + 1024]
                x = _units(part["embedding"], width)
                homes, probes, codes, errors = [], [], [], []
                for k, q in enumerate(sets.value):
                    own, asked = q.probes(x, within)
                    residuals = x - q.centroids[own]
                    codes.append(q.codes(residuals))
                    errors.append(np.sqrt(((residuals - q.decoded(codes[-1])) ** 2).sum(1)))
                    homes.append(own + k * lists)
                    probes.append([p + k * lists for p in asked])
                yield pd.DataFrame(
                    {
                        "rep": part["rep"].to_numpy(),
                        "copies": part["copies"].to_numpy(),
                        "unit": list(x),
                        "homes": list(np.stack(homes, axis=1)),
                        "codes": [c.tobytes() for c in np.concatenate(codes, axis=1)],
                        "errors": list(np.stack(errors, axis=1)),
                        "probes": [np.concatenate(p) for p in zip(*probes, strict=True)],
                    }
                )

    # Lists of all sets are numbered one after the other.
    indexed = work.write(
        classes.select("rep", "copies", "embedding").mapInPandas(
            index,
            "rep long, copies long, unit array<double>, homes array<int>, codes binary, errors array<double>, probes array<int>",
        ),
        "indexed",
    )
    asking = indexed.select("rep", F.explode("probes").alias("at"))
    sizes = indexed.select(F.explode("homes").alias("at")).groupBy("at").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    askers = asking.groupBy("at").agg(F.ceil(F.count("*") / ASKING).alias("asking"))
    blocks = work.write(sizes.join(askers, "at"), "blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    # What tells whether a pair has met before, which it can't in a single set.
    indexed = indexed.withColumn("reached", F.col("probes") if len(fitted) > 1 else F.array().cast("array<int>"))
    columns = ["at", "block", "asker", "role", "rep", "copies", "unit", "codes", "error", "homes", "reached"]
    members = (
        indexed.select("*", F.posexplode("homes").alias("set", "at"))
        .withColumns({"codes": F.substring("codes", F.col("set") * length + 1, F.lit(length)), "error": F.get("errors", F.col("set"))})
        .join(blocks, "at")
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
        .withColumn("asker", every("asking"))
        .withColumn("role", F.lit(0))
    )
    queries = (
        indexed.withColumn("at", F.explode("probes"))
        .join(blocks, "at")
        .withColumn("asker", F.pmod(F.xxhash64(F.lit(1), "rep"), "asking"))
        .withColumn("block", every("blocks"))
        .withColumns({"role": F.lit(1), "codes": F.lit(None).cast("binary"), "error": F.lit(None).cast("double")})
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        ours, theirs = frame[frame["role"] == 1], frame[frame["role"] == 0]
        at = int(frame["at"].iloc[0])
        own = at // lists
        empty = pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        if not len(ours) or not len(theirs):
            return empty
        x, y = np.stack(ours["unit"].to_list()), np.stack(theirs["unit"].to_list())
        codes = np.frombuffer(b"".join(theirs["codes"]), np.uint8).reshape(len(theirs), -1)
        of_x, of_y = ours["rep"].to_numpy(), theirs["rep"].to_numpy()
        home_x, home_y = np.stack(ours["homes"].to_list()), np.stack(theirs["homes"].to_list())
        # Pairs within a list are met from both sides.
        new = (home_x[:, own] != at)[:, None] | (of_y > of_x[:, None])
        for k in range(own):
            new &= home_x[:, k, None] != home_y[:, k]
        if not new.any():
            return empty
        near = sets.value[own].distances(x, at % lists, codes) <= theirs["error"].to_numpy() + far + ROUNDING
        i, j = np.nonzero(near & new)
        exact = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
        i, j = i[exact], j[exact]
        if own and len(i):
            asked_x, asked_y = _keys(ours["reached"], lists * own), _keys(theirs["reached"], lists * own)
            before = np.zeros(len(i), bool)
            for k in range(own):
                before |= np.isin(i * lists * own + home_y[j, k], asked_x) | np.isin(j * lists * own + home_x[i, k], asked_y)
            i, j = i[~before], j[~before]
        if not len(i):
            return empty
        names, number = np.unique(np.concatenate((of_x[i], of_y[j])), return_inverse=True)
        a, b = number[: len(i)], number[len(i) :]
        links = np.zeros(len(names), np.int64)
        np.add.at(links, a, theirs["copies"].to_numpy()[j])
        np.add.at(links, b, ours["copies"].to_numpy()[i])
        return pd.DataFrame({"rep": names, "links": links, "root": names[_labelled(a, b, len(names))]})

    found = (
        members.select(columns)
        .unionByName(queries.select(columns))
        .groupBy("at", "block", "asker")
        .applyInPandas(compare, "rep long, links long, root long")
    )
    found = work.write(found, "found")
    work.remove("indexed")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), work)
    of_class = (
        classes.select(*same, "rep", "copies")
        .join(counts, "rep", "left")
        .join(joined.toDF("rep", "component"), "rep", "left")
        .select(
            *same,
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    linked = rows.where("usable").join(of_class, same).select(
        "vec_id",
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        (F.col("vec_id") == F.col("component")).alias("kept"),
    )
    return linked.unionByName(lone)
