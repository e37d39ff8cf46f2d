"""Line deduplication with levelled sorted runs of line hashes.

Documents arrive in batches, those of the largest doc_id first, so that a line's keeper is in
the first batch that has it. A batch's line keys, with the number of documents and the largest
doc_id of each, are merge-anti-joined with the keys already known to repeat; what is
left becomes a sorted run of its own. Every ``FANOUT`` runs of a level are compacted to one run
of the next, which adds up their numbers; keys that reach the limit there leave for the table of
repeated keys and are never counted again. In the end all runs are merged once, and lines of
repeated keys are anti-joined away from all documents but their keepers.

The joins are merge joins at every size, since both of their sides grow with the corpus. Only
DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.tables import Workspace

LEAST_CHARACTERS = 40
LEAST_DOCUMENTS = 5
BATCHES = 4
#: Runs of one level that make one of the next.
FANOUT = 2
BLANK = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["hash_1", "hash_2"]


def lowered(text: Column) -> Column:
    """A-Z in lower case. Where all characters are ASCII that is what ``lower`` does."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


class Runs:
    """Levels of sorted runs of (hash_1, hash_2, documents, keeper), and the repeated keys."""

    def __init__(self, work: Workspace, least_documents: int):
        self.work, self.least, self.written = work, least_documents, 0
        self.levels: list[list[str]] = []
        self.repeated: list[str] = []

    def _write(self, frame: DataFrame, kind: str) -> str:
        self.written += 1
        name = f"{kind}-{self.written}"
        self.work.write(frame.sortWithinPartitions(*_KEY), name)
        return name

    def _union(self, names: list[str]) -> DataFrame:
        frames = [self.work.read(name) for name in names]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def _merged(self, names: list[str]) -> DataFrame:
        return self._union(names).groupBy(*_KEY).agg(F.sum("documents").alias("documents"), F.max("keeper").alias("keeper"))

    def add(self, keys: DataFrame) -> None:
        """Anti-join a batch's keys with the repeated ones and keep the rest as a run."""
        if self.repeated:
            keys = keys.join(self._union(self.repeated).select(*_KEY).hint("merge"), _KEY, "left_anti")
        name = self._write(keys, "run")
        for level in range(len(self.levels) + 1):
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(name)
            if len(self.levels[level]) < FANOUT:
                return
            old, self.levels[level] = self.levels[level], []
            self.written += 1
            whole = f"merged-{self.written}"
            merged = self.work.write(self._merged(old), whole)
            repeats = F.col("documents") >= self.least
            self.repeated.append(self._write(merged.where(repeats), "repeated"))
            name = self._write(merged.where(~repeats), "run")
            for done in [*old, whole]:
                self.work.remove(done)

    def keepers(self) -> DataFrame:
        """Repeated keys and the largest doc_id that has each, over all runs."""
        names = [*self.repeated, *(name for level in self.levels for name in level)]
        return self._merged(names).where(F.col("documents") >= self.least).select(*_KEY, "keeper")


def row_hash(*columns: str) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(*columns)


def without_repeated_lines(
    documents: DataFrame,
    work: Workspace,
    least_characters: int = LEAST_CHARACTERS,
    least_documents: int = LEAST_DOCUMENTS,
    batches: int = BATCHES,
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept per row of ``documents`` (doc_id, text).

    Lines end at \\n. A line's key is the line without ASCII white space at both ends and with A-Z
    in lower case. Keys of at least ``least_characters`` code points that stand in at least
    ``least_documents`` documents lose all lines but those of the largest doc_id that has
    one; kept is the rest of the text, joined by \\n.

    Null and empty texts are one empty line. Rows of one doc_id count as one document and
    all keep or lose a line alike. Rows without a doc_id count as one document, smaller than
    all others. Texts of any length and number of lines work. No rows give no rows. Other
    columns aren't read.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    # Rows are told apart by their id and a hash; a missing id is as good as any.
    rows = rows.withColumns({"id": F.coalesce("doc_id", F.lit(0)), "row": row_hash("doc_id", "text")})
    # Batches of about equal numbers of rows, the largest ids first.
    shares = [k / batches for k in range(batches - 1, 0, -1)]
    borders = rows.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] or []
    batch = F.lit(0)
    for border in borders:
        batch = batch + F.coalesce(F.col("doc_id") < border, F.lit(True)).cast("int")
    keys = F.transform(F.split(lowered(F.col("text")), "\n"), lambda line: F.btrim(line, F.lit(BLANK)))
    lines = rows.select("doc_id", "id", "row", batch.alias("batch"), F.posexplode(keys).alias("place", "key"))
    lines = lines.where(F.char_length("key") >= least_characters).select(
        "doc_id", "id", "row", "batch", "place", F.xxhash64("key").alias("hash_1"), F.xxhash64(F.lit(1), "key").alias("hash_2")
    )
    lines = work.write(lines, "lines")

    runs = Runs(work, least_documents)
    for number in range(len(borders) + 1):
        own = lines.where(F.col("batch") == number).select(*_KEY, "doc_id").distinct()
        runs.add(own.groupBy(*_KEY).agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper")))
    keepers = work.write(runs.keepers(), "keepers")

    gone = lines.join(keepers.hint("merge"), _KEY).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = gone.select("id", "row", "place").distinct().groupBy("id", "row").agg(F.collect_list("place").alias("gone"))
    gone = work.write(gone, "gone")
    places = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), "gone")
    kept = F.array_join(F.transform(places, lambda k: F.get("lines", k)), "\n")
    split = rows.join(gone.hint("merge"), ["id", "row"], "left").withColumn("lines", F.split("text", "\n"))
    return split.withColumn("n_lines", F.size("lines")).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )
