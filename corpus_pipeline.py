"""From raw documents to token codes: five stages, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm.catalogue import word_bpe
from rollcall.llm.decontamination import decontaminated
from rollcall.llm.mixing import mixed_documents
from rollcall.llm.near_dedup import without_near_duplicates
from rollcall.llm.quality import of_quality
from rollcall.llm.tables import Workspace, table
from rollcall.llm.token_codes import read_digests, write_codes


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; without training labels, all of them. Null
    and empty texts score by statistics of zero."""
    return of_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), Workspace(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.
    Texts without words and rows without an id stay."""
    return without_near_duplicates(docs, Workspace(spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``; short items count as runs of as many words."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), Workspace(spark))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: whole texts, up to three times, and cut ones.
    Texts without words are not taken; a null source is a source of its own."""
    return mixed_documents(docs, Workspace(spark))


def token_codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files of directly addressable codes, and what is read back from them:
    doc_id, start, n_tokens, ids_crc32. Rows of one doc_id follow each other."""
    work = Workspace(spark)
    write_codes(docs, work.path("codes"), word_bpe())
    return read_digests(work.read("codes"), work)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_codes", token_codes),
]

#: The classifier is trained and the codes are made by a tokenizer; SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again. An empty table gives no rows."""
    work = Workspace(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = work.write(stage(spark, docs, sf_dir), name)
        if before:
            work.remove(before)
        # Shuffles and plans of one stage leave before the next one begins.
        work.let_go()
        before = name
    return docs
