"""One query per operator, over its whole table with its working parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import oracle
from rollcall.llm.decontamination import contaminated
from rollcall.llm.embeddings import linked_vectors
from rollcall.llm.fill_middle import filled_middle
from rollcall.llm.html_text import main_text
from rollcall.llm.licenses import license_scan
from rollcall.llm.line_dedup import without_repeated_lines
from rollcall.llm.merkle import manifest, proof_digest
from rollcall.llm.mixing import mixed_sources
from rollcall.llm.near_dedup import near_duplicates
from rollcall.llm.quality import scored_quality
from rollcall.llm.suffix_dedup import without_repeated_bytes
from rollcall.llm.tables import Workspace, table
from rollcall.llm.token_codes import read_digests, write_codes
from rollcall.llm.toxicity import scored_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL = oracle.STATEMENTS


def word_bpe() -> str:
    """The public tokenizer file that token ids are made with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@_query
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    found = contaminated(documents, table(spark, folder, "benchmark", "item_id", "text"), Workspace(spark))
    return found.drop("text_key")


@_query
def op2_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    write_codes(table(spark, folder, "documents", "doc_id", "text"), work.path("codes"), word_bpe())
    return read_digests(work.read("codes"), work)


@_query
def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linked_vectors(table(spark, folder, "embeddings", "vec_id", "embedding"), Workspace(spark))


@_query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = without_repeated_lines(table(spark, folder, "documents", "doc_id", "text"), Workspace(spark))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents", "doc_id", "text"), Workspace(spark)).drop("spans")


@_query
def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages", "page_id", "url", "html"), Workspace(spark))


@_query
def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents", "doc_id", "text"), Workspace(spark), size=4)


@_query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    return scored_toxicity(documents, table(spark, folder, "labels", "doc_id", "toxic"))


@_query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixed_sources(table(spark, folder, "documents", "doc_id", "text", "source"), Workspace(spark))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    return scored_quality(documents, table(spark, folder, "labels", "doc_id", "quality"), Workspace(spark))


@_query
def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = without_repeated_bytes(table(spark, folder, "documents", "doc_id", "text"), Workspace(spark))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "source", "lang", "n_chars", "text")
    proven = manifest(documents, Workspace(spark))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified"
    )


@_query
def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    filled = filled_middle(table(spark, folder, "documents", "doc_id", "text"))
    digests = [F.sha2(name, 256).alias(f"{name}_sha256") for name in ("output", "restored")]
    return filled.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)
