"""Every query that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from conftest import SMALL

from rollcall.llm import oracle
from rollcall.llm.catalogue import QUERIES

TABLES = ("documents", "benchmark", "embeddings")


@pytest.fixture(scope="module")
def con():
    with duckdb.connect() as connection:
        for name in TABLES:
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
        yield connection


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_spark_and_sql_agree(spark, con, name):
    got = QUERIES[name](spark, SMALL)
    result = con.execute(oracle.STATEMENTS[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    rows = Counter(tuple(row[c] for c in columns) for row in got.collect())
    assert rows == Counter(result.fetchall())


@pytest.mark.parametrize(
    "name, columns",
    [
        ("op2_token_codes", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
        ("op5_license_scan", {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint",
                              "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"}),
        ("op6_html_text", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
        ("op8_toxicity", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
        ("op10_quality", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    ],
)
def test_schemas(spark, name, columns):
    kinds = dict(QUERIES[name](spark, SMALL).dtypes)
    assert {c: kinds.get(c) for c in columns} == columns
