from __future__ import annotations

import re

import pytest

from rollcall.llm.tables import Workspace

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Columns whose names operators use themselves.
CLASH = ["kept", "component_id", "score", "row", "number", "stats", "rep", "size", "seats", "_won", "taken", "text_key"]


@pytest.fixture
def work(spark):
    return Workspace(spark)


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text, ...) with clashing extra columns, over several partitions."""

    def make(rows, extra="", values=()):
        names = "".join(f", {name} string" for name in CLASH)
        frame = spark.createDataFrame(
            [(*row, *values, *("x" for _ in CLASH)) for row in rows], f"doc_id long, text string{extra}{names}"
        )
        return frame.repartition(3)

    return make


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(words, size, short=True):
    if len(words) >= size:
        return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
    return {tuple(words)} if words and short else set()


def components(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
