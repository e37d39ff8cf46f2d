from __future__ import annotations

import random

import pytest
from llm_fixtures import LOWER, documents, work  # noqa: F401

from pyspark.sql import functions as F

from rollcall.llm import line_dedup
from rollcall.llm.line_dedup import without_repeated_lines

BLANK = " \t\n\x0b\f\r"


def expected(rows):
    key = lambda line: line.strip(BLANK).translate(LOWER)
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            holders = held[key(line)]
            largest = max((d for d in holders if d is not None), default=None)
            if len(key(line)) < 40 or len(holders) < 5 or largest == doc:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def corpus():
    tries = random.Random(6)
    common = [f"{k} " + "This line É stands in many documents " * 2 for k in range(30)]
    common += ["x" * 39, "x" * 40, "É" * 40, " " + "y" * 40, "z" * 38 + "  z", ""]
    rows = []
    for k in range(150):
        lines = [tries.choice([c, c.upper(), f" \t{c}\r", c.lower()]) for c in tries.choices(common, k=tries.randrange(12))]
        lines += [f"own line {k} of this document that is long enough to count" for _ in range(tries.randrange(3))]
        tries.shuffle(lines)
        rows.append((k * 7, "\n".join(lines)))
    rows += [(None, "\n".join(common)), (None, common[0]), (10**6, None), (10**6 + 1, ""), (10**6 + 2, "\n\n")]
    rows += [rows[3], (rows[4][0], common[1]), (10**7, "\n".join([common[2]] * 20_000))]
    return rows


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_equals_brute_force(documents, work, batches):
    rows = corpus()
    got = without_repeated_lines(documents(rows), work, batches=batches).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=repr) == expected(rows)


def test_empty_and_only_null_ids(documents, work):
    assert without_repeated_lines(documents([(1, "x")]).limit(0), work).collect() == []
    got = without_repeated_lines(documents([(None, "a" * 50)] * 6), work).collect()
    assert [(r.n_lines, r.n_dropped) for r in got] == [(1, 0)] * 6


def test_equal_hashes_of_different_rows(documents, work, monkeypatch):
    """Rows with other ids keep their own lines, whatever their hash."""
    monkeypatch.setattr(line_dedup, "row_hash", lambda *_: F.lit(7).cast("long"))
    rows = list({doc: (doc, text) for doc, text in corpus() if doc is not None}.values())
    got = without_repeated_lines(documents(rows), work).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=repr) == expected(rows)
