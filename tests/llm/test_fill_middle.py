"""Cuts against plain Python strings."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from llm_fixtures import documents, work  # noqa: F401

from rollcall.llm import fill_middle
from rollcall.llm.fill_middle import Fenwick, Lines, filled_middle, restored, transformed


def brute(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text, text
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), form, len(prefix), len(middle), out, text


def texts():
    chance = random.Random(5)
    some = ["", None, "\n", "\n\n", "no end", "ends\n", "<P> is a mark\nof its own\n", "a<S", "ü\n€\n𝄞\nlast", "\r\n\r\n", "x" * 2000, "é\n" * 3000]
    some += ["".join(chance.choice(["a", "é", "€", "𝄞", "\n", " "]) for _ in range(chance.randint(1, 1500))) for _ in range(60)]
    return [*enumerate(some), (None, "one\ntwo\nthree"), (3, "same id\nother text\n"), (3, "same id\nother text\n")]


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (40, 0), (0, 100)])
def test_against_plain_strings(documents, rate, spm):
    rows = texts()
    got = sorted((tuple(r) for r in filled_middle(documents(rows), rate, spm).collect()), key=repr)
    assert got == sorted((brute(*row, rate, spm) for row in rows), key=repr)


def test_a_long_text(documents):
    text = "".join(f"line {k} ü\n" * (k % 3) + "word " * (k % 7) for k in range(200_000))
    (row,) = filled_middle(documents([(11, text)])).collect()
    assert tuple(row) == brute(11, text)


def test_empty_table(spark):
    assert filled_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("size", [0, 1, 2, 7, 8, 9, 100])
def test_fenwick(size):
    counts = np.random.default_rng(size).integers(0, 4, size)
    tree = Fenwick(counts)
    assert [tree.before(k) for k in range(size + 1)] == [int(counts[:k].sum()) for k in range(size + 1)]
    for k in range(1, int(counts.sum()) + 1):
        block, before = tree.find(k)
        assert before == counts[:block].sum() and before < k <= before + counts[block]


@pytest.mark.parametrize("block", [1, 3, 64])
def test_every_cut(block):
    text = "a\n\nbü\n€𝄞\n" * 9 + "end"
    lines = Lines(np.frombuffer(text.encode(), np.uint8), block)
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert lines.n == len(units)
    for k in range(len(units) + 1):
        place = lines.place(k)
        assert text.encode()[:place].decode() == "".join(units[:k])
        assert lines.code_points(place) == len("".join(units[:k]))


def test_round_trip():
    data = "eins\nzwei\ndrei".encode()
    forms = set()
    for doc_id in range(50):
        _, form, _, _, output = transformed(data, doc_id)
        forms.add(form)
        assert restored(output, form) == data
    assert forms == {"psm", "spm"}
    assert fill_middle.draws(None) == fill_middle.draws(None)
