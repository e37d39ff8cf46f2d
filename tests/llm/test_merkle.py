"""Manifests against trees built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from llm_fixtures import LOWER, documents, work  # noqa: F401

from rollcall.llm.merkle import manifest, proof_digest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves, fanout):
    """The root, and per leaf the digests left and right of its path."""
    proofs, where, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for leaf, at in enumerate(where):
            run = at - at % fanout
            proofs[leaf].append(("".join(level[run:at]), "".join(level[at + 1 : run + fanout])))
        level = [h(*level[k : k + fanout]) for k in range(0, len(level), fanout)]
        where = [at // fanout for at in where]
    return level[0], proofs


def brute(rows, fanout):
    """rows: doc_id, text, source, lang, n_chars."""
    by_source = {}
    for doc_id, text, source, lang, n_chars in rows:
        leaf = h(*map(field, (doc_id, source, lang, n_chars, text)))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        changed = text.translate(LOWER) if hit and text is not None else text
        by_source.setdefault(source, []).append((doc_id, leaf, h(*map(field, (doc_id, source, lang, n_chars, changed)))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for own in by_source.values():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [tree([leaf for _, leaf, _ in by_source[s]], fanout) for s in order]
    root, above = tree([subroot for subroot, _ in trees], fanout)
    out = []
    for source, (subroot, proofs), top in zip(order, trees, above, strict=True):
        for (doc_id, leaf, changed), proof in zip(by_source[source], proofs, strict=True):
            path, folded = proof + top, changed
            for left, right in path:
                folded = h(left, folded, right)
            out.append((doc_id, leaf, subroot, root, h(*[x for step in path for x in step]), folded, folded == root))
    return sorted(out, key=repr)


def found(frame, work, fanout):
    rows = manifest(frame, work, fanout).withColumn("proof", proof_digest("path")).collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root, r.verified) for r in rows), key=repr)


def table(n, sources):
    return [(k * 7 % n, f"Text {k}\nÄ" if k % 9 else None, sources[k * k % len(sources)], "en" if k % 4 else None, k if k % 5 else None)
            for k in range(n)]


@pytest.mark.parametrize(
    ("n", "sources", "fanout"),
    [(300, ["b", "a", None, "a"], 16), (40, [f"s{k}" for k in range(23)], 2), (37, ["one"], 3), (17, ["x"], 16), (1, [None], 16)],
)
def test_against_plain_trees(work, documents, n, sources, fanout):
    rows = table(n, sources)
    assert found(documents(rows, ", source string, lang string, n_chars int"), work, fanout) == brute(rows, fanout)


def test_nulls_ties_and_empty(spark, work, documents):
    rows = [
        (None, "A", "s", None, 1), (None, None, None, None, None), (3, "Same", "s", "en", 4), (3, "Same", "s", "en", 4), (3, "", "s", "", 0),
        (5, "x", "é", "en", 1), (6, "x", "", "en", 1), (-4, "LONG " * 20000, "s", "en", 1),
    ]
    assert found(documents(rows, ", source string, lang string, n_chars int"), work, 16) == brute(rows, 16)
    empty = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars int, text string")
    assert manifest(empty, work).collect() == []


def test_only_changed_texts_fail(work, documents):
    rows = table(200, ["a", "b"])
    got = {r.doc_id: r.verified for r in manifest(documents(rows, ", source string, lang string, n_chars int"), work).collect()}
    changed = {d for d, t, *_ in rows if t is not None and zlib.crc32(str(d).encode()) % 5 == 0}
    assert {d for d, fine in got.items() if not fine} == changed != set()
