from __future__ import annotations

import random

from llm_fixtures import documents, plain_words, work  # noqa: F401

from rollcall.llm.licenses import NOTICES, PHRASES, license_scan

MIT = NOTICES[0][0]


def expected(text):
    words = plain_words(text)
    places = [
        (k, label)
        for phrase, label in PHRASES
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_equals_brute_force(documents, work):
    tries = random.Random(8)
    vocabulary = "gnu general public license apache cc by mit GNU Cc BY License é the of".split()
    rows = [(k, tries.choice([" ", "-", ", ", "\n"]).join(tries.choices(vocabulary, k=tries.randrange(60)))) for k in range(200)]
    rows += [(500, None), (501, ""), (None, "MIT License"), (502, "cc by cc by cc by"), (502, "cc by cc by cc by"), (502, "cc by cc by cc by")]
    rows += [(503, "mit license " * 20_000), (504, "by"), (505, "..mit--license..")]
    got = license_scan(documents(rows), work).collect()
    assert len(got) == len(rows)
    found = sorted((r.doc_id or -1, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert found == sorted((k or -1, *expected(t)) for k, t in rows)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.score == 1.0 if r.n_base else 0 <= r.score <= 1


def test_notices_with_edits_in_long_texts(documents, work):
    words = MIT.split()
    lost = words[:8] + words[9:]  # a neighbouring diagonal
    more = words[:12] + ["very", "good"] + words[12:]
    halved = words[: len(words) // 2]
    around = " ".join(f"w{k}" for k in range(500))
    rows = [(k, f"{around} {' '.join(x)} {around}") for k, x in enumerate([words, lost, more, halved, ["permission", "is", "hereby", "granted"]])]
    got = {r.doc_id: r for r in license_scan(documents(rows), work).collect()}
    assert [got[k].labels for k in range(5)] == ["mit", "mit", "mit", "", ""]
    assert got[0].score == 1.0 and 0.8 <= got[1].score < 1 and got[2].score == 1.0 and got[3].score == 0.0
    assert [(s.label, s.start) for s in got[0].spans] == [("mit", 500)]
    assert {r.n_base for r in got.values()} == {0}


def test_no_rows(documents, work):
    assert license_scan(documents([(1, "x")]).limit(0), work).collect() == []


def test_only_voting_texts_move(documents, work, monkeypatch):
    """Words of texts without a vote are neither kept nor moved; all rows have their results."""
    kept = {}
    write = type(work).write
    monkeypatch.setattr(type(work), "write", lambda self, frame, name, **o: kept.setdefault(name, write(self, frame, name, **o)))
    rows = [(k, "plain words " * 300) for k in range(50)] + [(60, "the mit license"), (61, "general public"), (62, None)]
    got = {r.doc_id: r for r in license_scan(documents(rows), work).collect()}
    assert len(got) == len(rows) and got[0].n_words == 600 and got[62].n_words == 0 and got[60].base_labels == "mit"
    assert all(r.labels == "" and r.score == 0.0 and r.spans == [] for k, r in got.items() if k != 60)
    scanned = {r.doc_id: r for r in kept["scanned"].collect()}
    assert {k for k, r in scanned.items() if r.words is not None} == {60, 61}
    assert [x.place for x in scanned[60].hits] == [1]
