"""License scans by diagonal voting.

Rolling hashes of k words of every text are joined to the places where license templates
have them. A hash at word p of a text and word t of a template votes for the diagonal p - t:
where the template stands word for word, all of its hashes vote for one diagonal. Votes
are added up per text, template and diagonal; neighbouring diagonals, apart by inserted or
lost words, are merged; and the spans that they stand for are verified on the words.
Texts without a vote are done after the first pass; only the words of others are moved.

Phrases vote with pairs of words and must stand exactly. Notices vote with runs of four
words and must share enough of theirs. Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.line_dedup import lowered
from rollcall.llm.tables import Workspace

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Sentences that licenses and their notices consist of, and their labels.
NOTICES = (
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "mit",
    ),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     "AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND", "apache"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation", "gpl"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "agpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
     "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
)

PHRASE_WORDS, NOTICE_WORDS = 2, 4
#: Diagonals of a notice this near to each other are one span.
GAP = 8
#: Of a notice's words, so many must stand in the span; all of them of a notice under so many words.
SHARE, SHORT = 0.8, 10


def _words(text: Column) -> Column:
    return F.filter(F.split(lowered(text), SEPARATORS), lambda w: w != "")


def _hash(words: Column, p: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *(F.get(words, p + i) for i in range(k)))


def _starts(words: Column, k: int) -> Column:
    """All places of k words; none where there are fewer."""
    return F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))


def _grams(words: Column, k: int) -> Column:
    """A hash of k words from every place."""
    return F.transform(_starts(words, k), lambda p: _hash(words, p, k))


def _hits(words: Column, k: int, known: list[int]) -> Column:
    """(place, hash) of the grams that are known."""
    places = F.filter(_starts(words, k), lambda p: _hash(words, p, k).isin(known))
    return F.transform(places, lambda p: F.struct(p.alias("place"), _hash(words, p, k).alias("hash")))


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """template, label, k, words of every phrase and notice; their number is that of the constants."""
    rows = [(text, label, PHRASE_WORDS) for text, label in phrases] + [(text, label, NOTICE_WORDS) for text, label in notices]
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "template int, text string, label string, k int")
    return frame.select("template", "label", "k", _words(F.col("text")).alias("words"))


def license_scan(documents: DataFrame, work: Workspace, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans per row.

    ``documents`` has doc_id and text. Words are runs of ASCII letters, ASCII digits and all
    non-ASCII characters, A-Z lower-cased. n_base counts all places of phrases, first_word and
    last_word are their smallest and largest start, from 0. base_labels are the labels of phrases,
    labels those of notices, too; distinct, sorted, joined by commas. score is 1 with a
    phrase, else the largest share of a notice's words in a verified span, else 0. spans are
    (label, start, words, share) of all that was verified, the starts ascending.

    Null and empty texts have no words. Rows without a doc_id count like others. Repeated
    rows give equal rows. Overlapping places all count. Texts of any length work; the
    votes of one text are combined by template and diagonal. No rows give no rows. Other columns
    aren't read. Neither phrases nor notices may have fewer words than vote together.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    known = templates(documents.sparkSession, phrases, notices)
    own = F.when(F.col("k") == PHRASE_WORDS, _grams(F.col("words"), PHRASE_WORDS)).otherwise(_grams(F.col("words"), NOTICE_WORDS))
    places = known.select("template", F.posexplode(own).alias("at", "hash"))

    # The templates are constants, so their places are of a fixed number.
    grams = {k: [r.hash for r in places.join(known.where(F.col("k") == k), "template").select("hash").distinct().collect()] for k in (PHRASE_WORDS, NOTICE_WORDS)}
    hits = F.concat(*(_hits(F.col("words"), k, grams[k]) for k in (PHRASE_WORDS, NOTICE_WORDS)))
    # Words stay only where a template votes, and move to the spans alone.
    scanned = rows.withColumn("words", _words(F.col("text"))).select("row", "doc_id", "words", hits.alias("hits"))
    scanned = scanned.select("row", "doc_id", F.size("words").alias("n_words"), F.when(F.size("hits") > 0, F.col("words")).alias("words"), "hits")
    scanned = work.write(scanned, "scanned")
    voting = scanned.where(F.size("hits") > 0)
    votes = voting.select("row", F.inline("hits")).join(F.broadcast(places), "hash")
    diagonals = votes.groupBy("row", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.size(F.collect_set("at")).alias("votes")
    )
    # Phrases and notices both start from here.
    diagonals = work.write(diagonals, "diagonals").join(F.broadcast(known), "template")

    exact = (F.col("k") == PHRASE_WORDS) & (F.col("votes") == F.size("words") - PHRASE_WORDS + 1)
    by_diagonal = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > GAP, F.lit(False)).cast("int")
    merged = (
        diagonals.where(F.col("k") == NOTICE_WORDS)
        .withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(by_diagonal))
        .groupBy("row", "template", "label", "k", "words", "span")
        .agg(F.greatest(F.lit(0), F.min("diagonal")).alias("start"), (F.max("diagonal") + F.size("words")).alias("stop"))
        .drop("span")
    )
    phrased = diagonals.where(exact).select(
        "row", "template", "label", "k", "words", F.col("diagonal").alias("start"), (F.col("diagonal") + F.size("words")).alias("stop")
    )
    spans = phrased.unionByName(merged).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop", "label", "k", "words"))).alias("spans")
    )

    # Both sides grow with the corpus.
    held = voting.join(spans.hint("merge"), "row", "left").drop("hits")
    of_span = lambda s: F.slice(F.col("words"), s["start"] + 1, s["stop"] - s["start"])
    verified = F.transform(
        F.coalesce("spans", F.array().cast(dict(spans.dtypes)["spans"])),
        lambda s: F.struct(
            s["label"].alias("label"),
            s["start"].cast("long").alias("start"),
            s["k"].alias("k"),
            F.when(s["k"] == PHRASE_WORDS, (of_span(s) == s["words"]).cast("double"))
            .otherwise(F.size(F.array_intersect(of_span(s), s["words"])) / F.size(F.array_distinct(s["words"])))
            .alias("share"),
            F.when(F.size(s["words"]) < SHORT, 1.0).otherwise(SHARE).alias("asked"),
        ),
    )
    held = held.withColumn("spans", F.filter(verified, lambda s: s["share"] >= s["asked"])).drop("words")
    none = F.array().cast(dict(held.dtypes)["spans"])
    held = held.unionByName(scanned.where(F.size("hits") == 0).select("row", "doc_id", "n_words", none.alias("spans")))
    held = held.withColumn("base", F.filter("spans", lambda s: s["k"] == PHRASE_WORDS))
    joined = lambda name: F.array_join(F.array_sort(F.array_distinct(F.col(f"{name}.label"))), ",")
    return held.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        joined("base").alias("base_labels"),
        joined("spans").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.share"), F.lit(0.0))).alias("score"),
        F.transform("spans", lambda s: s.dropFields("k", "asked")).alias("spans"),
    )
