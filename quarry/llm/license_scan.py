"""License scans: exact set-similarity join of text blocks with license templates, in DataFrame operations only.

Words are runs of digits, letters and all characters beyond ASCII, with A-Z
lower-cased.  Base places are found by phrase.  Beside them, blocks of text are
compared with templates as sets of words.  A template of n words is compared
with blocks of 2n words or a little more (a power of two), each beginning half a
block after the last: so words far apart never meet in a block, and a notice
that stands in a text as it stands in the template lies whole in one of them.
A block matches if it holds at least ``threshold`` of the template's words, and
all its *names*, the words without which it would be another licence.

The join is exact and filtered: only template words matter to the overlap, so a
block keeps those of its words that occur in a template of its size, ordered by
their frequency over all texts, rarest first.  With o = ceil(threshold * |T|):

* length: a block of fewer than o such words can't match T;
* prefix: a match shares a word among the first |T| - o + 1 of T and the first
  |B| - o + 1 of B, so only those are joined;
* position: with the first common word at places i of T and j of B, at most
  1 + min(|T| - 1 - i, |B| - 1 - j) words can be common;
* the survivors are verified on their whole sets.

Templates are a parameter; their words are the only thing that is broadcast, and
as many counts reach the driver.  Texts with enough words of some template are dealt out in chunks of ``CHUNK``
words (and what the last block needs beyond), so no row grows with a text; a
word that is in every block is joined only where it is in a prefix.

Defined results: a null text counts as empty (no words, no places, score 0);
repeated rows and rows without id are scanned like any other; an empty table
gives an empty result.  The score is the largest share of a template's words
found in one block, among templates that matched, and 1 where a phrase was
found; else 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import field, frozen, payload

#: Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Opening sentences of well-known licences and usual notices: label, names, text.  Notices as short as
#: a licence's own name are phrases (above), not templates: four of five words would be those of any other licence.
TEMPLATES = [
    ("mit", "", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "gnu general public", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc", "licensed cc by nc 4 0", "licensed under cc by nc 4 0"),
    ("cc", "creative commons", "this work is licensed under a creative commons attribution international license"),
    ("mpl", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
THRESHOLD = 0.8
#: Words of a text in one row.
CHUNK = 1024

_NOT_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text):
    """Words in order, lower-cased; text must not be null."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _NOT_WORD), lambda w: w != "")


def _places(words, number: int, phrase: str):
    """(start, number) of the places of one phrase."""
    def holds(i):
        cond = F.lit(True)
        for k, w in enumerate(phrase.split()):
            cond = cond & (F.get(words, i + k) == w)
        return F.coalesce(cond, F.lit(False))

    return F.transform(F.filter(F.sequence(F.lit(0), F.size(words) - 1), holds), lambda i: F.struct(i.alias("start"), F.lit(number).alias("phrase")))


def phrase_places(words, phrases: list[str]):
    """(start, phrase number) of all places where a phrase's words stand consecutively."""
    return F.when(F.size(words) > 0, F.concat(*[_places(words, n, p) for n, p in enumerate(phrases)]))


def span_of(template: str) -> int:
    """Words in the blocks that a template is compared with."""
    return 1 << (2 * len(template.split()) - 1).bit_length()


def scan(docs: DataFrame, templates=None, threshold: float = THRESHOLD, phrases=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, places (start, phrase), base (labels), found (labels of matched templates), score."""
    spark = docs.sparkSession
    templates = templates or TEMPLATES
    phrases = phrases or PHRASES
    sets = [sorted(set(t.split())) for _, _, t in templates]
    need = [max(1, math.ceil(threshold * len(s) - 1e-9)) for s in sets]
    span = [span_of(t) for _, _, t in templates]
    vocabulary = sorted({w for s in sets for w in s})

    text = F.coalesce(field(text_col), F.lit(""))
    rows = payload(docs).select(field(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), words_of(text).alias("words"))
    keys = list(phrases)
    some = F.lit(False)
    for p in keys:
        some = some | F.array_contains("words", p.split()[0])
    known = F.array(*[F.lit(w) for w in vocabulary])
    rows = rows.withColumn("present", F.array_intersect("words", known))
    # a text with too few words of every template has no block with enough; the others go on with their words
    alike = F.lit(False)
    for s, n in zip(sets, need):
        alike = alike | (F.size(F.array_intersect("present", F.array(*[F.lit(w) for w in s]))) >= n)
    scanned = frozen(rows.select(
        "id", "row", F.size("words").cast("long").alias("n_words"), "present",
        F.coalesce(F.when(some, phrase_places(F.col("words"), keys)), F.array().cast("array<struct<start:int,phrase:int>>")).alias("places"),
        F.when(alike, F.col("words")).alias("words"),
    ), "license-scan")

    counts = {r.w: r.n for r in scanned.select(F.explode("present").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}  # the templates' words
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    ranked = F.array(*[F.lit(w) for w in order])
    chunk = lambda c: F.slice("words", c * CHUNK + 1, CHUNK + max(span))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / CHUNK).cast("int")), chunk)
    dealt = scanned.filter("words is not null").select("row", F.posexplode(chunks).alias("chunk", "words"))
    # the template words of a chunk with their places, by rank
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), (F.array_position(ranked, w) - 1).cast("int").alias("w"))), lambda h: h["w"] >= 0)
    dealt = dealt.select("row", "chunk", hits.alias("hits"))

    blocks = []
    for size in sorted(set(span)):
        own = [(sorted(rank[w] for w in s), n) for s, n, z in zip(sets, need, span) if z == size]
        words = sorted({w for s, _ in own for w in s})
        prefix = sorted({w for s, n in own for w in s[:len(s) - n + 1]})
        least, half = min(n for _, n in own), size // 2
        few = dealt.select("row", "chunk", F.filter("hits", lambda h: h["w"].isin(words)).alias("mine"))
        # blocks with a word of some template's prefix; two hold each place
        at = F.transform(F.filter("mine", lambda h: h["w"].isin(prefix)), lambda h: F.floor(h["at"] / half).cast("int"))
        near = F.filter(F.array_distinct(F.concat(at, F.transform(at, lambda b: b - 1))), lambda b: (b >= 0) & (b < CHUNK // half))
        few = few.select("row", "chunk", "mine", F.explode(near).alias("b"))
        held = F.filter("mine", lambda h: (h["at"] >= F.col("b") * half) & (h["at"] < F.col("b") * half + size))
        few = few.select("row", (F.col("chunk") * (CHUNK // half) + F.col("b")).alias("block"), F.array_sort(F.array_distinct(F.transform(held, lambda h: h["w"]))).alias("has"))
        blocks.append(few.filter(F.size("has") >= least).select("row", F.lit(size).alias("span"), "block", "has", F.posexplode(F.slice("has", F.lit(1), F.size("has") - least + 1)).alias("j", "w")))
    probes = blocks[0]
    for more in blocks[1:]:
        probes = probes.union(more)

    table = []
    for t, s in enumerate(sets):
        own = sorted(rank[w] for w in s)
        names = [rank[w] for w in templates[t][1].split()]
        table += [(t, span[t], i, w, need[t], own, names) for i, w in enumerate(own[:len(own) - need[t] + 1])]
    index = F.broadcast(spark.createDataFrame(table, "template int, span int, i int, w int, need int, own array<int>, names array<int>"))
    size_t, size_b = F.size("own"), F.size("has")
    fits = (size_b >= F.col("need")) & (F.col("j") <= size_b - F.col("need")) & (1 + F.least(size_t - 1 - F.col("i"), size_b - 1 - F.col("j")) >= F.col("need"))
    # the first common word only: earlier ones of both prefixes must differ
    first = ~F.arrays_overlap(F.slice("has", F.lit(1), F.col("j")), F.slice("own", F.lit(1), F.col("i")))
    common = F.size(F.array_intersect("has", "own"))
    named = F.size(F.array_except("names", "has")) == 0
    matches = (probes.join(index, ["span", "w"]).filter(fits & first).filter(named).select("row", "template", common.alias("common"), "need", size_t.alias("size"))
               .filter(F.col("common") >= F.col("need")))
    labels = F.array(*[F.lit(label) for label, _, _ in templates])
    per_row = matches.groupBy("row").agg(F.collect_set(labels[F.col("template")]).alias("found"), F.max(F.col("common") / F.col("size")).alias("best"))
    base_labels = F.array(*[F.lit(phrases[p]) for p in keys])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: base_labels[p["phrase"]])))
    joined = scanned.drop("present", "words").join(per_row, "row", "left")
    return joined.select("id", "n_words", "places", base.alias("base"), F.coalesce("found", F.array().cast("array<string>")).alias("found"),
                         F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
