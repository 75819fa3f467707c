"""License scan: base phrases, and an exact set-similarity join of text blocks with license templates.

Words are runs of `[0-9a-z]` and of characters beyond ASCII, after A-Z are lower-cased; lines play no part, so that a notice
may be wrapped or stand in comments. For a template of n words a block is every run of 2 n words that begins at a multiple
of n; so each run of n words lies in a block, and no block is longer than twice the template. A block matches if
it holds at least `threshold` of the template's distinct words. The join is exact and looks at few blocks:

* A text is cut into words once. Segments of 2 SEGMENT words, begun at each multiple of SEGMENT, hold every block; of each
  segment the set of its template words is written, beside the base columns of the text.
* Spark counts in how many segments each template word occurs; template words are ordered from rare to
  frequent by these counts (ties by word). Other words cannot match and are left out of the sets.
* Prefix filter: of n distinct words at least o = ceil(threshold * n) must match, so a segment with a matching block has
  one of the template's n - o + 1 rarest words. Only those words are indexed and joined.
* Length filter: the segment has at least o template words.
* Positional filter: behind the shared word, template and segment still have enough words to reach o.
* What remains is verified block by block on the words of its text, which are cut again for these texts only.

Templates are a fixed, short table, so their index is a bounded side of the join. Everything is
DataFrame expressions. Nulls: a null text is empty, with no words and no labels; a null doc_id stays
null. Rows that repeat an id are scanned each; rows with equal id and text get equal results. Very long texts are
scanned whole, with work in proportion to their words. Columns besides doc_id and text are left out, so names cannot clash.
An empty table gives no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import ascii_lower, stored, whole

THRESHOLD = 0.8
SEGMENT = 64
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Labels and sentences of license notices.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("public-domain", "This work is dedicated to the public domain"),
]


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall("[0-9a-z\x80-\U0010ffff]+", text.translate({c: c + 32 for c in range(65, 91)}))))


def word_count(text: str) -> int:
    return len(re.findall("[0-9A-Za-z\x80-\U0010ffff]+", text))


def required(n: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n - 1e-9))


def phrase_places(words: Column, phrase: str) -> Column:
    """Word numbers (from 0) where the phrase's words stand consecutively."""
    parts = phrase.split(" ")
    starts = F.sequence(F.lit(0), F.size(words) - len(parts))

    def stands(i: Column) -> Column:
        here = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            here = here & (F.get(words, i + k) == part)
        return here

    return F.when(F.size(words) >= len(parts), F.filter(starts, stands)).otherwise(F.array().cast("array<int>"))


def base_columns(words: DataFrame) -> DataFrame:
    """Rows of `_low` and `_words` with n_words, n_base, first_word, last_word, base_labels and the label array `_base`."""
    rows, places = words, []
    for i, phrase in enumerate(PHRASES):
        maybe = F.col("_low").rlike(phrase.replace(" ", GAP))
        found = F.when(maybe, phrase_places(F.col("_words"), phrase)).otherwise(F.array().cast("array<int>"))
        rows = rows.withColumn(f"_p{i}", found)
        places.append(f"_p{i}")
    every = F.concat(*places)
    labels = F.array_compact(F.array(*[F.when(F.size(p) > 0, F.lit(label)) for p, label in zip(places, PHRASES.values(), strict=True)]))
    out = rows.withColumn("n_words", F.size("_words").cast("long")).withColumn("n_base", F.size(every).cast("long"))
    out = out.withColumn("first_word", F.array_min(every).cast("long")).withColumn("last_word", F.array_max(every).cast("long"))
    return out.withColumn("_base", labels).withColumn("base_labels", F.array_join(F.array_sort("_base"), ",")).drop(*places)


def cut(docs: DataFrame) -> DataFrame:
    """docs' columns but the text, with the lower-cased text and its words."""
    low = docs.withColumn("_low", ascii_lower(whole(F.col("text")))).drop("text")
    return low.withColumn("_words", F.regexp_extract_all("_low", F.lit(WORD), F.lit(0)))


def segments(vocabulary: list[str], segment: int, least: int) -> Column:
    """array<struct<g, found>> of the column `_words`: per segment with at least `least` template words, those words."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size("_words") - 1, F.lit(0)) / segment).cast("int"))
    found = F.transform(numbers, lambda g: F.struct(g.alias("g"), F.array_intersect(F.slice(F.col("_words"), g * segment + 1, 2 * segment), known).alias("found")))
    return F.filter(found, lambda s: F.size(s["found"]) >= least)


def candidates(scanned: DataFrame, ranked: list[tuple[int, list[int], int]], rank: dict[str, int]) -> DataFrame:
    """(doc_id, _k, g, template): segments that may hold a block of the template, by prefix, length and position."""
    index = [(word, i, at, len(s), need) for i, s, need in ranked for at, word in enumerate(s[: len(s) - need + 1])]
    prefixes = scanned.sparkSession.createDataFrame(index, "rank int, template int, at int, n int, need int")
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    rows = scanned.select("doc_id", "_k", F.explode("segments").alias("s"))
    sized = rows.select("doc_id", "_k", "s.g", F.array_sort(F.transform("s.found", lambda w: ranks[w])).alias("block"))
    wanted = F.array(*[F.lit(w) for w in sorted({word for word, *_ in index})])
    entries = sized.where(F.arrays_overlap("block", wanted)).select("doc_id", "_k", "g", F.size("block").alias("length"), F.posexplode("block").alias("pos", "rank"))
    long_enough = F.col("length") >= F.col("need")
    enough_behind = F.least(F.col("n") - F.col("at"), F.col("length") - F.col("pos")) + F.least("at", "pos") >= F.col("need")
    met = entries.join(F.broadcast(prefixes), "rank").where(long_enough & enough_behind)
    return met.select("doc_id", "_k", "g", "template").distinct()


def matches(docs: DataFrame, scanned: DataFrame, templates: list[tuple[str, str]], threshold: float, segment: int) -> DataFrame:
    """(_id, _h, _more, _best): per text with a matching block the labels and the best containment."""
    sets = [template_words(text) for _, text in templates]
    vocabulary = sorted({w for s in sets for w in s})
    counted = scanned.select(F.explode("segments.found").alias("found")).select(F.explode("found").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r["word"]: r["n"] for r in counted.collect()}  # at most one row per template word
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    ranked = [(i, sorted(rank[w] for w in s), required(len(s), threshold)) for i, s in enumerate(sets)]
    asked = candidates(scanned, ranked, rank).groupBy(F.col("doc_id").alias("_id"), F.col("_k").alias("_h"))
    asked = stored(asked.agg(F.collect_list(F.struct("g", "template")).alias("asked")))  # its size decides the join
    texts = docs.join(asked, (docs["_k"] == asked["_h"]) & docs["doc_id"].eqNullSafe(asked["_id"]))
    facts = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(word_count(text)).alias("n"), F.lit(required(len(s), threshold)).alias("need"), F.array(*[F.lit(w) for w in s]).alias("words"))
        for (label, text), s in zip(templates, sets, strict=True)
    ])

    def best(c: Column) -> Column:
        t = F.get(facts, c["template"])
        start = F.ceil(c["g"] * segment / t["n"]).cast("int") * t["n"]
        shared = F.transform(F.sequence(start, (c["g"] + 1) * segment - 1, t["n"]), lambda s: F.size(F.array_intersect(F.slice(F.col("_words"), s + 1, 2 * t["n"]), t["words"])))
        return F.struct(t["label"].alias("label"), F.array_max(shared).alias("shared"), t["need"].alias("need"), F.size(t["words"]).alias("n"))

    verified = cut(texts.select("_id", "_h", "asked", "text")).select("_id", "_h", F.filter(F.transform("asked", best), lambda b: b["shared"] >= b["need"]).alias("hits"))
    containment = F.array_max(F.transform("hits", lambda b: b["shared"] / b["n"]))
    return verified.where(F.size("hits") > 0).select("_id", "_h", F.array_distinct(F.col("hits.label")).alias("_more"), containment.alias("_best")).dropDuplicates(["_h", "_id"])


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id with the base columns, labels (base and template labels) and score.

    score is 1 for a document with a base phrase, else its best block's containment, else 0.
    """
    segment = max(SEGMENT, *(word_count(text) for _, text in templates))
    sets = [template_words(text) for _, text in templates]
    keyed = docs.select("doc_id", "text").withColumn("_k", F.xxhash64("doc_id", "text"))
    found = segments(sorted({w for s in sets for w in s}), segment, min(required(len(s), threshold) for s in sets))
    scanned = stored(base_columns(cut(keyed).withColumn("segments", found)).drop("_low", "_words"))
    hits = matches(keyed, scanned, templates, threshold, segment)
    rows = scanned.drop("segments")
    joined = rows.join(hits, (rows["_k"] == hits["_h"]) & rows["doc_id"].eqNullSafe(hits["_id"]), "left")
    both = F.array_union("_base", F.coalesce("_more", F.array().cast("array<string>")))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", F.array_join(F.array_sort(both), ",").alias("labels"), score.alias("score"))
