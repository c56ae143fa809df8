"""License scan: MinHash bands over overlapping text windows, then exact shingle containment.

Only DataFrame functions. Words are runs of ASCII digits, letters (A-Z lower-cased) and non-ASCII
characters; shingles are five consecutive words. A template matches a window that contains at
least ``CONTAINMENT`` of its distinct shingles.

Windows come in a few lengths, each ``length`` words every ``step`` words; a template uses the
shortest that leaves room for all its words at any place of a text (length - step + 1 words). From
the containment, window and template sizes follows a least Jaccard similarity of a matching pair,
and from it the number of one-row bands that misses a match with a chance of at most ``MISS``. A
window and a template that share a band are compared shingle by shingle.

Windows without any anchor word of a template are not hashed. Anchor words are chosen so that
fewer than the needed shingles lack one: a window without them cannot match, so nothing is lost.

Null, empty and short texts match nothing; every document row gets a result row. Rows that repeat
an id share their findings.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-4
#: (words, step) of the windows.
LENGTHS = ((8, 4), (12, 5), (24, 12), (48, 24), (128, 64), (512, 256))

# Short notices and opening sentences of public licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]

    @cached_property
    def shingles(self) -> list[str]:
        n = len(self.words) - SHINGLE + 1
        return list(dict.fromkeys(" ".join(self.words[i : i + SHINGLE]) for i in range(n)))

    @property
    def needed(self) -> int:
        return math.ceil(CONTAINMENT * len(self.shingles) - 1e-9)

    @property
    def window(self) -> tuple[int, int]:
        return next((n, s) for n, s in LENGTHS if n - s + 1 >= len(self.words))

    @property
    def least_similarity(self) -> float:
        inside = self.window[0] - SHINGLE + 1
        return self.needed / (inside + len(self.shingles) - self.needed)

    @property
    def anchors(self) -> set[str]:
        """Words that any match contains at least one of, longest first."""
        chosen: set[str] = set()
        for word in sorted(set(self.words), key=lambda w: (-len(w), w)):
            if sum(not chosen & set(s.split()) for s in self.shingles) < self.needed:
                break
            chosen.add(word)
        return chosen


def templates(texts: dict[str, str]) -> list[Template]:
    """Templates by name; one of fewer than five words has no shingle and is refused."""
    out = []
    for name, text in sorted(texts.items()):
        plain = "".join(c.lower() if c.isascii() else c for c in text)
        words = tuple("".join(c if c.isalnum() or not c.isascii() else " " for c in plain).split())
        if not SHINGLE <= len(words) <= LENGTHS[-1][0] - LENGTHS[-1][1] + 1:
            raise ValueError(f"template {name}: {len(words)} words")
        out.append(Template(name, words))
    return out


def bands(own: list[Template]) -> int:
    """Bands by which every one of the templates misses a match with at most ``MISS``."""
    least = min(t.least_similarity for t in own)
    return 1 if least >= 1 else math.ceil(math.log(MISS) / math.log(1 - least))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()), F.lit(_WORD), F.lit(0))


def _shingles(words: Column) -> Column:
    places = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - SHINGLE + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))


def _signature(shingles: Column, n: Column) -> Column:
    """(band, value) of ``n`` one-row bands."""
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    return F.transform(
        F.sequence(F.lit(1), n), lambda k: F.struct(k.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, k))).alias("value"))
    )


def _classes(every: list[Template]) -> list[tuple[int, int, int, list[str]]]:
    """(length, step, bands, anchors) of each window length that a template uses."""
    out = []
    for length, step in LENGTHS:
        own = [t for t in every if t.window == (length, step)]
        if own:
            out.append((length, step, bands(own), sorted(set().union(*[t.anchors for t in own]))))
    return out


def _template_rows(spark: SparkSession, every: list[Template]) -> DataFrame:
    """(length, band, value, license, needed, wanted): signatures of the templates."""
    count = {length: n for length, _, n, _ in _classes(every)}
    rows = F.array(*[
        F.struct(
            F.lit(t.name).alias("license"), F.array(*map(F.lit, t.words)).alias("words"), F.lit(t.needed).alias("needed"),
            F.lit(t.window[0]).alias("length"), F.lit(count[t.window[0]]).alias("bands"),
        )
        for t in every
    ])
    return (
        spark.range(1).select(F.inline(rows)).withColumn("wanted", _shingles(F.col("words")))
        .select("license", "needed", "wanted", "length", F.inline(_signature(F.col("wanted"), F.col("bands"))))
    )


def matches(docs: DataFrame, texts: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license): templates that a window of the document contains, once each."""
    every = templates(texts or TEMPLATES)
    classes = _classes(every)
    lowered, some = F.lower("text"), F.lit(False)
    for word in sorted({w for *_, anchors in classes for w in anchors}):
        some = some | lowered.contains(word)
    likely = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL").where(some)
    worded = likely.select("doc_id", words_of(F.col("text")).alias("words")).where(F.size("words") >= SHINGLE)
    # every window length in one pass over the texts
    lengths = F.array(*[
        F.struct(F.lit(n).alias("length"), F.lit(step).alias("step"), F.lit(b).alias("bands"), F.array(*map(F.lit, anchors)).alias("anchors"))
        for n, step, b, anchors in classes
    ])
    windows = (
        worded.select("doc_id", "words", F.inline(lengths))
        .where(F.arrays_overlap("words", "anchors"))
        .select("*", F.explode(F.sequence(F.lit(0), F.size("words") - SHINGLE, F.col("step"))).alias("at"))
        .select("doc_id", "length", "bands", "anchors", F.slice("words", F.col("at") + 1, F.col("length")).alias("part"))
        .where(F.arrays_overlap("part", "anchors"))
        .select("doc_id", "length", "bands", _shingles(F.col("part")).alias("has"))
    )
    banded = windows.select("doc_id", "length", "has", F.inline(_signature(F.col("has"), F.col("bands"))))
    met = banded.join(_template_rows(docs.sparkSession, every), ["length", "band", "value"])
    return met.where(F.size(F.array_intersect("has", "wanted")) >= F.col("needed")).select("doc_id", "license").distinct()


def scan(docs: DataFrame, texts: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_licenses, licenses) per document row; names sorted and comma-joined."""
    found = matches(docs, texts).groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.count("*").alias("n_licenses"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("n_licenses", F.lit(0)).cast("long").alias("n_licenses"), F.coalesce("licenses", F.lit("")).alias("licenses")
    )
