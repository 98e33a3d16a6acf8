"""Licence notices: Dice coefficient of word bigrams between passages and templates, in DataFrame functions alone.

A document's passages are the whole text, its paragraphs and its lines. A template of m bigrams can only reach the
threshold t with passages of m t / (2 - t) to m (2 - t) / t bigrams; others are never compared. A second bound
comes from the same inequality: a passage that has none of a template's anchor words misses so many of
its bigrams that t is out of reach, so texts and passages without any anchor word are passed by.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Public licence notices, as they are commonly written in files.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

# Words too common to tell a notice by.
COMMON = {"a", "an", "and", "any", "are", "by", "for", "in", "is", "it", "not", "of", "or", "the", "this", "to", "under", "with", "you"}


def bigrams_of(text: str) -> list[str]:
    """The distinct bigrams of a template, in order."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(m: int, threshold: float) -> tuple[int, int]:
    return math.ceil(m * threshold / (2 - threshold) - 1e-9), math.floor(m * (2 - threshold) / threshold + 1e-9)


def anchors(bigrams: list[str], threshold: float) -> list[str]:
    """Few words, the longest uncommon ones first, without all of which too many of the bigrams are missing.

    With c common bigrams the coefficient is at most 2c / (m + c), so c must reach m t / (2 - t).
    """
    needed = size_bounds(len(bigrams), threshold)[0]
    chosen: list[str] = []
    words = sorted({w for b in bigrams for w in b.split()}, key=lambda w: (w in COMMON, -len(w), w))
    for word in words:
        if sum(not set(b.split()) & set(chosen) for b in bigrams) < needed:
            break
        chosen.append(word)
    return chosen


def normal(text: Column) -> Column:
    """A-Z to lower case, everything but letters a-z and digits to single blanks."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def bigrams(words: Column) -> Column:
    pairs = F.transform(words, lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    return F.array_distinct(F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, license, dice, passages), one row for each row of docs.

    license is the template of the highest coefficient at or above the threshold over all passages (ties: the first in
    order of name), dice that coefficient, passages the number of different passages that match some template. Documents
    without a match, null and empty texts among them, have null, null and 0. Null keys keep their row; repeated
    rows each give one; an empty table gives none; columns other than key and text are not read.
    """
    listed = {n: bigrams_of(t) for n, t in sorted((templates or TEMPLATES).items())}
    listed = {n: b for n, b in listed.items() if b}
    column = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    source = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), column.alias("text"))
    words = sorted({w for b in listed.values() for w in anchors(b, threshold)})
    low = F.lower("text")
    hinted = F.lit(False)
    for word in words:
        hinted = hinted | F.contains(low, F.lit(word))
    passages = F.array_distinct(F.concat(F.array("text"), F.split("text", "\n[ \t\r\n]*\n"), F.split("text", "\n")))
    least = min((size_bounds(len(b), threshold)[0] for b in listed.values()), default=1)
    most = max((size_bounds(len(b), threshold)[1] for b in listed.values()), default=0)
    tokens = F.filter(
        F.transform(passages, lambda p: F.split(normal(p), " ")), lambda w: F.size(w) > least,
    )
    # a passage of few words has few bigrams; repeats make them fewer, so only the lower bound holds for words
    sets = F.filter(F.transform(tokens, bigrams), lambda b: F.size(b).between(least, most))
    best = F.transform(sets, lambda b: nearest(b, listed, threshold))
    matches = F.filter(best, lambda x: x["dice"].isNotNull())
    top = F.array_min(F.transform(matches, lambda x: F.struct((-x["dice"]).alias("d"), x["license"].alias("license"))))
    told = source.withColumn("m", F.when(hinted, F.struct(top.alias("top"), F.size(matches).alias("n"))))
    return told.select(
        "doc_id", F.col("m.top.license").alias("license"), F.round(-F.col("m.top.d"), 6).alias("dice"),
        F.coalesce(F.col("m.n"), F.lit(0)).cast("long").alias("passages"),
    )


def nearest(passage: Column, listed: dict[str, list[str]], threshold: float) -> Column:
    """(dice, license) of the nearest template within its size bounds, nulls if none reaches the threshold."""
    options = []
    for name, grams in listed.items():
        low, high = size_bounds(len(grams), threshold)
        common = F.size(F.array_intersect(passage, F.array(*[F.lit(g) for g in grams])))
        dice = F.lit(2.0) * common / (F.size(passage) + F.lit(len(grams)))
        fits = F.size(passage).between(low, high)
        options.append(F.when(fits, F.when(dice >= threshold - 1e-9, F.struct((-dice).alias("d"), F.lit(name).alias("license")))))
    best = F.array_min(F.array_compact(F.array(*options))) if options else F.lit(None).cast("struct<d:double,license:string>")
    return F.struct((-best["d"]).alias("dice"), best["license"].alias("license"))
