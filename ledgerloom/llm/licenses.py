"""Licence notices by MinHash bands over text windows and exact containment, in DataFrame functions only.

Texts are cut into words of letters and digits, in lower case, and shingles of five words (a template with fewer is one
shingle). For templates of ``c/2 < m <= c`` shingles (``c`` a power of two), windows of ``2c`` shingles begin at
every ``c``-th one, so that any ``c`` shingles in a row are whole in one window. A window that holds a share
``CONTAINMENT`` of a template has a Jaccard similarity of 0.19 or more to it, so one of ``BANDS`` bands of one MinHash collides with
probability 1 - 0.81 ** 64, over 0.999998. Whatever collides is verified: distinct shingles of the template in the window, over all of
the template's. Templates much alike are a family (versions of one notice). A match gives way to another of its family only where their windows
overlap, the other has the larger share, and the other's template has all shingles that were found: one notice is not reported as two
versions, and two notices of a family in one text are both found, near or far. The best window of each template in a document is returned.

Two filters come before the hashing, and lose nothing: a window without any shingle of a template shares no MinHash with it;
and a share of ``CONTAINMENT`` of a template holds one of the anchors, words chosen so that fewer shingles are without.

Null and empty texts have no notices. Repeated rows of one key count as one document; each row of a null key is a document of its own.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64

# Notices as their licences word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
        " \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License,"
        " or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from"
        " this software without specific prior written permission.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0 Universal."],
}


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _shingles(words: list[str]) -> list[tuple[str, ...]]:
    n = min(SHINGLE, len(words))
    return list(dict.fromkeys(tuple(words[i : i + n]) for i in range(len(words) - n + 1)))


def anchors(templates: list[list[str]], share: float = CONTAINMENT) -> list[str]:
    """Words such that, in every template, a share of its shingles must hold one. Long words first."""
    chosen: list[str] = []
    for words in sorted(templates, key=len):
        every = _shingles(words)
        left = [s for s in every if not set(chosen) & set(s)]
        while len(left) >= share * len(every):
            count = Counter(w for s in left for w in set(s))
            chosen.append(max(count, key=lambda w: (len(w), count[w], w)))
            left = [s for s in left if chosen[-1] not in s]
    return chosen


def _hash5(words: Column, n: int = SHINGLE) -> Column:
    """The hash of the shingle at each position."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n))))


def _minhash(window: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.array_min(F.transform(window, lambda h: F.xxhash64(h, b))))


def _once(df: DataFrame, keep: list, **made: Column) -> DataFrame:
    """Columns ``keep`` and ``made``, the latter computed once for each row: behind a generator, the optimizer does not copy
    them into the functions that are applied to each of their elements."""
    return df.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in made.items())))))


def template_table(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """(license, template, number, family, width, n, shingles) of each template; a few dozen rows. Templates that share half their shingles are a family."""
    rows = [(name, k, _words(t)) for name, ts in templates.items() for k, t in enumerate(ts)]
    sets = [set(_shingles(r[2])) for r in rows]
    family = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 2 * len(sets[a] & sets[b]) >= min(len(sets[a]), len(sets[b])):
                family = [family[b] if f == family[a] else f for f in family]
    short = [r for r in rows if len(r[2]) < SHINGLE]
    if short:
        raise ValueError(f"a template needs {SHINGLE} words: {short[0]}")
    numbered = [(*r, f, i) for i, (r, f) in enumerate(zip(rows, family))]
    words = spark.createDataFrame(numbered, "license string, template int, words array<string>, family int, number int")
    hashed = _once(words, ["license", "template", "number", "family"], shingles=F.array_distinct(_hash5(F.col("words"))))
    width = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles")))).cast("int")
    return hashed.select("license", "template", "number", "family", "shingles", F.size("shingles").alias("n"), width.alias("width"))


def scan(
    documents: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None, containment: float = CONTAINMENT
) -> DataFrame:
    """(key, license, template, containment, first_shingle) of the notices in each whole text."""
    spark = documents.sparkSession
    templates = templates or TEMPLATES
    table = template_table(spark, templates)
    known = table.select("width", "shingles").collect()  # the templates alone
    every = sorted({s for r in known for s in r["shingles"]})
    widths = sorted({r["width"] for r in known})

    # a null key does not tell rows apart; a number of the row does
    named = documents.select(
        F.col(f"`{key}`").alias("key"), F.when(F.col(f"`{key}`").isNull(), F.monotonically_increasing_id()).alias("row"), F.col(f"`{text}`").alias("text")
    )
    lower = F.lower("text")
    found = anchors([_words(t) for ts in templates.values() for t in ts], containment)
    anchored = F.lit(False)
    for a in found:
        anchored = anchored | F.contains(lower, F.lit(a))
    cut = _once(
        named.where(anchored), ["key", "row"],
        words=F.split(F.trim(F.regexp_replace(lower, r"[^\p{L}\p{N}]+", " ")), " "),
    )
    hashed = _once(cut.where(F.size("words") >= SHINGLE), ["key", "row"], hashes=_hash5(F.col("words")))
    numbered = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    hits = _once(
        hashed, ["key", "row", "hashes"],
        hits=F.transform(F.filter(numbered, lambda x: x.h.isin(every)), lambda x: x.i),
    ).where(F.size("hits") > 0)
    # the windows of each width that hold a hit: position p is in those that begin at (p / c) c and one step before
    starts = F.flatten(
        F.array(
            *(
                F.transform(
                    F.array_distinct(F.flatten(F.transform("hits", lambda p: F.array((p / c).cast("int"), (p / c).cast("int") - 1)))),
                    lambda w: F.struct(F.lit(c).alias("width"), F.greatest(w * c, F.lit(0)).alias("start")),
                )
                for c in widths
            )
        )
    )
    placed = hits.select("key", "row", "hashes", F.explode(F.array_distinct(starts)).alias("w"))
    windows = _once(
        placed, ["key", "row", F.col("w.width").alias("width"), F.col("w.start").alias("start")],
        window=F.array_distinct(F.slice("hashes", F.col("w.start") + 1, F.col("w.width") * 2)),
    )
    bands = windows.select("key", "row", "width", "start", "window", F.posexplode(_minhash(F.col("window"))).alias("band", "value"))
    kin = table.select("family", F.struct("number", "shingles").alias("k")).groupBy("family").agg(F.collect_list("k").alias("kin"))
    theirs = table.join(F.broadcast(kin), "family").select(
        "license", "template", "number", "family", "kin", "width", "n", "shingles", F.posexplode(_minhash(F.col("shingles"))).alias("band", "value")
    )
    matches = _once(
        bands.join(F.broadcast(theirs), ["width", "band", "value"]),  # templates x bands: fixed values, bounded
        ["key", "row", "license", "template", "number", "family", "kin", "n", "start", "width"],
        shared=F.array_intersect("window", "shingles"),
    ).where(F.size("shared") / F.col("n") >= containment)
    return _best(matches, max(widths)).select(
        F.col("key").alias(key), "license", "template", "best.containment", (-F.col("best.back")).alias("first_shingle")
    )


def _best(matches: DataFrame, widest: int) -> DataFrame:
    """The best window of each template, of the matches that do not give way to another of their family.

    Matches meet in stretches of ``widest`` shingles: each is judged in the one where it begins, and is sent to all where a window that
    overlaps it may begin (six at most). A stretch holds a bounded number of different windows, templates and shares, however often a key repeats."""
    others = F.filter("kin", lambda k: k.number != F.col("number"))
    judges = F.transform(F.filter(others, lambda k: F.size(F.array_except("shared", k.shingles)) == 0), lambda k: k.number)
    match = F.struct(
        "license", "template", "number", "start", (F.col("start") + 2 * F.col("width")).alias("end"),
        (F.size("shared") / F.col("n")).alias("containment"), judges.alias("judges"),
    )
    first = F.floor((F.col("start") - 2 * widest) / widest)
    last = F.floor((F.col("start") + 2 * F.col("width")) / widest)
    sent = _once(matches, ["key", "row", "family", F.sequence(first, last).alias("stretches")], match=match)
    met = (
        sent.select("key", "row", "family", F.explode("stretches").alias("stretch"), "match")
        .groupBy("key", "row", "family", "stretch")
        .agg(F.collect_set("match").alias("met"))
    )
    gives_way = lambda m: F.exists(
        "met",
        lambda x: F.array_contains(m.judges, x.number) & (x.containment > m.containment) & (x.start < m.end) & (m.start < x.end),
    )
    stay = F.filter("met", lambda m: (F.floor(m.start / widest) == F.col("stretch")) & ~gives_way(m))
    place = F.struct(F.col("m.containment").alias("containment"), (-F.col("m.start")).alias("back"))
    kept = met.select("key", "row", F.explode(stay).alias("m")).select("key", "row", "m.license", "m.template", place.alias("place"))
    return kept.groupBy("key", "row", "license", "template").agg(F.max("place").alias("best"))
