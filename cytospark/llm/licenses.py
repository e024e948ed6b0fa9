"""License scans: MinHash bands over overlapping windows find templates, exact shingle containment verifies them; DataFrame functions only.

A template of m words is looked for in windows of 1.5 M words that begin every M / 2 words, where M is the least power of two from 8 up with m <= M:
each place where it can stand lies within one window. From its own number of shingles follows the least Jaccard resemblance to a window that
holds 80 % of its 5-word shingles; each M has as many bands, of one MinHash each, as the least of its templates' resemblances needs for a
window to collide in none with a probability of at most `MISS`. Templates of at most `FEW` shingles have no bands: every window with
any of their shingles is a candidate, and none is missed. Candidates are compared shingle by shingle, and the share of the template's
shingles must be `CONTAINMENT`.

A match may miss a fifth of the shingles. Marked words are words of the template that meet more shingles than that, so that each match holds
one of them; texts and windows without any marked word can't match, and are passed over before they are hashed.

Nulls and edge cases: a null text has no words; texts and templates of fewer than five words have no shingles and match nothing; rows with the same
doc_id count as one document; of equal containments the first window is given.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SHINGLE, CONTAINMENT = 5, 0.8
#: Most shingles of a template that is found by them all, and the probability with which bands may miss a window of another.
FEW, MISS = 12, 1e-6
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Notices of public licenses, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MIT-line": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


def size_class(n: int) -> int:
    """The least power of two from 8 up that is not below n."""
    return max(8, 1 << max(0, n - 1).bit_length())


def marked_words(words: list[str], shingle: int = SHINGLE, containment: float = CONTAINMENT) -> list[str]:
    """Long words that meet more shingles than a match may miss, so that every match holds one of them."""
    left = [set(x) for x in {tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)}]
    may_miss, out = len(left) - math.ceil(containment * len(left) - 1e-9), []
    need = may_miss + 1
    while need > 0:
        best = max(sorted(set().union(*left)), key=lambda w: (len(w), w))
        out.append(best)
        need -= sum(best in s for s in left)
        left = [s for s in left if best not in s]
    return out


def bands_needed(n_shingles: int, m: int) -> int:
    """Bands that a window of size class m needs to miss a match of a template of so many shingles with a probability of at most MISS."""
    if n_shingles <= FEW:
        return 0
    have = math.ceil(CONTAINMENT * n_shingles - 1e-9)
    least = have / (m + m // 2 - SHINGLE + 1 + n_shingles - have)
    return math.ceil(math.log(MISS) / math.log1p(-least)) if least < 1 else 1


def _shingles(words: Column) -> Column:
    """Distinct shingles of an array of words."""
    at = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))


def _hashes(shingles: Column) -> Column:
    return F.transform(shingles, lambda s: F.xxhash64(s))


def _keys(m: Column, hashes: Column, bands: Column) -> Column:
    """One number for each band: of the size class, the band, and the least hash in the band's order."""
    least = lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b)))
    some = F.when(bands > 0, F.sequence(F.lit(0), bands - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(some, lambda b: F.xxhash64(m, b, least(b)))


def _short_keys(m: Column, hashes: Column) -> Column:
    """One number for each shingle: of the size class, no band, and the hash."""
    return F.transform(hashes, lambda h: F.xxhash64(m, F.lit(-1), h))


def _windows(m: int, marked: list[str]) -> Column:
    """Array of (m, word, words): the windows of one size class that hold one of its marked words; the column `words` has all words."""
    half, n = m // 2, F.size("words")
    last = F.floor((F.greatest(F.lit(1), n - half) - 1) / half).cast("int")
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(marked), i)), lambda i: i.isNotNull())
    # the word at p lies in the windows that begin at half * (p / half - 2) to half * (p / half)
    near = lambda p: F.sequence(F.greatest(F.lit(0), F.floor(p / half).cast("int") - 2), F.least(last, F.floor(p / half).cast("int")))
    starts = F.array_distinct(F.flatten(F.transform(places, near)))
    return F.transform(starts, lambda t: F.struct(F.lit(m).alias("m"), (t * half + 1).alias("word"), F.slice("words", t * half + 1, m + half).alias("words")))


def scan(documents: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES) -> DataFrame:
    """(doc_id, template_id, containment, word): each template that a document holds, and where its best window begins.

    Templates are a dictionary or a table (template_id, text) of license texts, which goes to the driver; texts of fewer than five words are passed over.
    """
    spark = documents.sparkSession
    if isinstance(templates, DataFrame):
        templates = {r[0]: r[1] or "" for r in templates.select("template_id", "text").where("template_id IS NOT NULL").collect()}
    words = {k: template_words(t) for k, t in templates.items()}
    rows = [(k, size_class(len(w)), w) for k, w in sorted(words.items()) if len(w) >= SHINGLE]
    if not rows:
        return documents.select("doc_id", F.lit("").alias("template_id"), F.lit(0.0).alias("containment"), F.lit(0).cast("bigint").alias("word")).where("false")
    grams = {k: {" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} for k, _, w in rows}
    bands, marked = {}, {}
    for k, m, w in rows:
        bands[m] = max(bands.get(m, 0), bands_needed(len(grams[k]), m))
        marked[m] = sorted({*marked.get(m, ()), *marked_words(w)})
    known = spark.createDataFrame([(k, m, len(grams[k]) <= FEW, bands[m], w) for k, m, w in rows], "template_id string, m int, short boolean, bands int, words array<string>")
    known = known.select("template_id", "m", "short", "bands", _shingles(F.col("words")).alias("template"))
    key = F.when(F.col("short"), _short_keys(F.col("m"), _hashes(F.col("template")))).otherwise(_keys(F.col("m"), _hashes(F.col("template")), F.col("bands")))
    wanted = known.select("template_id", "template", F.explode(key).alias("key"))
    wanted_keys = sorted({r[0] for r in wanted.select("key").collect()})
    # folding all case finds words of ASCII at least where folding A-Z does, and is faster; other words are looked for as templates are folded
    folded, exact, any_marked = F.lower("text"), F.translate("text", _UPPER, _LOWER), F.lit(False)
    for x in sorted({x for some in marked.values() for x in some}, key=lambda x: (not x.isascii(), x)):
        any_marked = any_marked | F.contains(folded if x.isascii() else exact, F.lit(x))
    docs = documents.select("doc_id", "text").where(any_marked)
    docs = docs.select("doc_id", F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(WORD), F.lit(0)).alias("words"))
    # windows are cut before they become rows, so that no row has more than its window
    some = docs.select("doc_id", F.explode(F.concat(*[_windows(m, marked[m]) for m in sorted(bands)])).alias("w")).select("doc_id", "w.m", "w.word", _shingles(F.col("w.words")).alias("shingles"))
    some = some.where(F.size("shingles") > 0).withColumn("hashes", _hashes(F.col("shingles")))
    n_bands = F.element_at(F.create_map(*[F.lit(x) for m in sorted(bands) for x in (m, bands[m])]), F.col("m"))
    with_short = sorted({m for k, m, _ in rows if len(grams[k]) <= FEW})
    short = F.when(F.col("m").isin(with_short), _short_keys(F.col("m"), F.col("hashes"))).otherwise(F.array().cast("array<bigint>"))
    # only keys that a template has become rows
    keys = F.array_intersect(F.concat(_keys(F.col("m"), F.col("hashes"), n_bands), short), F.array(*[F.lit(k) for k in wanted_keys]))
    pairs = some.withColumn("key", F.explode(keys)).select("doc_id", "word", "shingles", "key")
    pairs = pairs.join(F.broadcast(wanted), "key")
    share = F.size(F.array_intersect("shingles", "template")) / F.size("template")
    pairs = pairs.select("doc_id", "template_id", F.round(share, 6).alias("containment"), (F.col("word") - 1).alias("word")).where(F.col("containment") >= CONTAINMENT)
    best = pairs.groupBy("doc_id", "template_id").agg(F.max(F.struct("containment", (-F.col("word")).alias("at"))).alias("b"))
    return best.select("doc_id", "template_id", "b.containment", (-F.col("b.at")).cast("bigint").alias("word"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of every document that has any."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """All windows against all templates, without bands."""
    values = ", ".join(f"('{k}', {size_class(len(w))}, {w!r})" for k, w in ((k, template_words(t)) for k, t in sorted(TEMPLATES.items())) if len(w) >= SHINGLE)
    return rf"""
WITH t0(template_id, m, w) AS (VALUES {values}),
t AS (SELECT DISTINCT template_id, m, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM t0),
tn AS (SELECT template_id, count(*) AS total FROM t GROUP BY 1),
d AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, len(w) AS n, unnest(range(1, len(w) - 3)) AS p, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) >= 5),
h AS (SELECT doc_id, n, p, template_id, m, s.s FROM s JOIN t USING (s)),
x AS (SELECT doc_id, template_id, m, s, unnest(range(0, 4)) AS back, p, n FROM h),
y AS (SELECT doc_id, template_id, s, 1 + (m // 2) * ((p - 1) // (m // 2) - back) AS a, m, p, n FROM x),
z AS (SELECT doc_id, template_id, a, count(DISTINCT s) AS have FROM y WHERE a >= 1 AND a <= greatest(1, n - m + m // 2) AND p + 4 <= a + m + m // 2 - 1 GROUP BY 1, 2, 3),
c AS (SELECT doc_id, template_id, a, round(have / total::DOUBLE, 6) AS containment FROM z JOIN tn USING (template_id))
SELECT doc_id, template_id, containment, CAST(min(a) - 1 AS BIGINT) AS word FROM c WHERE containment >= 0.8 AND (doc_id, template_id, containment) IN (SELECT (doc_id, template_id, max(containment)) FROM c GROUP BY doc_id, template_id) GROUP BY 1, 2, 3
"""


OP10_SQL = _sql()
