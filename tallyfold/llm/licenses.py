"""License notices found in texts, with DataFrame functions only.

Texts and templates are cut into words (runs of letters and digits, lower case) and these into shingles of five words; a
template of fewer words is one shingle. Templates are sorted into size classes, a factor of 1.5 apart. For a class of
size c a text is cut into windows of 1.5 c shingles, one every c / 2: a notice of up to c shingles always lies whole
in some window. Each band, one min-hash each, collides with a probability of the Jaccard similarity J of window and
template, and a class has as many bands as keep the chance that none does, (1 - J) ** bands, below `MISS`. J is the least
that a window can have with a template of the class of which it holds `least`: from about 0.33 in most classes, where a
template fills two thirds of its class, down to 1/6 in the first, whose windows have six shingles for templates of one.
Templates whose bands collide are verified by the exact share of their shingles that the window holds.

A band collides only if the window holds the very shingle of the template that has the least hash there. Windows
without any such shingle are left out before anything is hashed for them, which loses nothing.
"""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINED = 0.8
MISS = 1e-4
SMALLEST = 4

# Notices by which public licences are granted.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
     "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
     "any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) "
     "any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
     "this work."),
    ("Proprietary", "All rights reserved."),
)


def words_of(text: Column) -> Column:
    """Lower-case words; empty pieces at the ends are left out."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: str, k: Column | int, make) -> Column:
    """`make` of each run of k words of an array column."""
    last = F.size(words) - F.lit(k) + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), make)).otherwise(F.array())


def _hashes(words: str, k: int) -> Column:
    return _shingles(words, k, lambda i: F.xxhash64(*[F.element_at(words, i + j) for j in range(k)]))


def _bands(hashes: Column, bands: Column | int) -> Column:
    """For each band the least hash of the shingles, mixed with the band's number so that bands stay apart."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands) - 1), lambda j: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, j)))
    )


def _decisive(hashes: Column, bands: Column | int) -> Column:
    """For each band the shingle that has the least hash."""
    pair = lambda h, j: F.struct(F.xxhash64(h, j).alias("value"), h.alias("hash"))
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands) - 1),
        lambda j: F.array_min(F.transform(hashes, lambda h: pair(h, j)))["hash"],
    )


def size_class(shingles: int) -> int:
    size = SMALLEST
    while size < shingles:
        size = math.ceil(size * 1.5)
    return size


def bands_of(shingles: int, least: float) -> int:
    """Bands that find a template in any window of its class that holds `least` of it, but for a chance of `MISS`."""
    size = size_class(shingles)
    window = size + math.ceil(size / 2)
    held = max(math.ceil(least * shingles - 1e-9), 1)
    jaccard = held / (window + shingles - held)
    return 1 if jaccard >= 1 else math.ceil(math.log(MISS) / math.log1p(-jaccard))


def _constant(value, kind: str) -> Column:
    """A nested literal of any size as one expression."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _library(spark: SparkSession, templates, least: float) -> tuple[list[Row], dict[tuple[int, int], int]]:
    """One row per template: template, license, k, hashes and texts of its distinct shingles, bands, decisive; and the
    number of bands of each class (k, size)."""
    rows = [{"template": i, "license": name, "text": text} for i, (name, text) in enumerate(templates)]
    given = spark.range(1).select(F.inline(_constant(rows, "array<struct<template:int,license:string,text:string>>")))
    cut = _computed(given, ["template", "license"], words=words_of(F.col("text")))
    sizes = {r["n"] for r in cut.select(F.size("words").alias("n")).distinct().collect()}
    found, counts = [], {}
    for k in sorted({min(n, SHINGLE) for n in sizes if n}):
        own = F.size("words") == k if k < SHINGLE else F.size("words") >= k
        distinct = {"hashes": F.array_distinct(_hashes("words", k)), "texts": F.array_distinct(_texts("words", k))}
        rows = _computed(cut.where(own), ["template", "license"], **distinct)
        for n in {r["n"] for r in rows.select(F.size("hashes").alias("n")).distinct().collect()}:
            key = (k, size_class(n))
            counts[key] = max(counts.get(key, 0), bands_of(n, least))
        most = max(n for key, n in counts.items() if key[0] == k)
        bands = {"bands": _bands(F.col("hashes"), most), "decisive": _decisive(F.col("hashes"), most)}
        found += rows.select("*", F.lit(k).alias("k"), *[c.alias(n) for n, c in bands.items()]).collect()
    return found, counts


def _texts(words: str, k: int) -> Column:
    return _shingles(words, k, lambda i: F.array_join(F.slice(words, i, F.lit(k)), " "))


def scan(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: float = CONTAINED,
) -> DataFrame:
    """One row per text and license found: id, license, containment (the best), start_word and end_word.

    The span runs from the first to behind the last word of the template's shingles in windows that hold at least
    `least` of them; words count from 0. Texts are read whole. Rows with equal ids give one row per license, null and
    empty texts give none. Other columns are ignored. No rows give no rows. The templates are a parameter and are held
    by the plan: some hundreds are no burden.
    """
    spark = docs.sparkSession
    # Bounded by the templates: a decisive shingle for each band of each.
    library, counts = _library(spark, templates, least)
    classes = sorted({(t["k"], size_class(len(t["hashes"]))) for t in library})
    keys = {
        (k, size): sorted({h for t in library if (t["k"], size_class(len(t["hashes"]))) == (k, size) for h in t["decisive"][: counts[k, size]]})
        for k, size in classes
    }
    bands = [
        {"template": t["template"], "k": t["k"], "size": size_class(len(t["hashes"])), "band": j, "value": v}
        for t in library
        for j, v in enumerate(t["bands"][: counts[t["k"], size_class(len(t["hashes"]))]])
    ]
    texts = [{"template": t["template"], "license": t["license"], "texts": t["texts"]} for t in library]
    words = _computed(docs.select(F.col(identity).alias("id"), F.col(text).alias("text")), ["id"], words=words_of(F.col("text")))
    kinds = sorted({k for k, _ in classes})
    hashed = _computed(words, ["id", "words"], **{f"h{k}": _hashes("words", k) for k in kinds})
    by_kind = {k: sorted({h for c in classes if c[0] == k for h in keys[c]}) for k in kinds}
    overlaps = [F.arrays_overlap(f"h{k}", _constant(by_kind[k], "array<bigint>")) for k in kinds]
    marked = hashed.where(reduce(Column.__or__, overlaps))

    # All windows of all classes in one array, so that the text is cut once.
    windows = F.concat(*[_windows(k, size, keys[k, size], counts[k, size]) for k, size in classes])
    cut = marked.select("id", F.explode(windows).alias("w")).select("id", "w.*")
    hashed_windows = cut.select("id", "k", "size", "start", "words", _bands(F.col("hashes"), F.col("n")).alias("bands"))
    met = hashed_windows.select("id", "k", "size", "start", "words", F.posexplode("bands").alias("band", "value")).join(
        _rows(spark, bands, "template:int,k:int,size:int,band:int,value:bigint"), ["k", "size", "band", "value"]
    )
    retrieved = met.groupBy("id", "k", "size", "start", "template", F.xxhash64("words").alias("mark")).agg(
        F.first("words").alias("words")
    )
    verified = (
        retrieved.join(_rows(spark, texts, "template:int,license:string,texts:array<string>"), "template")
        .withColumn("own", _texts_of_kind(kinds))
        .withColumn("share", F.size(F.array_intersect("own", "texts")) / F.size("texts"))
        .where(F.col("share") >= least)
    )
    places = F.filter(
        F.transform("own", lambda s, i: F.when(F.array_contains("texts", s), F.col("start") + i)), lambda p: p.isNotNull()
    )
    return (
        verified.withColumn("places", places)
        .groupBy("id", "license")
        .agg(
            F.max("share").alias("containment"),
            F.min(F.array_min("places")).cast("long").alias("start_word"),
            F.max(F.array_max("places") + F.col("k")).cast("long").alias("end_word"),
        )
    )


def _computed(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Computes columns once for a row. As the output of a generator they are values to the optimizer, which would
    otherwise put their expressions into filters and lambdas, to be computed for every element of an array."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _rows(spark: SparkSession, rows: list[dict], fields: str) -> DataFrame:
    return spark.range(1).select(F.inline(_constant(rows, f"array<struct<{fields}>>")))


def _windows(k: int, size: int, keys: list[int], bands: int) -> Column:
    """Windows of a class that hold a decisive shingle, as structs (k, size, n, start, hashes, words), n bands each."""
    step, length = math.ceil(size / 2), size + math.ceil(size / 2)
    decisive = _constant(keys, "array<bigint>")
    starts = F.sequence(F.lit(0), F.greatest(F.size(f"h{k}") - 1, F.lit(0)), F.lit(step))
    held = F.filter(starts, lambda s: F.arrays_overlap(F.slice(f"h{k}", s + 1, F.lit(length)), decisive))
    return F.transform(
        held,
        lambda s: F.struct(
            F.lit(k).alias("k"),
            F.lit(size).alias("size"),
            F.lit(bands).alias("n"),
            s.alias("start"),
            F.slice(f"h{k}", s + 1, F.lit(length)).alias("hashes"),
            F.slice("words", s + 1, F.lit(length + k - 1)).alias("words"),
        ),
    )


def _texts_of_kind(kinds: list[int]) -> Column:
    found = F.array().cast("array<string>")
    for k in kinds:
        found = F.when(F.col("k") == k, _texts("words", k)).otherwise(found)
    return found
