"""License scans: MinHash bands retrieve templates, exact shingle containment verifies. Column expressions only.

Texts and templates become five-word shingles. A template of T shingles belongs
to the class of the next power of two L; text windows of that class hold 2L
shingles and start at every L-th, so any run of L shingles lies in one window.
A template at 0.8 containment then has a Jaccard similarity of at least
0.4 / 2.2 = 0.18 with its window, and ``BANDS`` bands of one row each collide
with probability 1 - 0.82 ** 64, above 0.99999. A window that shares no shingle
with the catalogue has similarity 0 with every template, so no signature is
computed for it.

Each document is scanned by itself, with no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.llm.pii_boosting import let

SHINGLE = 5
BANDS = 64
CONTAINMENT = 0.8

#: Well-known notices of public licences, by SPDX id.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words(text: Column) -> Column:
    """Runs of digits, lower-case letters and non-ASCII characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


def shingle_hash(w: Column, i: Column) -> Column:
    return F.xxhash64(*[F.element_at(w, i + (j + 1)) for j in range(SHINGLE)])


def shingle_text(w: Column, i: Column) -> Column:
    return F.concat_ws(" ", F.slice(w, i + 1, F.lit(SHINGLE)))


def places(lo: Column | int, hi: Column) -> Column:
    """lo, lo + 1, ... hi - 1 (none if lo is not below hi)."""
    lo = F.lit(lo) if isinstance(lo, int) else lo
    return F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<int>"))


def signature(hashes: Column) -> Column:
    """MinHash values of a set of shingle hashes, one per band."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))))


class Catalogue:
    """Templates with their shingles and signatures, a fixed table that becomes literals of the plan."""

    def __init__(self, spark: SparkSession, templates=TEMPLATES):
        rows = spark.createDataFrame([(i, *t) for i, t in enumerate(templates)], "n int, name string, text string")
        w = rows.select("n", "name", words(F.col("text")).alias("w"))
        at = places(0, F.size("w") - (SHINGLE - 1))
        sets = w.select("n", "name", F.array_distinct(F.transform(at, lambda i: shingle_text(F.col("w"), i))).alias("texts"), F.array_distinct(F.transform(at, lambda i: shingle_hash(F.col("w"), i))).alias("hashes"))
        found = sets.where(F.size("texts") > 0).select("*", signature(F.col("hashes")).alias("sig")).orderBy("n").collect()
        self.rows = found
        self.known = sorted({h for r in found for h in r["hashes"]})
        self.classes: dict[int, list] = {}
        for r in found:
            self.classes.setdefault(1 << (len(r["texts"]) - 1).bit_length(), []).append(r)

    def literal(self, size: int) -> Column:
        """The templates of a class as an array of structs."""
        return F.array(
            *[
                F.struct(
                    F.lit(r["n"]).alias("n"), F.lit(r["name"]).alias("name"), F.array(*[F.lit(t) for t in r["texts"]]).alias("texts"),
                    F.array(*[F.lit(s) for s in r["sig"]]).alias("sig"),
                )
                for r in self.classes[size]
            ]
        )


def _own(good: Column) -> Column:
    """The templates that matched something of their own: left out if a better one matched every shingle they did."""

    def explained(s: Column) -> Column:
        return F.exists(good, lambda x: (x["containment"] > s["containment"]) & (F.size(F.array_except(s["held"], x["held"])) == 0))

    return F.transform(F.filter(good, lambda s: ~explained(s)), lambda s: s.dropFields("held"))


def _window_matches(w: Column, k: Column, size: int, catalogue: Catalogue) -> Column:
    """Verified templates of one window: (name, template, word, containment), see ``_own``."""
    at = places(k * size, F.least((k + 2) * size, F.size(w) - (SHINGLE - 1)))

    def verify(idx: Column) -> Column:
        def retrieved(sig: Column) -> Column:
            return F.filter(catalogue.literal(size), lambda t: F.exists(F.zip_with(sig, t["sig"], lambda a, b: a == b), lambda x: x))

        def contained(found: Column) -> Column:
            def share(texts: Column) -> Column:
                scored = F.transform(
                    F.transform(found, lambda t: F.struct(t.alias("t"), F.array_intersect(t["texts"], texts).alias("held"))),
                    lambda s: F.struct(
                        s["t"]["name"].alias("name"), s["t"]["n"].alias("template"), (k * size).alias("word"),
                        (F.size(s["held"]) / F.size(s["t"]["texts"])).alias("containment"), s["held"].alias("held"),
                    ),
                )
                return let(F.filter(scored, lambda s: s["containment"] >= CONTAINMENT), _own)

            return let(F.transform(idx, lambda i: shingle_text(w, i)), share)

        hashes = F.transform(idx, lambda i: shingle_hash(w, i))
        return let(hashes, lambda hs: let(signature(hs), lambda sig: let(retrieved(sig), contained)))

    return let(at, verify)


def matches(text: Column, catalogue: Catalogue) -> Column:
    """All verified template windows of a text."""
    kind = "array<struct<name:string,template:int,word:int,containment:double>>"

    def scan(w: Column) -> Column:
        hits = F.filter(places(0, F.size(w) - (SHINGLE - 1)), lambda i: shingle_hash(w, i).isin(catalogue.known))

        def of_class(h: Column, size: int) -> Column:
            near = F.flatten(F.transform(h, lambda i: F.array(F.floor(i / size).cast("int"), (F.floor(i / size) - 1).cast("int"))))
            return F.flatten(F.transform(F.filter(F.array_distinct(near), lambda k: k >= 0), lambda k: _window_matches(w, k, size, catalogue)))

        def all_classes(h: Column) -> Column:
            parts = [of_class(h, size) for size in sorted(catalogue.classes)]
            return F.when(F.size(h) > 0, reduce(lambda a, b: F.concat(a, b), parts).cast(kind)).otherwise(F.array().cast(kind))

        return let(hits, all_classes)

    return let(words(F.coalesce(text, F.lit(""))), scan)


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """Each row of ``docs`` as ``row`` with ``matches`` and ``licenses`` (sorted distinct names).

    A template is reported where at least 0.8 of its shingles lie in one window
    of its class, unless another template of the class has more of its own there
    and holds all the shingles that matched: "version 3 of the License" tells
    GPL-3.0 from GPL-2.0, and a second notice in the window stays.
    Templates of under five words have no shingles and are ignored; texts of
    under five words and nulls have no matches; repeated rows are scanned
    alike; an empty table or catalogue gives no matches.
    """
    catalogue = Catalogue(docs.sparkSession, templates)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("t"))
    if not catalogue.rows:
        kind = "array<struct<name:string,template:int,word:int,containment:double>>"
        return rows.select("row", F.array().cast(kind).alias("matches"), F.array().cast("array<string>").alias("licenses"))
    found = rows.select("row", matches(F.col("t"), catalogue).alias("matches"))
    return found.withColumn("licenses", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["name"]))))
