"""Licence notices in texts: MinHash bands over windows find them, shingles verify.

A text is lower-cased and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; its
shingles are five words. Blocks of eight shingles get one minimum for each of
`BANDS` permutations, two neighbouring blocks make a window of sixteen, and windows
overlap by half, so every run of eight shingles lies inside one window. Templates
are cut into pieces of eight shingles. A piece of which seven shingles stand in a
window has a Jaccard similarity of at least 7/17 with it; sixteen bands of one row
then miss it with probability 0.0002, and a piece of which six are left (6/18)
with 0.0015. Templates of fewer than eight shingles use windows of one shingle,
where the similarity is 1 and nothing is missed. Candidates are then verified: the
share of the template's distinct shingles, as text, that the document holds. Of variants that
share most of their words the right one stays: a notice is dropped if all its shingles that
the document holds stand in another template too, of which it holds a larger share, or the same
share and more shingles.

Everything is a projection on the row of a document: nothing is shuffled or joined, and the
templates are the only thing in the plan (their number of words is checked).

Defined cases: missing and empty texts, and texts of fewer than five words, match
nothing; a template of fewer than five words is refused; repeated rows give repeated
matches; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices by licence (fixed values: public standard wordings).
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
    "See the License for the specific language governing permissions and limitations under the License",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
    "contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
    "this work",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-4.0-sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
    "2.0 which is available at",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
    "your option) any later version",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
    "(at your option) any later version",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version",
    "MIT": "Released under the MIT License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the Software), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means",
    "Zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions",
}
SHINGLE = 5
BLOCK = 8
BANDS = 16
CONTAINMENT = 0.8
#: Words that all templates may have together.
TEMPLATE_WORDS = 200_000
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


#: One number for each permutation: multiples of the golden ratio's 64 bits.
PERMUTATIONS = [_signed((0x9E3779B97F4A7C15 * (i + 1)) % (1 << 64)) for i in range(BANDS)]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BREAKS), "")


def _each(count: Column, function) -> Column:
    """``function`` of 0 .. count-1, an empty array for a count below one."""
    return F.when(count >= 1, F.transform(F.sequence(F.lit(0), count - 1), function)).otherwise(F.array())


def _let(value: Column, function) -> Column:
    """``function`` of a value that is computed once, also where a lambda uses it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def shingle_hashes(w: Column) -> Column:
    def mixed(h: Column) -> Column:
        return _each(F.size(h) - (SHINGLE - 1), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(SHINGLE))))

    return _let(F.transform(w, lambda x: F.xxhash64(x)), mixed)


def shingle_texts(w: Column) -> Column:
    def joined(own: Column) -> Column:
        return _each(F.size(own) - (SHINGLE - 1), lambda i: F.concat_ws(" ", F.slice(own, i + 1, SHINGLE)))

    return F.array_distinct(_let(w, joined))


def minima(run: Column) -> Column:
    """The bands of a run of up to `BLOCK` shingles: its minimum under every permutation."""

    def bands(own: Column) -> Column:
        members = [F.get(own, F.lit(i)) for i in range(BLOCK)]
        return F.array(*(F.least(*(m.bitwiseXOR(F.lit(c)) for m in members)) for c in PERMUTATIONS))

    return _let(run, bands)


def window_bands(hashes: Column) -> Column:
    """The bands of all windows, by windows of two blocks that overlap by one."""

    def blocks(h: Column) -> Column:
        return _each(F.ceil(F.size(h) / BLOCK).cast("int"), lambda b: minima(F.slice(h, b * BLOCK + 1, BLOCK)))

    def joined(m: Column) -> Column:
        return F.transform(
            m, lambda own, b: F.zip_with(own, F.coalesce(F.get(m, b + 1), own), lambda x, y: F.least(x, y))
        )

    return F.flatten(_let(_let(hashes, blocks), joined))


class Templates:
    """Notices with their shingles, probes and an inverted list from probe to notice."""

    def __init__(self, df: DataFrame, notices: Mapping[str, str]):
        if sum(len(t.split()) for t in notices.values()) > TEMPLATE_WORDS:
            raise ValueError(f"the templates have more than {TEMPLATE_WORDS} words; match them in several calls")
        spark = df.sparkSession
        source = spark.createDataFrame(list(notices.items()) or [("", "")], "license string, notice string")
        source = source.withColumn("_w", words(F.col("notice"))).withColumn("_h", shingle_hashes(F.col("_w")))
        n = F.size("_h")
        last = F.greatest(n - BLOCK + 1, F.lit(1))
        at = F.array_distinct(F.concat(F.sequence(F.lit(1), last, F.lit(BLOCK)), F.array(last)))
        pieces = _let(F.col("_h"), lambda h: F.transform(at, lambda i: minima(F.slice(h, i, BLOCK))))
        found = source.select(
            "license",
            shingle_texts(F.col("_w")).alias("shingles"),
            F.when(n >= BLOCK, F.flatten(pieces)).otherwise(F.col("_h")).alias("probes"),
            (n >= BLOCK).alias("long"),
            F.col("_h").alias("hashes"),
        ).collect()
        if notices and (short := [r["license"] for r in found if not r["shingles"]]):
            raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
        found = [r for r in found if r["shingles"]]
        self.texts = {r["license"]: list(r["shingles"]) for r in found}
        self.bands = sorted({p for r in found if r["long"] for p in r["probes"]})
        self.shingles = sorted({h for r in found if r["long"] for h in r["hashes"]})
        self.single = sorted({p for r in found if not r["long"] for p in r["probes"]})
        owners: dict[int, list[str]] = {}
        for r in found:
            for p in set(r["probes"]):
                owners.setdefault(p, []).append(r["license"])
        self.owners = owners

    def template(self, license_: Column) -> Column:
        """The shingles of a notice by its name."""
        if not self.texts:
            return F.array().cast("array<string>")
        return F.create_map(*[x for name, own in self.texts.items() for x in (F.lit(name), F.array(*map(F.lit, own)))])[license_]

    def candidates(self, hashes: Column) -> Column:
        """Names of the notices that share a band with a window of the text."""
        return _let(hashes, self._candidates)

    def _candidates(self, hashes: Column) -> Column:
        hits = []
        if self.bands:
            # A window without any shingle of a template has no minimum in common with it.
            met = F.arrays_overlap(hashes, F.array(*map(F.lit, self.shingles)))
            hits.append(F.when(met, F.array_intersect(window_bands(hashes), F.array(*map(F.lit, self.bands)))).otherwise(F.array()))
        if self.single:
            hits.append(F.array_intersect(hashes, F.array(*map(F.lit, self.single))))
        if not hits:
            return F.array().cast("array<string>")
        entries = [x for p, names in self.owners.items() for x in (F.lit(p), F.array(*map(F.lit, names)))]
        return F.array_distinct(F.flatten(F.transform(F.concat(*hits), lambda p: F.create_map(*entries)[p])))


def find_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", notices: Mapping[str, str] = NOTICES, least: float = CONTAINMENT
) -> DataFrame:
    """One row for each document and notice that it holds: shared and all shingles."""
    templates = Templates(docs, notices)
    found = docs.select(F.col(key).alias("_key"), words(F.col(text)).alias("_w")).select(
        "_key", "_w", templates.candidates(shingle_hashes(F.col("_w"))).alias("_found")
    )
    held = F.when(F.size("_found") > 0, _let(shingle_texts(F.col("_w")), lambda own: _verified(F.col("_found"), own, templates, least)))
    # An inner explode would make the optimizer compute all this a second time, in a
    # filter on the array's size.
    hits = found.select("_key", F.explode_outer(held).alias("_hit")).where(F.col("_hit").isNotNull())
    return hits.select(F.col("_key").alias(key), "_hit.license", "_hit.n_shared", "_hit.n_template", "_hit.containment")


def _verified(names: Column, own: Column, templates: Templates, least: float) -> Column:
    """The notices of which a text with these shingles holds enough, without worse variants."""

    def hit(name: Column) -> Column:
        template = templates.template(name)
        shared = F.array_intersect(template, own)
        return F.struct(
            name.alias("license"),
            F.size(shared).cast("bigint").alias("n_shared"),
            F.size(template).cast("bigint").alias("n_template"),
            (F.size(shared) / F.size(template)).alias("containment"),
            shared.alias("shared"),
        )

    def worse(h: Column, o: Column) -> Column:
        less = (h.containment < o.containment) | ((h.containment == o.containment) & (h.n_shared < o.n_shared))
        return less & (F.size(F.array_except(h.shared, templates.template(o.license))) == 0)

    hits = F.filter(F.transform(names, hit), lambda h: h.containment >= F.lit(least))
    return _let(hits, lambda all_: F.filter(all_, lambda h: ~F.exists(all_, lambda o: worse(h, o))))
