"""Licence scan: word bigrams compared with licence templates by the Dice coefficient.

A text is normalised (A-Z lower-cased; all but a-z, 0-9 and line breaks become blanks) and cut into units:
its lines, its paragraphs (parted by blank lines) and itself. For the sets of word bigrams A of a unit and B
of a template, Dice = 2 |A n B| / (|A| + |B|) can reach a threshold t only when |A| lies between
|B| t / (2 - t) and |B| (2 - t) / t, so only templates of a fitting size are compared. Everything is done in
the row by built-in functions: no Python, no join, and only findings are shuffled.

Defined cases: null and empty texts, and units of fewer than two words, have no bigram and match nothing;
equal units of a document count once; repeated rows (equal id) are one document; documents with a null id
are one document; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICE = 0.8

# Notices and short texts of common licences, under their SPDX names.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."),
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0."),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.",),
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams, in order of first appearance."""
    text = "".join(c if c in LOWER or c in "0123456789" else " " for c in text.translate(str.maketrans(UPPER, LOWER)))
    words = text.split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9\n]+", " ")


def units(text: Column) -> Column:
    """The lines, paragraphs and whole of a normalised text; equal ones once."""
    whole = F.array(text)
    lines = F.when(F.contains(text, F.lit("\n")), F.split(text, "\n")).otherwise(F.array().cast("array<string>"))
    paragraphs = F.when(text.rlike("\n ?\n"), F.split(text, "\n ?\n")).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(lines, paragraphs, whole))


def bigrams(unit: Column) -> tuple[Column, Column]:
    """(words of a unit, its distinct word bigrams given the words column ``words``)."""
    words = F.split(F.trim(F.regexp_replace(unit, "[ \n]+", " ")), " ")
    count = F.size("words") - 1
    pairs = F.zip_with(F.slice("words", F.lit(1), count), F.slice("words", F.lit(2), count),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return words, F.array_distinct(pairs)


def bounds(size: int, least: float) -> tuple[int, int]:
    """The sizes that can reach a Dice coefficient of ``least`` with a template of this size."""
    return math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         templates: Mapping[str, tuple[str, ...]] = TEMPLATES, least: float = DICE) -> DataFrame:
    """One row per document and licence found: ``doc_id``, ``license``, ``dice`` (the best unit's) and
    ``n_units`` (distinct units that match)."""
    known = [(name, k, template_bigrams(t)) for name, texts in sorted(templates.items()) for k, t in enumerate(texts)]
    shortest = min(bounds(len(b), least)[0] for _, _, b in known)
    rows = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text"))
    unit = rows.select("doc_id", F.explode(units(F.col("text"))).alias("unit"))
    words, pairs = bigrams(F.col("unit"))
    # A unit has at most one bigram less than words.
    counted = (unit.withColumn("words", words).filter(F.size("words") - 1 >= shortest)
               .select("doc_id", "unit", pairs.alias("pairs")).withColumn("n", F.size("pairs")))

    def dice(own: list[str]) -> Column:
        fits = F.col("n").between(*bounds(len(own), least))
        shared = F.size(F.array_intersect(F.col("pairs"), F.array(*map(F.lit, own))))
        return F.when(fits, 2 * shared / (F.col("n") + len(own)))

    found = F.array(*[F.struct(F.lit(name).alias("license"), dice(own).alias("dice")) for name, _, own in known])
    hits = counted.select("doc_id", "unit", F.inline(F.filter(found, lambda s: s["dice"] >= least)))
    each = hits.groupBy("doc_id", "license", F.md5("unit").alias("unit")).agg(F.max("dice").alias("dice"))
    return each.groupBy("doc_id", "license").agg(F.max("dice").alias("dice"), F.count(F.lit(1)).alias("n_units"))


def sql(templates: Mapping[str, tuple[str, ...]] = TEMPLATES, least: float = DICE) -> str:
    """The same in DuckDB's SQL over ``documents``."""
    known = [(name, template_bigrams(t)) for name, texts in sorted(templates.items()) for t in texts]
    values = ",\n".join(f"('{name}', [{', '.join(repr(b) for b in own)}], {', '.join(map(str, bounds(len(own), least)))})"
                        for name, own in known)
    return f"""
WITH templates(license, own, low, high) AS (VALUES {values}),
rows AS (SELECT doc_id, regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9\\n]+', ' ', 'g') AS text
         FROM documents),
parts AS (SELECT doc_id, unnest(list_distinct(
            CASE WHEN contains(text, chr(10)) THEN string_split(text, chr(10)) ELSE [] END
            || CASE WHEN regexp_matches(text, '\\n ?\\n') THEN string_split_regex(text, '\\n ?\\n') ELSE [] END || [text])) AS unit
          FROM rows),
split AS (SELECT doc_id, unit, string_split(trim(regexp_replace(unit, '[ \\n]+', ' ', 'g')), ' ') AS words FROM parts),
pairs AS (SELECT doc_id, unit, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS pairs
          FROM split),
hits AS (SELECT doc_id, license, unit, max(2 * len(list_intersect(pairs, own)) / (len(pairs) + len(own))) AS dice
         FROM pairs JOIN templates ON len(pairs) BETWEEN low AND high
         GROUP BY ALL HAVING max(2 * len(list_intersect(pairs, own)) / (len(pairs) + len(own))) >= {least})
SELECT doc_id, license, round(max(dice), 6) AS dice, count(*) AS n_units FROM hits GROUP BY doc_id, license"""
