"""Licence scan: parts of a text against licence templates by the Dice coefficient of word bigrams.

A text is normalised (lower case; anything but a-z and 0-9 separates words, comment marks
included) and cut into atoms at line breaks and after ``.``, ``!`` or ``?`` with white space. A part is an
atom of any length, or a run of neighbouring atoms with at most as many words as the template's size
bound allows; so a line, a sentence, a notice wrapped over lines and a licence of many sentences inside other
text are parts. A template is found where the distinct bigrams of a part reach a Dice coefficient of
``THRESHOLD`` with its own.

The bound: with sizes a and b the coefficient is at most 2 min(a, b) / (a + b), so a part must have a
number of distinct bigrams between ``size_bounds``, and share at least the lower one with the template. That
prunes templates for a whole text first (its distinct bigrams must share that many, too), then parts.
Texts without any set of words that a match can't lack (``key_words``) are left out before they are
normalised. Runs are tried only between atoms that hold a word of a shared bigram: other
atoms at a run's ends add to its size and share nothing. All of it is DataFrame functions beside the scan:
no join, no Python, and only matches are shuffled.

Defined cases: null and empty texts match nothing. A document may match several licences; each is
reported with its best coefficient and the place of the part that has it (first word from 0, number of words; the
shortest, then the first on ties). Atoms of one word have no bigrams. Texts are scanned whole, however
long. Rows with equal ids (or without one) are one document. Columns beside the id and the
text are not read, so their names don't matter.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Letters from which a word is taken to be rare enough to be looked for by itself.
LONG_WORD = 6

# Short notices, opening statements and whole texts of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                   "See the License for the specific language governing permissions and limitations under the License."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
                 "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
                     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
                     "and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
                     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
                     "and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
                 "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
            "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
            "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                "You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template in order (normalised as the texts are)."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Least and most distinct bigrams of a part that can reach the threshold with a template of ``n``."""
    low, high = n * threshold / (2 - threshold), n * (2 - threshold) / threshold
    return int(-(-(low - 1e-9) // 1)), int((high + 1e-9) // 1)  # a bound that is whole counts


def key_words(templates: list[list[str]], threshold: float = THRESHOLD) -> list[tuple[str, ...]]:
    """Sets of words of which every text with a match holds all of one set.

    A part at the threshold shares at least ``size_bounds(n)[0]`` of a template's n bigrams, so it has one of any
    larger choice than the rest. A long template's choice are the bigrams with one of a few long words, and that
    word is the set; where the words for this are short and so frequent, as in short templates, the
    choice are its longest bigrams (of the same length, those with fewer vowels, which other words hold
    less often), and both words of one are a set.
    """
    out: set[tuple[str, ...]] = set()
    for grams in templates:
        spare = len(grams) - size_bounds(len(grams), threshold)[0]
        mine: set[str] = set()
        for w in sorted({w for g in grams for w in g.split()}, key=lambda w: (-len(w), w)):
            if sum(bool(mine.intersection(g.split())) for g in grams) > spare:
                break
            mine.add(w)
        if min(map(len, mine), default=0) >= LONG_WORD:
            out |= {(w,) for w in mine}
        else:
            longest = sorted(grams, key=lambda g: (-len(g), sum(g.count(v) for v in "aeiou"), g))[: spare + 1]
            out |= {tuple(sorted(g.split(), key=lambda w: (-len(w), w))) for g in longest}
    return sorted(out)


def atoms(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, atoms``: the words of every atom of every text, in order."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    cut = F.regexp_replace(F.regexp_replace(low, r"([.!?])[ \t\n\x0B\f\r]+", "$1\n"), r"[^a-z0-9\n]+", " ")
    words = F.transform(F.split(cut, "\n"), lambda a: F.filter(F.split(a, " "), lambda w: w != ""))
    return docs.select(F.col(id_col).alias("id"), F.filter(words, lambda a: F.size(a) > 0).alias("atoms"))


def _template_column(known: list[tuple[str, list[str]]], threshold: float) -> Column:
    """All templates as an array of structs."""
    rows = []
    for name, grams in known:
        low, high = size_bounds(len(grams), threshold)
        rows.append(F.struct(F.lit(name).alias("licence"), F.lit(len(grams)).alias("n"), F.lit(low).alias("low"), F.lit(high).alias("high"),
                             F.array(*[F.lit(x) for x in grams]).alias("grams")))
    return F.array(*rows)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(id, licence, dice, first_word, words): the licences found in each document, with the part that is closest."""
    known = [(name, template_bigrams(t)) for name, t in (templates or TEMPLATES)]
    keys = key_words([b for _, b in known], threshold)
    def one_of(low: Column) -> Column:
        return reduce(Column.__or__, [reduce(Column.__and__, [F.contains(low, F.lit(w)) for w in k]) for k in keys])
    holds = F.exists(F.array(F.lower(F.col(text_col))), one_of)
    cut = atoms(docs.select(id_col, text_col).filter(holds), id_col, text_col)  # no other text can match
    zero = F.array(F.lit(0))
    placed = cut.select("id", F.flatten("atoms").alias("w"), F.flatten(F.transform("atoms", lambda a, k: F.array_repeat(k, F.size(a)))).alias("of"),
                        F.aggregate(F.transform("atoms", F.size), zero, lambda ends, n: F.array_append(ends, F.element_at(ends, -1) + n)).alias("ends")).filter("size(w) > 1")
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))
    grams = placed.select("id", "of", "ends", pairs.alias("g"))
    able = F.filter(_template_column(known, threshold), lambda t: F.size(F.array_intersect(F.array_distinct(F.col("g")), t["grams"])) >= t["low"])
    with_template = grams.select("id", "of", "ends", "g", F.explode(able).alias("t"))
    # atoms that hold a word of a shared bigram, in order
    hits = F.filter(F.transform("g", lambda x, i: F.when(F.array_contains(F.col("t.grams"), x), i)), lambda i: i.isNotNull())
    touched = F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda i: F.array(F.get("of", i), F.get("of", i + 1))))))
    between = with_template.withColumn("at", touched)
    def until(s: Column, i: Column) -> Column:
        """Runs from atom ``s``, the i-th touched one: (atom, first word, words)."""
        begin = F.get("ends", s)
        later = F.slice("at", i + 1, F.col("t.high") + 2)
        runs = F.transform(later, lambda e: F.struct(begin.alias("first"), (F.get("ends", e + 1) - begin).alias("words"), (e == s).alias("alone")))
        return F.filter(runs, lambda r: r["alone"] | (r["words"] <= F.col("t.high") + 1))
    runs = F.filter(F.flatten(F.transform("at", until)), lambda r: r["words"] > F.col("t.low"))
    seen = F.transform(runs, lambda r: F.struct(r.alias("r"), F.array_distinct(F.slice("g", r["first"] + 1, r["words"] - 1)).alias("b")))
    sized = F.filter(seen, lambda x: F.size(x["b"]).between(F.col("t.low"), F.col("t.high")))
    scored = F.transform(sized, lambda x: F.struct(
        (-F.size(F.array_intersect(x["b"], F.col("t.grams"))) * F.lit(2.0) / (F.size(x["b"]) + F.col("t.n"))).alias("less"), x["r"]["words"].alias("words"), x["r"]["first"].alias("first")))
    best = between.select("id", F.col("t.licence").alias("licence"), F.array_min(scored).alias("x")).filter(F.col("x.less") <= -threshold)
    return (best.groupBy(F.col("id").alias(id_col), "licence").agg(F.min("x").alias("x"))
            .select(id_col, "licence", (-F.col("x.less")).alias("dice"), F.col("x.first").cast("long").alias("first_word"), F.col("x.words").cast("long").alias("words")))


def oracle(templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for one row per document and licence found: every run of atoms, as the definition says."""
    rows = []
    for name, text in templates or TEMPLATES:
        b = template_bigrams(text)
        low, high = size_bounds(len(b), threshold)
        rows.append("('%s', %d, %d, %d, [%s])" % (name, len(b), low, high, ", ".join(f"'{x}'" for x in b)))
    return rf"""
WITH templates(licence, n, low, high, grams) AS (VALUES {", ".join(rows)}),
cut AS (
  SELECT doc_id, regexp_replace(regexp_replace(lower(coalesce(text, '')), '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(10), 'g'), '[^a-z0-9\n]+', ' ', 'g') AS t FROM documents),
atoms AS (
  SELECT doc_id, ROW_NUMBER() OVER () AS doc,
         list_filter(list_transform(string_split(t, chr(10)), lambda a: list_filter(string_split(a, ' '), lambda w: w <> '')), lambda a: len(a) > 0) AS atoms FROM cut),
words AS (
  SELECT doc_id, doc, len(atoms) AS n_atoms, flatten(atoms) AS w,
         list_transform(range(0, len(atoms) + 1), lambda k: coalesce(list_sum(list_transform(atoms[1:k], lambda a: len(a))), 0)::BIGINT) AS ends FROM atoms),
grams AS (
  SELECT *, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM words WHERE len(w) > 1),
able AS (
  SELECT g.*, t.* FROM grams g JOIN templates t ON len(list_intersect(list_distinct(g.g), t.grams)) >= t.low),
starts AS (SELECT *, unnest(range(0, n_atoms)) AS s FROM able),
runs AS (SELECT *, unnest(range(s, least(n_atoms, s + high + 2))) AS e FROM starts),
parts AS (
  SELECT doc_id, doc, licence, n, low, high, grams, ends[s + 1] AS first_word, ends[e + 2] - ends[s + 1] AS words,
         list_distinct(g[ends[s + 1] + 1 : ends[e + 2] - 1]) AS b
  FROM runs WHERE s = e OR ends[e + 2] - ends[s + 1] <= high + 1),
scored AS (
  SELECT doc_id, licence, first_word, words, len(list_intersect(b, grams)) * 2.0::DOUBLE / (len(b) + n) AS dice FROM parts WHERE len(b) > 0)
SELECT doc_id, licence, max(dice) AS dice, first(first_word ORDER BY dice DESC, words, first_word) AS first_word, first(words ORDER BY dice DESC, words, first_word) AS words
FROM scored WHERE dice >= {threshold} GROUP BY doc_id, licence
"""
