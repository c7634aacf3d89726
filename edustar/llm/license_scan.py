"""Licence scan: passages against licence templates by the Dice coefficient over word bigrams.

A passage is a line of a text, or the whole text if it has several lines (passage 0). Texts are lower-cased,
everything but letters and numbers becomes one space, and the set of neighbouring word pairs is compared:
dice = 2 * shared / (pairs of the passage + pairs of the template). A dice of t needs the passage to have
between t / (2 - t) and (2 - t) / t times the template's pairs; other templates are never compared.

Notices inside longer lines or wrapped over several are found as spans: runs of 4/5, 1 or 5/4 times a template's
pairs that begin at one of them, over line ends. Of spans that begin within a template's length of each other the best
one is a row, its passage the negated number of its first word. Lines that are reported are left out of spans, and so
is a template that the whole text reports. ``BODIES`` are compared with spans only. A text is cut into words for this
when it has one of ``_keys`` (without them no span reaches the threshold) and two thirds of some template's pairs.

Only DataFrame functions, no join and no shuffle: the templates are literals. One row per passage and template
of at least the threshold.

Defined results: null and empty texts, and passages of fewer than two words, match nothing. Rows with a null or
repeated doc_id are scanned like any other; two templates that a passage matches give a row each. An empty
table gives an empty result; extra columns have no effect.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

THRESHOLD = 0.8

# Notices and texts of common licences (SPDX name, text).
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


_MIT = (TEMPLATES[2][1] + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_TERMS = (TEMPLATES[15][1] + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
              "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
              "disclaimer in the documentation and/or other materials provided with the distribution. ")
# Whole texts and file headers (numbered after TEMPLATES). The long licences (GPL, LGPL, MPL, Apache, CC) have their notices only.
BODIES = [
    ("MIT", _MIT),
    ("BSD-2-Clause", _BSD_TERMS + _BSD),
    ("BSD-3-Clause", _BSD_TERMS + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                     "derived from this software without specific prior written permission. " + _BSD),
    ("GPL-3.0", TEMPLATES[6][1] + " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("Apache-2.0", TEMPLATES[4][1] + " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                   "governing permissions and limitations under the License."),
]
# Words taken first as keys; then the longest ones.
_RARE = ["mit", "apache", "gnu", "cc", "mozilla", "attribution", "noncommercial", "sharealike", "sublicense", "noninfringement", "merchantability",
         "unencumbered", "redistribute", "redistribution", "redistributions", "licensed", "license", "licenses", "lesser", "copyright", "software"]


def template_pairs(text: str) -> list[str]:
    w = re.sub(r"[\W_]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def bounds(pairs: int, t: float) -> tuple[int, int]:
    """Fewest and most pairs of a passage that can reach dice t with a template of ``pairs``."""
    return math.ceil(pairs * t / (2 - t) - 1e-9), math.floor(pairs * (2 - t) / t + 1e-9)


def _keys(templates, t: float) -> list[str]:
    """Words of which every span of dice t has one: without them more pairs of the template are missing than may be."""
    out = []
    for _, text in templates:
        pairs = [p.split() for p in template_pairs(text)]
        free = len(pairs) - bounds(len(pairs), t)[0]  # pairs that may be missing
        for word in sorted({w for p in pairs for w in p}, key=lambda w: (w not in out, _RARE.index(w) if w in _RARE else len(_RARE), -len(w), w)):
            if sum(1 for p in pairs if set(p) & set(out)) > free:
                break
            if word not in out:
                out.append(word)
    return out


def _has(text: Column, keys: list[str]) -> Column:
    return F.lower(text).rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(keys)})(?![\p{{L}}\p{{N}}])") if keys else F.lit(False)


def _pairs_of(w: Column) -> Column:
    n = F.greatest(F.size(w) - 1, F.lit(0))
    return F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def _dice(a: Column, b: Column) -> Column:
    """Dice of two arrays of distinct pairs."""
    return F.size(F.array_intersect(a, b)) * 2.0 / (F.size(a) + F.size(b))


def spans(docs: DataFrame, templates=TEMPLATES, bodies=BODIES, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of notices that are neither a line nor the whole text: passage is the negated number of the first word."""
    every = [(i, name, text, p) for i, (name, text) in enumerate([*templates, *bodies]) if (p := template_pairs(text))]
    lits = lambda p: F.array(*map(F.lit, p))
    if not every:
        return docs.limit(0).select("doc_id", F.lit(0).alias("passage"), F.lit(0).alias("template"), F.lit("").alias("license"), F.lit(0.0).alias("dice"))
    some = docs.where(F.col("text").isNotNull() & _has(F.col("text"), _keys([(n, x) for _, n, x, _ in every], threshold)))
    some = some.select("doc_id", F.transform(F.split("text", "\n"), normalised).alias("lines"))
    cut = lambda lines: F.filter(F.split(F.array_join(lines, " "), " "), lambda x: x != "")
    some = some.withColumn("whole", F.array_distinct(_pairs_of(cut(F.col("lines"))))) \
        .withColumn("hits", F.array_intersect("whole", lits(dict.fromkeys(x for *_, p in every for x in p))))
    met = []
    for i, name, text, p in every:
        enough = F.size(F.array_intersect("hits", lits(p))) >= bounds(len(p), threshold)[0]
        if i < len(templates):  # not what the whole text reports
            enough &= (F.size("lines") == 1) | (_dice(F.col("whole"), lits(p)) < threshold)
        words = len(re.sub(r"[\W_]+", " ", text).split()) - 1
        met.append(F.when(enough, F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), lits(p).alias("p"), F.lit(words).alias("len"))))
    some = some.select("doc_id", "lines", F.filter(F.array(*met), lambda m: m.isNotNull()).alias("met")).where(F.size("met") > 0)
    short = [lits(p) for i, _, _, p in every if i < len(templates)]

    def rest(line: Column) -> Column:
        own = F.array_distinct(_pairs_of(F.split(line, " ")))
        said = F.exists(F.array(*short), lambda p: _dice(own, p) >= threshold) if short else F.lit(False)
        return F.when(said, F.regexp_replace(line, "[^ ]+", "|")).otherwise(line)

    some = some.select("doc_id", "met", _pairs_of(cut(F.transform("lines", rest))).alias("all"))
    some = some.select("doc_id", "all", F.explode("met").alias("m")).select("doc_id", "all", "m.*")
    at = F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda k: F.array_contains(F.col("p"), F.get(F.col("all"), k)))
    some = some.withColumn("at", at)

    def best(k: Column) -> Column:
        runs = [F.array_distinct(F.slice("all", k + 1, n.cast("int"))) for n in (F.ceil(F.col("len") * 0.8), F.col("len"), F.floor(F.col("len") * 1.25))]
        return F.struct(k.alias("s"), F.greatest(*(_dice(x, F.col("p")) for x in runs)).alias("dice"))

    some = some.withColumn("found", F.filter(F.transform("at", best), lambda x: x["dice"] >= threshold)).where(F.size("found") > 0)

    def top(x: Column, i: Column) -> Column:
        near = F.slice("found", F.greatest(i + 1 - F.col("len"), F.lit(1)), F.col("len") * 2)
        return ~F.exists(near, lambda y: (F.abs(y["s"] - x["s"]) < F.col("len")) & ((y["dice"] > x["dice"]) | ((y["dice"] == x["dice"]) & (y["s"] < x["s"]))))

    return some.select("doc_id", "template", "license", F.explode(F.filter("found", top)).alias("x")) \
        .select("doc_id", (-1 - F.col("x.s")).alias("passage"), "template", "license", "x.dice")


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, passage (line number from 1, 0: the whole text), template (its number), license, dice."""
    known = [(i, name, p) for i, (name, text) in enumerate(templates) if (p := template_pairs(text))]
    reach = [bounds(len(p), threshold) for _, _, p in known]
    low, high = min((a for a, _ in reach), default=1), max((b for _, b in reach), default=0)
    lines = F.split("text", "\n")
    passages = F.when(F.size(lines) > 1, F.concat(F.array("text"), lines)).otherwise(F.concat(F.array(F.lit("").cast("string")), lines))
    # without one of these words no passage reaches the threshold: asked of the text first, then of each passage
    keys = _keys([(name, text) for name, text in templates if template_pairs(text)], threshold)
    words = docs.where(F.col("text").isNotNull() & _has(F.col("text"), keys)).select("doc_id", F.posexplode(passages).alias("passage", "p")) \
        .where(_has(F.col("p"), keys)).select("doc_id", "passage", F.split(normalised(F.col("p")), " ").alias("w")).where(F.size("w") > low)
    pairs = F.array_distinct(F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat(a, F.lit(" "), b)))
    sized = words.select("doc_id", "passage", pairs.alias("pairs")).where(F.size("pairs").between(low, high))
    n = F.size("pairs")
    found = [F.when(n.between(a, b), F.struct(
        F.lit(i).alias("template"), F.lit(name).alias("license"),
        (F.size(F.array_intersect("pairs", F.array(*map(F.lit, p)))) * 2.0 / (n + len(p))).alias("dice")))
        for (i, name, p), (a, b) in zip(known, reach)]
    if not found:
        return sized.limit(0).select("doc_id", "passage", F.lit(0).alias("template"), F.lit("").alias("license"), F.lit(0.0).alias("dice"))
    return sized.select("doc_id", "passage", F.explode(F.filter(F.array(*found), lambda m: m["dice"] >= threshold)).alias("m")) \
        .select("doc_id", F.col("passage").alias("passage"), "m.template", "m.license", "m.dice")


def op5_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op5_license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5_license_dice and the span rows, which its SQL doesn't define."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs).unionByName(spans(docs))


def _sql() -> str:
    quoted = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))
    words = r"string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t(template, license, txt) AS (VALUES {quoted}),
tw AS (SELECT template, license, {words.format('txt')} AS w FROM t),
tp AS (SELECT template, license, {pairs} AS tpairs FROM tw),
d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, i AS passage, lines[i] AS p FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
      UNION ALL SELECT doc_id, 0, text FROM d WHERE len(lines) > 1),
w AS (SELECT doc_id, passage, {words.format('p')} AS w FROM p),
b AS (SELECT doc_id, passage, {pairs} AS pairs FROM w WHERE len(w) > 1),
m AS (SELECT doc_id, passage, template, license,
             len(list_intersect(pairs, tpairs)) * 2.0::DOUBLE / (len(pairs) + len(tpairs)) AS dice
      FROM b JOIN tp ON len(pairs) >= len(tpairs) * {THRESHOLD / (2 - THRESHOLD)} - 1e-9 AND len(pairs) <= len(tpairs) * {(2 - THRESHOLD) / THRESHOLD} + 1e-9)
SELECT doc_id, CAST(passage AS INTEGER) AS passage, template, license, dice FROM m WHERE dice >= {THRESHOLD}
"""


OP5_SQL = _sql()
