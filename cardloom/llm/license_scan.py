"""License scans (operator 2): normalised text compared to licence templates by the Dice coefficient over word bigrams.

A text's units are its lines and its paragraphs (runs of lines that hold a letter or digit, so that the empty lines of a comment block
part paragraphs too).  A unit or template is the sequence of its
lower-cased runs of letters and digits, and its bigrams are those of neighbouring words, with repetition.  Dice of a and b
bigrams is 2 * common / (a + b), so at threshold t only templates with between a * t / (2 - t) and a * (2 - t) / t bigrams can reach it:
these bounds first drop the units that fit no template, by a count of words, and then the templates that a unit doesn't fit.  What is
left must share so many bigrams that, whichever they are, they hold an anchor word of the template; texts and units without any
anchor are dropped first.

Everything is DataFrame expressions.  There is no join and no shuffle: templates are literals of the plan.  Bigrams are compared by 64-bit hashes.

Defined results.  Null, empty and wordless texts: no rows.  A unit gets one row for its best template, the first in the list of ties; a
paragraph of one line is reported as that line only.  Repeated rows are scanned each.  Empty table: no rows.  Further columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Licence, and the text of a notice or of one paragraph of the licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Common words.
COMMON = frozenset("a and any as at be by for from in is it not of on or that the this to under whom with".split())

_WORDS = r"[\p{L}\p{N}]+"


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bounds(bigrams: int, threshold: float) -> tuple[int, int]:
    """The least and most bigrams of a unit that can reach the threshold with a template."""
    return math.ceil(round(bigrams * threshold / (2 - threshold), 9)), math.floor(round(bigrams * (2 - threshold) / threshold, 9))


def anchors(words: list[str], threshold: float) -> set[str]:
    """Words one of which any unit has that reaches the threshold: such a unit shares at least bounds()[0] of the template's
    bigrams, so it shares one of any set of more than the rest.  Longest words first, as these are rare elsewhere, and common ones last."""
    pairs = list(zip(words, words[1:]))
    spare = len(pairs) - max(1, bounds(len(pairs), threshold)[0])
    chosen: set[str] = set()
    for word in sorted(set(words), key=lambda w: (w in COMMON, -len(w), w)):
        if sum(a in chosen or b in chosen for a, b in pairs) > spare:
            break
        chosen.add(word)
    return chosen


def _units(docs: DataFrame, anchored: str) -> DataFrame:
    """doc_id, kind, number (from 0) and text of the lines and paragraphs of texts that have an anchor."""
    rows = docs.filter(F.lower("text").rlike(anchored)).select("doc_id", "text")
    lines = rows.select("doc_id", F.lit("line").alias("kind"), F.posexplode(F.split("text", "\n", -1)).alias("number", "unit"))
    parts = rows.select("doc_id", F.lit("paragraph").alias("kind"), F.posexplode(F.split("text", r"\n(?:[^\p{L}\p{N}\n]*\n)+", -1)).alias("number", "unit"))
    return lines.unionByName(parts.filter(F.btrim("unit", F.lit("\n")).contains("\n")))


def _table(docs: DataFrame, templates: list[tuple[str, str]], threshold: float) -> list[dict]:
    """Name, bigrams, bounds and {bigram hash: times} of each template; hashes are the engine's own."""
    words = [template_words(text) for _, text in templates]
    pairs = sorted({x for w in words for x in zip(w, w[1:])})
    hashed = docs.sparkSession.createDataFrame(pairs, "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()  # a fixed, short table
    code = {(r["a"], r["b"]): r["h"] for r in hashed}
    out = []
    for (name, _), w in zip(templates, words):
        low, high = bounds(len(w) - 1, threshold)
        out.append({"name": name, "size": len(w) - 1, "low": low, "high": high, "held": Counter(code[x] for x in zip(w, w[1:]))})
    return out


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, kind, number, license, template (its place in the list), n_bigrams, common and dice of every unit that matches."""
    table = _table(docs, templates, threshold)
    found = sorted({w for _, text in templates for w in anchors(template_words(text), threshold)})
    anchored = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(map(re.escape, found))})(?![\p{{L}}\p{{N}}])"
    n_words = F.regexp_count("unit", F.lit(_WORDS)).cast("long")
    units = _units(docs, anchored).filter(F.lower("unit").rlike(anchored)).withColumn("n_bigrams", n_words - 1).filter(F.col("n_bigrams").between(min(t["low"] for t in table), max(t["high"] for t in table)))
    words = F.regexp_extract_all(F.lower("unit"), F.lit(_WORDS), F.lit(0))
    pairs: Column = F.transform(F.array(words), lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1))))[0]
    near = units.select("doc_id", "kind", "number", "n_bigrams", pairs.alias("pairs"))

    kind = "array<struct<place:int,name:string,size:int,low:int,high:int,held:array<struct<h:bigint,k:bigint>>>>"
    rows = [{**t, "place": n, "held": [{"h": h, "k": k} for h, k in sorted(t["held"].items())]} for n, t in enumerate(table)]
    known = F.from_json(F.lit(json.dumps(rows)), kind)  # a constant of the plan

    def scored(t: Column) -> Column:
        """dice, place, common and name of one template."""
        common = F.aggregate(t["held"], F.lit(0).cast("long"), lambda acc, e: acc + F.least(e["k"], F.size(F.filter("pairs", lambda x: x == e["h"])).cast("long")))
        return F.transform(F.array(common), lambda c: F.struct((2.0 * c / (F.col("n_bigrams") + t["size"])).alias("dice"), (-t["place"]).alias("place"), c.alias("common"), t["name"].alias("name")))[0]

    fitting = F.filter(known, lambda t: F.col("n_bigrams").between(t["low"], t["high"]))
    best = near.withColumn("best", F.array_max(F.transform(fitting, scored))).filter(F.col("best.dice") >= threshold - 1e-9)
    return best.select("doc_id", "kind", "number", F.col("best.name").alias("license"), (-F.col("best.place")).alias("template"), "n_bigrams", F.col("best.common").alias("common"), F.col("best.dice").alias("dice"))
