"""Licence scan: headers and licence files against templates, and inheritance from directories.

Segments of a text are compared with licence templates by the cosine of sparse TF-IDF vectors of their
lower-cased words. Headers are looked for in the whole text, as notices stand at the end of files too: segments are
all its lines, each by itself, and its paragraphs; a licence file (LICENSE, COPYING, NOTICE, UNLICENSE with any ending) is one segment as a
whole too. Document frequencies are counted over the segments of all files; words of no
template count as unseen. A file's licence is that of its best template from a cosine of ``THRESHOLD`` on;
wordings that licences share count for less (``SHARED``).

Most segments are never scored. A segment can reach the threshold against a template only if it shares one
of the template's heaviest words: those without which the rest weighs less than the threshold. Segments with none
of these words are passed over, which loses nothing.

A file without a licence of its own inherits that of the nearest directory, its own or above, that holds a licence
file with one. This is a join of the distinct directories' ancestors with those directories.

Only DataFrame functions are used; templates and their words (some hundred) are what is sent to all tasks.

Defined cases: null and empty texts have no licence of their own; null paths inherit nothing. Equal cosines go to the
first name. Repeated rows are judged alike and each comes out. Among licence files of one directory the highest cosine
counts.
"""

from __future__ import annotations

import re
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6


def _gnu(work: str, name: str, version: str, sign: str = ";") -> str:
    """The standard header of the GNU licences."""
    return (
        f"This {work} is free software{sign} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
        f"Free Software Foundation{';' if sign == ';' else ','} either version {version} of the License, or (at your option) any later version."
    )


_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_APACHE = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_1_2 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."

# Standard headers, and the file text of the short licences.
STANDARD = [
    ("GPL-2.0", _gnu("program", "General Public License", "2")),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-2.0", _gnu("library", "Library General Public License", "2")),
    ("LGPL-2.1", _gnu("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0", _gnu("program", "Lesser General Public License", "3", ":")),
    ("AGPL-3.0", _gnu("program", "Affero General Public License", "3", ":")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", _APACHE),
    ("MIT", _MIT),
    ("ISC", _ISC),
    ("BSD-2-Clause", f"{_BSD}: {_BSD_1_2} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD}: {_BSD_1_2} {_BSD_3} {_BSD_END}"),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-2-Clause", _BSD_END),
]

# Wordings that BSD-2-Clause and BSD-3-Clause share, and the factor of their cosines: the whole text and the third
# clause tell the two apart; the end stands without that clause in BSD-2-Clause, the opening alone says the least.
SHARED = {_BSD: 0.85, _BSD_END: 0.88}

# The wording of public licence notices.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal public domain dedication."),
    ("Proprietary", "All rights reserved."),
]

_LICENCE_FILE = r"(?i)(^|/)(LICEN[CS]E|COPYING|NOTICE|UNLICENSE)([.-][^/]*)?$"


def templates() -> list[tuple[str, str]]:
    """Names and wordings; each name has a line with its identifier too."""
    names = dict.fromkeys(name for name, _ in NOTICES + STANDARD if name != "Proprietary")
    return NOTICES + STANDARD + [(name, f"SPDX-License-Identifier: {name}") for name in names]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _frequencies(words: list[str]) -> dict[str, float]:
    return {w: 1 + log(words.count(w)) for w in set(words)}


def _template_words() -> list[dict[str, float]]:
    return [_frequencies(re.findall("[a-z0-9]+", text.lower())) for _, text in templates()]


def segments(files: DataFrame) -> DataFrame:
    """file (columns key, path), segment, words: all words of each segment with any."""
    lines, paragraphs = F.split("text", "\n", -1), F.split("text", r"\n[\x20\t\r]*\n", -1)
    whole = F.when(F.col("path").rlike(_LICENCE_FILE), F.array("text")).otherwise(F.array().cast("array<string>"))
    rows = files.where("text IS NOT NULL").select("key", F.posexplode_outer(F.concat(lines, paragraphs, whole)))
    rows = rows.select("key", F.col("pos").alias("segment"), _words(F.col("col")).alias("words"))
    return rows.where(F.size("words") > 0)


def _weights(rows: DataFrame, tf: list[dict[str, float]]) -> tuple[dict[str, float], float]:
    """IDF of the templates' words, counted over all segments, and of any other word."""
    vocabulary = sorted(set().union(*tf))
    known = F.explode(F.concat(F.array(F.lit("")), F.array_intersect("words", F.array(*map(F.lit, vocabulary)))))
    # One row for each word of the templates; the empty word counts the segments.
    found = dict(rows.select(known.alias("word")).groupBy("word").count().collect())
    n = found.get("", 0) + len(tf)
    df = {w: found.get(w, 0) + sum(w in t for t in tf) for w in vocabulary}
    return {w: log((1 + n) / (1 + df[w])) + 1 for w in vocabulary}, log(1 + n) + 1


def _decisive(vectors: list[dict[str, float]], threshold: float) -> list[str]:
    """Words of which a segment must share one with some template to reach the threshold."""
    out = set()
    for vector in vectors:
        rest = sum(x * x for x in vector.values())
        least = rest * threshold * threshold
        for word, x in sorted(vector.items(), key=lambda e: (-e[1], e[0])):
            if rest < least * (1 - 1e-9):
                break
            out.add(word)
            rest -= x * x
    return sorted(out)


def best_licences(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """key, licence, score of the files (key, path, text) that match a template."""
    spark, tf = files.sparkSession, _template_words()
    rows = segments(files)
    idf, unseen = _weights(rows, tf)
    vectors = [{w: x * idf[w] for w, x in t.items()} for t in tf]
    norms = [sqrt(sum(x * x for x in v.values())) / SHARED.get(text, 1) for v, (_, text) in zip(vectors, templates())]
    near = rows.where(F.arrays_overlap("words", F.array(*map(F.lit, _decisive(vectors, threshold)))))
    terms = near.select("key", "segment", F.explode("words").alias("word")).groupBy("key", "segment", "word").count()
    terms = terms.withColumn("tf", 1 + F.log("count"))
    entries = [
        (w, idf[w], [(k, v[w] / norms[k]) for k, v in enumerate(vectors) if w in v]) for w in idf
    ]
    table = spark.createDataFrame(entries, "word string, idf double, shares array<struct<template: int, share: double>>")
    terms = terms.join(F.broadcast(table), "word", "left")  # some hundred words
    terms = terms.withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    length = terms.groupBy("key", "segment").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = terms.where("shares IS NOT NULL").select("key", "segment", "x", F.explode("shares").alias("s"))
    dots = dots.groupBy("key", "segment", "s.template").agg(F.sum(F.col("x") * F.col("s.share")).alias("dot"))
    score = F.round(F.col("dot") / F.col("length"), 6)
    scored = dots.join(length, ["key", "segment"]).select("key", "template", score.alias("score"))
    names = spark.createDataFrame([(k, name) for k, (name, _) in enumerate(templates())], "template int, licence string")
    scored = scored.where(F.col("score") >= threshold).join(F.broadcast(names), "template")
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("b"))
    return best.select("key", "b.licence", (-F.col("b.minus")).alias("score"))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """row (all columns as they came), licence, score, found: header, file, inherited or none, for each row.

    ``files`` has the columns path and text.
    """
    path, text = F.col("path").cast("string"), F.col("text").cast("string")
    key = F.struct(path.alias("path"), F.xxhash64(text).alias("hash"))
    keyed = files.select(key.alias("key"), path.alias("path"), text.alias("text"))
    own = best_licences(keyed, threshold).select(
        F.col("key.path").alias("o_path"), F.col("key.hash").alias("o_hash"), "licence", "score"
    )
    named = own.where(F.col("o_path").rlike(_LICENCE_FILE))
    holders = named.groupBy(_directory(F.col("o_path")).alias("holder")).agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("b")
    )
    directories = files.where(path.isNotNull()).select(_directory(path).alias("directory")).distinct()
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    above = directories.select("directory", F.posexplode(F.array_distinct(above)).alias("depth", "holder"))
    nearest = above.join(holders, "holder").groupBy("directory").agg(F.max(F.struct("depth", "b")).alias("n"))
    nearest = nearest.select("directory", "n.b.licence", (-F.col("n.b.minus")).alias("score"))
    rows = files.select(F.struct("*").alias("row"), key.alias("key"), _directory(path).alias("dir"))
    with_own = rows.join(
        own, F.col("key.path").eqNullSafe(F.col("o_path")) & (F.col("key.hash") == F.col("o_hash")), "left"
    ).select("row", "dir", F.col("key.path").alias("path"), F.struct("licence", "score").alias("own"))
    joined = with_own.join(
        nearest.select("directory", F.struct("licence", "score").alias("inherited")),
        F.col("dir") == F.col("directory"),
        "left",
    )
    has_own, is_file = F.col("own.licence").isNotNull(), F.col("path").rlike(_LICENCE_FILE)
    return joined.select(
        "row",
        F.coalesce("own.licence", "inherited.licence").alias("licence"),
        F.when(has_own, F.col("own.score")).otherwise(F.col("inherited.score")).alias("score"),
        F.when(has_own & F.coalesce(is_file, F.lit(False)), "file")
        .when(has_own, "header")
        .when(F.col("inherited.licence").isNotNull(), "inherited")
        .otherwise("none")
        .alias("found"),
    )
