"""Licence notices in text, by the Dice coefficient over word bigrams.

A text is cut into segments (lines by default), and a segment is normalised: A-Z in
lower case, everything but letters and digits a space. Its distinct word bigrams are
compared with those of the licence templates. 2 * common / (a + b) reaches the
threshold t only if the sizes a and b are within a factor of (2 - t) / t; templates of
other sizes are not looked at, and a segment with too few words for any of them is
passed by before its bigrams are made.

Besides lines, windows of words over the whole text are compared with the notices and
with ``PASSAGES``, whole licence texts and the headers by which files state a licence.
A window begins and ends with a bigram of its template and has as many bigrams as the
size bounds allow; a text with too few bigrams of every template is passed by before
windows are made. Of overlapping windows the one with the most common bigrams times
``dice`` counts, and a window of a notice that touches a line found by itself does not.
Its segment is that of its first word.

Everything is a DataFrame expression over one row: no shuffle, no Python. A null or
empty text has no notices; repeated rows and null ids are scanned each; other columns
are ignored. A segment of one word has that word as its bigram.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.pinning import pin
from pressmill.llm.common import documents

#: Short notices by which texts state their licence.
NOTICES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Reserved", "All rights reserved."),
)
_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. """
_GNU = """This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}
General Public License as published by the Free Software Foundation; either version {version} of the License, or (at
your option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}
General Public License for more details."""
#: Whole licences; for longer ones the header that files carry or the first paragraph.
PASSAGES: tuple[tuple[str, str], ...] = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
    ("BSD-2-Clause", _BSD + _WARRANTY),
    ("BSD-3-Clause", _BSD + """3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission. """ + _WARRANTY),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""),
    ("GPL-2.0", _GNU.format(what="program", name="", version="2")),
    ("GPL-3.0", _GNU.format(what="program", name="", version="3")),
    ("LGPL-2.1", _GNU.format(what="library", name="Lesser", version="2.1")),
    ("LGPL-3.0", _GNU.format(what="library", name="Lesser", version="3")),
    ("AGPL-3.0", _GNU.format(what="program", name="Affero", version="3")),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public
License 2.0 which is available at"""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
)
THRESHOLD_PERCENT = 80


def normal_words(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.sub(r"[\W_]+", " ", lowered).split()


def bigrams(words: Sequence[str]) -> list[str]:
    """Distinct ones; a single word stands for itself."""
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])] or list(words)
    return sorted(set(pairs))


def size_bounds(size: int, percent: int) -> tuple[int, int]:
    """Least and largest number of bigrams with which ``size`` others can reach the threshold."""
    return -(-size * percent // (200 - percent)), size * (200 - percent) // percent


def _words(segment: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    spaced = F.trim(F.regexp_replace(F.translate(segment, upper, lower), r"[^\p{L}\p{N}]+", " "))
    return F.split(spaced, " ")


def _grams(words: Column) -> Column:
    return F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
                      F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def _best(grams: Column, sets: Sequence[tuple[str, list[str]]], percent: int) -> Column:
    """Templates like a set of bigrams, as an array of ``dice, licence``, the most alike first."""
    size, found = F.size(grams), []
    for name, own in sets:
        low, high = size_bounds(len(own), percent)
        common = F.size(F.array_intersect(grams, F.array(*map(F.lit, own))))
        found.append(F.when(size.between(low, high) & (200 * common >= percent * (size + len(own))), F.struct(
            (2 * common / (size + len(own))).alias("dice"), F.lit(name).alias("licence"))))
    return F.array_sort(F.filter(F.array(*found), lambda x: x.isNotNull()), lambda a, b: (
        F.when(a["dice"] != b["dice"], F.when(a["dice"] > b["dice"], -1).otherwise(1))
        .otherwise(F.when(a["licence"] < b["licence"], -1).otherwise(1))))


def _constant(sets: Sequence[tuple[str, list[str]]], short: bool, percent: int) -> list[dict]:
    return [{"name": name, "own": own, "low": size_bounds(len(own), percent)[0],
             "high": size_bounds(len(own), percent)[1], "short": short} for name, own in sets]


def _windows(rows: DataFrame, sets: Sequence[tuple[str, list[str]]], whole: Sequence[tuple[str, list[str]]],
             percent: int) -> DataFrame:
    """The rows of ``scan`` for runs of words in ``doc_id, lines``, other than lines by themselves."""
    given = _constant(sets, True, percent) + _constant(whole, False, percent)
    # one literal each, however many templates there are
    templates = F.from_json(F.lit(json.dumps(given)),
                            "array<struct<name: string, own: array<string>, low: int, high: int, short: boolean>>")
    every = F.from_json(F.lit(json.dumps(sorted({g for t in given for g in t["own"]}))), "array<string>")

    def alike(grams: Column, own: Column) -> tuple[Column, Column]:
        common, size = F.size(F.array_intersect(grams, own)), F.size(F.array_distinct(grams)) + F.size(own)
        return common, size

    rows = pin(rows, parts=F.transform("lines", lambda x: F.filter(_words(x), lambda w: w != ""))).drop("lines")
    rows = pin(rows, grams=_grams(F.flatten("parts")))
    rows = pin(rows, seen=F.array_intersect("grams", every)).where(F.size("seen") >= min(t["low"] for t in given))
    rows = pin(rows, near=F.filter(templates, lambda t: F.size(F.array_intersect(F.col("seen"), t["own"])) >= t["low"]))
    rows = rows.where(F.size("near") > 0)
    rows = pin(rows, line_of=F.flatten(F.transform("parts", lambda x, k: F.transform(x, lambda _: k))),
               by_line=F.transform("parts", lambda x: F.when(F.size(x) > 1, _grams(x)).otherwise(x)))

    def by_itself(grams: Column) -> Column:
        def like(t: Column) -> Column:
            common, size = alike(grams, t["own"])
            return t["short"] & (200 * common >= percent * size)
        return F.exists("near", like)

    rows = pin(rows, matched=F.filter(F.transform("by_line", lambda g, k: F.when(by_itself(g), k)),
                                      lambda k: k.isNotNull()))

    def of(t: Column) -> Column:
        at = F.filter(F.transform("grams", lambda g, i: F.when(F.array_contains(t["own"], g), i)),
                      lambda i: i.isNotNull())

        def ends(at: Column, start: Column) -> Column:
            return F.transform(
                F.filter(at, lambda end: end.between(start + (t["low"] - 1), start + (t["high"] - 1))),
                lambda end: weighed(start, end))

        def weighed(start: Column, end: Column) -> Column:
            common, size = alike(F.slice(F.col("grams"), start + 1, end - start + 1), t["own"])
            dice = 2 * common / size
            return F.struct(
                (common * dice).alias("weight"), t["name"].alias("licence"), start.alias("start"),
                end.alias("end"), dice.alias("dice"), (200 * common >= percent * size).alias("enough"))

        def free(x: Column) -> Column:
            first, last = F.get("line_of", x["start"]), F.get("line_of", x["end"] + 1)
            return x["enough"] & ~(t["short"] & F.exists("matched", lambda k: k.between(first, last)))

        # the array of one array gives the positions a name, so that they are found once
        windows = F.flatten(F.transform(F.array(at), lambda at: F.flatten(
            F.transform(at, lambda start: ends(at, start)))))
        return F.filter(windows, free)

    rows = pin(rows, found=F.flatten(F.transform("near", of)))
    ordered = F.array_sort("found", lambda a, b: (
        F.when(a["weight"] != b["weight"], F.when(a["weight"] > b["weight"], -1).otherwise(1))
        .when(a["licence"] != b["licence"], F.when(a["licence"] < b["licence"], -1).otherwise(1))
        .when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["end"] - b["end"])))
    chosen = F.aggregate(ordered, F.filter("found", lambda _: F.lit(False)), lambda got, x: F.when(
        F.exists(got, lambda y: (x["start"] <= y["end"] + 1) & (y["start"] <= x["end"] + 1)), got)
        .otherwise(F.concat(got, F.array(x))))
    rows = pin(rows, chosen=chosen).select("doc_id", "line_of", F.explode("chosen").alias("x"))
    return rows.select("doc_id", F.get("line_of", F.col("x.start")).cast("bigint").alias("segment"),
                       "x.licence", "x.dice")


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = NOTICES,
         percent: int = THRESHOLD_PERCENT, separator: str = r"\n", id_col: str = "doc_id",
         text_col: str = "text", passages: Sequence[tuple[str, str]] = PASSAGES) -> DataFrame:
    """``doc_id, segment, licence, dice``: segments (from 0) and windows of words that are like a template.

    ``dice`` is at least ``percent`` / 100; of several templates the most alike is given,
    of equally alike ones the first by name.
    """
    sets, whole = ([(name, grams) for name, text in given if (grams := bigrams(normal_words(text)))]
                   for given in (templates, passages))
    lines = documents(docs, id_col, text_col).where("text is not null") \
        .select("doc_id", F.split("text", separator).alias("lines"))
    if not sets and not whole:
        return lines.select("doc_id", F.lit(0).cast("bigint").alias("segment"),
                            F.lit("").alias("licence"), F.lit(0.0).alias("dice")).where("false")
    windows = _windows(lines, sets, whole, percent)
    if not sets:
        return windows
    rows = lines.select("doc_id", F.posexplode("lines").alias("segment", "line"))
    least = min(size_bounds(len(grams), percent)[0] for _, grams in sets)
    rows = pin(rows.select("doc_id", "segment", "line"), words=_words(F.col("line"))).drop("line")
    rows = rows.where(F.size("words") >= least)  # as many words as bigrams, or one more
    grams = F.array_distinct(F.when(F.size("words") > 1, _grams(F.col("words")))
                             .otherwise(F.filter("words", lambda w: w != "")))
    rows = pin(rows, grams=grams).drop("words")
    near = F.size("grams").between(min(size_bounds(len(g), percent)[0] for _, g in sets),
                                   max(size_bounds(len(g), percent)[1] for _, g in sets))
    rows = pin(rows.where(near), best=_best(F.col("grams"), sets, percent)).where(F.size("best") > 0)
    return rows.select("doc_id", F.col("segment").cast("bigint").alias("segment"),
                       F.col("best")[0]["licence"].alias("licence"), F.col("best")[0]["dice"].alias("dice")) \
        .unionByName(windows)


def scan_sql(templates: Sequence[tuple[str, str]] = NOTICES, percent: int = THRESHOLD_PERCENT) -> str:
    """The lines of the same for DuckDB, by joining every line with every template."""
    values = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in bigrams(normal_words(text))))
                       for name, text in templates)
    return rf"""
with templates(licence, own) as (values {values}),
lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         unnest(range(len(string_split(text, chr(10))))) as segment
  from documents where text is not null),
words as (
  select doc_id, segment, list_filter(string_split(trim(regexp_replace(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '), lambda x: x <> '') as w
  from lines),
grams as (
  select doc_id, segment, list_distinct(case when len(w) > 1
           then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end) as g
  from words),
matched as (
  select doc_id, segment, licence, 2 * len(list_intersect(g, own)) / (len(g) + len(own))::double as dice,
         row_number() over (partition by doc_id, segment order by
           2 * len(list_intersect(g, own)) / (len(g) + len(own))::double desc, licence) as place
  from grams, templates
  where 200 * len(list_intersect(g, own)) >= {percent} * (len(g) + len(own)))
select doc_id, segment::bigint as segment, licence, dice from matched where place = 1"""
