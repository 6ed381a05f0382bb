"""Licence statements by the Dice coefficient of word bigrams against templates.

A text's units are its lines, its paragraphs (set off by blank lines) and the text as a whole. Units and templates are
normalised: lower-cased, everything but letters and digits counting as a blank. A unit states a
licence if ``2 * common / (own + template's)``, counted in distinct pairs of neighbouring words, is at
least ``DICE``. A common part can't exceed the smaller side, so only templates whose size lies between ``own * DICE / (2 - DICE)``
and its inverse are compared; most lines meet none and are done after counting their pairs.

All of it is one projection of built-in functions over constant templates: no join, no shuffle, and no
cost that depends on how often a licence stands in the corpus.

Null texts and texts without two words state nothing. Repeated rows are judged one by one. A unit
that meets several templates counts for the best, ties going to the first name.

A header of several paragraphs has a template for the paragraph that names the licence and one for all of them in one. Of full
texts of the GNU licences the paragraph is taken that only they hold; paragraphs that several licences share
(a warranty notice without a version) have no template. A statement that shares its line and paragraph with other words is
missed, as are the BSD-2-Clause conditions in paragraphs of their own inside a longer text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.text import table

DICE = 0.8

def _gnu(work: str, kind: str, version: str) -> tuple[str, str]:
    """The first paragraph of a GNU header, and its first two in one."""
    first = (f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published "
             f"by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
    return first, (f"{first} This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                   f"the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details.")


_GNU = [(name, text) for name, works, kind, version in (
    ("AGPL-3.0", ("program",), "Affero General Public License", "3"), ("GPL-2.0", ("program",), "General Public License", "2"),
    ("GPL-3.0", ("program",), "General Public License", "3"),
    ("LGPL-2.1", ("library", "program"), "Lesser General Public License", "2.1"),
    ("LGPL-3.0", ("library", "program"), "Lesser General Public License", "3"))
    for work in works for text in _gnu(work, kind, version)]
_BSD_2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
          "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
          "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
          "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission.")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
              "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
              "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
              "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
              "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
              "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
              "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

# Public notices of common licences, in short and in the words their authors recommend.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *_GNU,
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically "
                 "designed to ensure cooperation with the community in the case of network server software."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is released under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                   "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                   "for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-2-Clause", f"{_BSD_2} {_BSD_AS_IS}"),
    ("BSD-3-Clause", _BSD_NAMES),
    ("BSD-3-Clause", f"{_BSD_2} {_BSD_NAMES}"),
    ("BSD-3-Clause", f"{_BSD_2} {_BSD_NAMES} {_BSD_AS_IS}"),
    ("GPL-2.0", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU "
                "General Public License is intended to guarantee your freedom to share and change free software--to make sure the "
                "software is free for all its users. This General Public License applies to most of the Free Software Foundation's "
                "software and to any other program whose authors commit to using it. (Some other Free Software Foundation software "
                "is covered by the GNU Lesser General Public License instead.) You can apply it to your programs, too."),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This license, the Lesser General Public License, applies to some specially designated software packages--typically "
                 "libraries--of the Free Software Foundation and other authors who decide to use it. You can use it too, but we "
                 "suggest you first think carefully about whether this license or the ordinary General Public License is the better "
                 "strategy to use in any particular case, based on the explanations below."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU "
                 "General Public License, supplemented by the additional permissions listed below."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "This project is released under the MIT License."),
)


def normal_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _pairs(unit: Column) -> Column:
    """Distinct pairs of neighbouring words of a normalised unit."""
    words = F.filter(F.split(unit, " "), lambda w: w != "")
    return _let(words, lambda ws: F.when(F.size(ws) < 2, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(ws) - 2),
                                     lambda i: F.concat(F.get(ws, i), F.lit(" "), F.get(ws, i + 1))))))


def stated_licenses(docs: DataFrame, templates=TEMPLATES, dice: float = DICE) -> DataFrame:
    """``doc_id, n_units, n_stated, licenses, best_license, best_dice`` for every row of ``docs``.

    ``licenses`` are the distinct names in order, joined by commas.
    """
    known = [(name, bigrams(normal_words(text))) for name, text in templates]
    constant = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(pairs)).alias("n"),
                                  F.array(*map(F.lit, pairs)).alias("pairs")) for name, pairs in known])
    least, most = min(len(p) for _, p in known), max(len(p) for _, p in known)
    ratio = dice / (2 - dice)
    every = sorted({p for _, pairs in known for p in pairs})

    def best(pairs: Column) -> Column:
        size = F.size(pairs)
        near = F.filter(constant, lambda t: (t["n"] >= size * ratio) & (t["n"] * ratio <= size))
        judged = F.transform(near, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(pairs, t["pairs"])) / (size + t["n"])).alias("dice"), t["name"].alias("name")))
        # Greatest coefficient, then first name.
        order = F.array_sort(F.filter(judged, lambda t: t["dice"] >= dice), lambda x, y: F.when(x["dice"] > y["dice"], -1).when(
            x["dice"] < y["dice"], 1).when(x["name"] < y["name"], -1).when(x["name"] > y["name"], 1).otherwise(0))
        fits = (size >= least * ratio) & (size * ratio <= most)
        # The coefficient needs this share of a unit's own pairs in one template, and so in all of them.
        familiar = F.size(F.filter(pairs, lambda p: p.isin(every))) >= size * ratio - 1e-6
        return F.when(fits, F.when(familiar, F.get(order, F.lit(0))))

    plain = F.regexp_replace(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^a-z0-9\n]+", " ")
    lines = F.split("__plain", "\n")
    paragraphs = F.transform(F.split("__plain", r"\n *\n[ \n]*"), lambda p: F.replace(p, F.lit("\n"), F.lit(" ")))
    whole = F.array(F.replace("__plain", F.lit("\n"), F.lit(" ")))
    units = F.filter(F.array_distinct(F.transform(F.concat(lines, paragraphs, whole), lambda u: F.trim(u))), lambda u: u != "")
    found = F.filter(F.transform(F.transform("__units", _pairs), best), lambda b: b.isNotNull())
    out = docs.select("doc_id", "text").select("doc_id", plain.alias("__plain")).select("doc_id", units.alias("__units"))
    out = out.select("doc_id", F.size("__units").cast("long").alias("n_units"), found.alias("__found"))
    order = F.array_sort("__found", lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1).when(
        x["name"] < y["name"], -1).when(x["name"] > y["name"], 1).otherwise(0))
    return out.select(
        "doc_id", "n_units", F.size("__found").cast("long").alias("n_stated"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("__found", lambda b: b["name"])))).alias("licenses"),
        F.get(order, F.lit(0))["name"].alias("best_license"), F.get(order, F.lit(0))["dice"].alias("best_dice"))


def op6_licenses(spark, sf_dir: str) -> DataFrame:
    return stated_licenses(table(spark, sf_dir, "documents"))


def _sql() -> str:
    rows = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{p}'" for p in bigrams(normal_words(text))))
                     for name, text in TEMPLATES)
    return rf"""
WITH templates(name, tp) AS (VALUES {rows}),
p AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\n]+', ' ', 'g') AS x FROM documents),
u AS (SELECT doc_id, list_filter(list_distinct(list_transform(
        list_concat(string_split(x, chr(10)),
          list_transform(string_split_regex(x, '\n *\n[ \n]*'), lambda q: replace(q, chr(10), ' ')), [replace(x, chr(10), ' ')]),
        lambda y: trim(y))), lambda y: y <> '') AS units FROM p),
e AS (SELECT doc_id, i, string_split(unit, ' ') AS ws
      FROM (SELECT doc_id, unnest(units) AS unit, unnest(range(len(units))) AS i FROM u)),
b AS (SELECT doc_id, i, list_distinct(list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1])) AS ps
      FROM e WHERE len(ws) > 1),
d AS (SELECT doc_id, i, name, 2.0::DOUBLE * len(list_intersect(ps, tp)) / (len(ps) + len(tp)) AS dice
      FROM b JOIN templates ON len(tp) >= len(ps) * {DICE} / (2 - {DICE}) AND len(tp) * {DICE} / (2 - {DICE}) <= len(ps)),
f AS (SELECT doc_id, i, name, dice FROM d WHERE dice >= {DICE}
      QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY dice DESC, name) = 1),
g AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
             first(name ORDER BY dice DESC, name) AS best, max(dice) AS best_dice FROM f GROUP BY doc_id)
SELECT u.doc_id, CAST(len(units) AS BIGINT) AS n_units, CAST(coalesce(n, 0) AS BIGINT) AS n_stated,
       coalesce(licenses, '') AS licenses, best AS best_license, best_dice
FROM u LEFT JOIN g USING (doc_id)
"""


SQL = _sql()
