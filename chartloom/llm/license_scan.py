r"""Licence scans: normalised text against licence templates, by Dice coefficient over word bigrams.

Text is normalised to small letters with one space between words (runs of
letters and digits). A text is compared as a whole, by paragraphs (parted by
blank lines), by lines, and by windows: wherever one of a template's anchors (its
longest words, three at most) stands, as many words as the template has, placed
so that the anchor is where the template has it. So a notice within a line, over
several lines or paragraphs, or inside other prose is found, too, if one of its
anchors is left.
Dice is 2 |A n B| / (|A| + |B|) over the sets of bigrams. As it cannot exceed
2 min(|A|, |B|) / (|A| + |B|), a template whose number of bigrams lies outside
[t / (2 - t), (2 - t) / t] times the part's is never compared.

Everything is one projection of built-in functions: no Python on the executors,
no join and no shuffle. The templates (a fixed list, or one given) are a
constant of the plan.

Edge cases: a null or empty text has no match; a text or template of one word
has that word as its only gram. Equal matches of one text (licence, Dice, part)
count once. A window that would begin before the text begins with it. If several
templates tie, all are listed. Very long texts are scanned whole. Other columns
are kept; ``licenses`` is added (an input column of that name is replaced).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Notices and short licence texts, by SPDX identifier where there is one.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "All rights reserved."),
)


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def anchors(templates) -> list[tuple[str, int, int, int]]:
    """(word, template, offset, words of the template): the longest words of each template, fewer for short ones."""
    out = []
    for t, (_, text) in enumerate(templates):
        words = words_of(text)
        most = 1 if len(words) < 6 else 2 if len(words) < 11 else 3
        for w in sorted(dict.fromkeys(words), key=lambda w: (-len(w), words.index(w)))[:most]:
            out.append((w, t, words.index(w), len(words)))
    return out


def grams_of(text: str) -> list[str]:
    """Distinct bigrams of a normalised template, in order."""
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))) if len(words) > 1 else words


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _grams(part: Column) -> Column:
    """Distinct bigrams of a normalised part (words with one space between)."""
    return _let(F.split(part, " "), _grams_of)


def _grams_of(w: Column) -> Column:
    pairs = F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))
    return F.when(F.size(w) < 2, w).otherwise(F.array_distinct(pairs))


def matches(text: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Array of (license, dice, part): every part of a text that is close to a template; windows come last, by place in the text."""
    table = [(name, grams_of(t)) for name, t in templates]
    known = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(len(g)).alias("n"), F.array(*map(F.lit, g)).alias("grams")) for n, g in table])
    lowest = min(len(g) for _, g in table) * threshold / (2 - threshold)
    highest = max(len(g) for _, g in table) * (2 - threshold) / threshold
    clean = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")
    words = lambda x: F.btrim(F.regexp_replace(x, r"[ \n]+", " "))
    # A part of n words has n - 1 bigrams at most, so shorter ones are out before any is made.
    enough = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) >= F.lit(int(lowest) if lowest >= 1 else 0)

    def parts_of(text: Column, whole: Column) -> Column:
        blank = F.when(text.rlike(r"\n *\n"), F.transform(F.split(text, r"\n *\n(?: *\n)*"), words)).otherwise(F.array().cast("array<string>"))
        lines = F.transform(F.split(text, "\n"), lambda x: F.btrim(x))
        return F.filter(F.array_distinct(F.concat(F.array(whole), blank, lines)), lambda x: (x != "") & enough(x))

    def close(part: Column) -> Column:
        def against(g: Column) -> Column:
            size = F.size(g)
            fit = F.filter(known, lambda t: (t["n"] * (threshold / (2 - threshold)) <= size) & (size <= t["n"] * ((2 - threshold) / threshold)))
            scored = F.transform(
                fit, lambda t: F.struct(t["name"].alias("license"), (F.lit(2.0) * F.size(F.array_intersect(g, t["grams"])) / (size + t["n"])).alias("dice"), part.alias("part"))
            )
            return F.when(size > highest, F.filter(scored, lambda s: F.lit(False))).otherwise(F.filter(scored, lambda s: s["dice"] >= threshold))

        return _let(_grams(part), against)

    held = anchors(templates)
    spots = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(t).alias("t"), F.lit(o).alias("offset"), F.lit(n).alias("n")) for w, t, o, n in held])
    names = sorted({w for w, *_ in held})

    def placed(w: Column) -> Column:
        """Matches of windows of the words w."""
        seen = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("word"), i.alias("i"))), lambda x: x["word"].isin(names))
        start = lambda x, a: F.struct(a["t"].alias("t"), F.greatest(x["i"] - a["offset"], F.lit(0)).alias("start"), a["n"].alias("n"))
        windows = F.array_distinct(F.flatten(F.transform(seen, lambda x: F.transform(F.filter(spots, lambda a: a["word"] == x["word"]), lambda a: start(x, a)))))

        def score(x: Column) -> Column:
            part = F.slice(w, x["start"] + 1, x["n"])
            t = F.get(known, x["t"])
            return _let(_grams_of(part), lambda g: F.struct(t["name"].alias("license"), (F.lit(2.0) * F.size(F.array_intersect(g, t["grams"])) / (F.size(g) + t["n"])).alias("dice"), F.array_join(part, " ").alias("part")))

        found = F.filter(F.transform(windows, score), lambda s: s["dice"] >= threshold)
        none = F.array().cast("array<struct<license:string,dice:double,part:string>>")
        return F.when(F.arrays_overlap(w, F.array(*map(F.lit, names))), found).otherwise(none)

    def of(text: Column) -> Column:
        both = lambda whole: F.concat(F.flatten(F.transform(parts_of(text, whole), close)), _let(F.split(whole, " "), placed))
        return F.array_distinct(_let(words(text), both))

    return _let(clean, of)


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """docs with ``licenses``: array of (license, dice, part)."""
    return docs.withColumn("licenses", matches(F.col(text), templates, threshold))


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda m: m["license"])))
    return found.select(
        "doc_id",
        F.array_join(names, ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_matches"),
        F.round(F.coalesce(F.array_max(F.transform("licenses", lambda m: m["dice"])), F.lit(0.0)), 9).alias("best_dice"),
    )


def oracle() -> str:
    """The same result as relational SQL: parts, bigrams and templates are joined and counted."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(n)}, {quote(g)})" for i, (n, t) in enumerate(TEMPLATES) for g in grams_of(t))
    spots = ", ".join(f"({quote(w)}, {t}, {o}, {n})" for w, t, o, n in anchors(TEMPLATES))
    return rf"""
WITH template(t, license, gram) AS (VALUES {values}),
anchor(word, t, shift, words) AS (VALUES {spots}),
sizes AS (SELECT t, license, count(*) AS tn FROM template GROUP BY t, license),
clean AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS c FROM documents),
pieces AS (
  SELECT doc_id, c AS p FROM clean
  UNION ALL SELECT doc_id, unnest(string_split_regex(c, '\n *\n( *\n)*')) FROM clean WHERE regexp_matches(c, '\n *\n')
  UNION ALL SELECT doc_id, unnest(string_split(c, chr(10))) FROM clean),
part AS (SELECT DISTINCT doc_id, trim(regexp_replace(p, '[ \n]+', ' ', 'g')) AS p, -1 AS of_t FROM pieces),
text_words AS (SELECT doc_id, string_split(trim(regexp_replace(c, '[ \n]+', ' ', 'g')), ' ') AS w FROM clean),
spot AS (SELECT doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS i FROM text_words),
win AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, greatest(i - shift, 0) + 1, greatest(i - shift, 0) + words), ' ') AS p, t FROM spot JOIN anchor USING (word)),
every AS (SELECT doc_id, p, of_t FROM part WHERE p <> '' UNION ALL SELECT doc_id, p, t FROM win),
words AS (SELECT doc_id, p, of_t, string_split(p, ' ') AS w FROM every),
grams AS (
  SELECT DISTINCT doc_id, p, of_t, CASE WHEN len(w) < 2 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS gram
  FROM (SELECT doc_id, p, of_t, w, unnest(range(1, greatest(len(w), 2))) AS i FROM words)),
size AS (SELECT doc_id, p, of_t, count(*) AS n FROM grams GROUP BY doc_id, p, of_t),
shared AS (SELECT g.doc_id, g.p, g.of_t, m.t, count(*) AS k FROM grams g JOIN template m USING (gram) WHERE g.of_t IN (-1, m.t) GROUP BY g.doc_id, g.p, g.of_t, m.t),
scored AS (SELECT DISTINCT s.doc_id, z.license, 2.0::DOUBLE * k / (n + tn) AS dice, p FROM shared s JOIN size USING (doc_id, p, of_t) JOIN sizes z USING (t)),
hits AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) AS n_matches, max(dice) AS best FROM scored WHERE dice >= {THRESHOLD}::DOUBLE GROUP BY doc_id)
SELECT d.doc_id, coalesce(h.licenses, '') AS licenses, coalesce(h.n_matches, 0)::BIGINT AS n_matches, round(coalesce(h.best, 0.0)::DOUBLE, 9) AS best_dice
FROM documents d LEFT JOIN hits h USING (doc_id)"""
