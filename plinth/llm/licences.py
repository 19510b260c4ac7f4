"""Operator 9: licence scans, with DataFrame functions only.

Texts are normalised (lower case, runs of anything but a-z and 0-9 become a space) and compared with licence templates by the Dice coefficient
over their distinct word bigrams, 2 c / (a + b). A coefficient of ``least`` needs min(a, b) / max(a, b) >= least / (2 - least) = q.

Notices (TEMPLATES) are looked for in a document's units: its lines, its paragraphs between blank lines, and the whole text. Notices outside the
bounds of a unit's size are never compared. A match also needs c >= q a of a unit's a bigrams to be of the template: units with fewer bigrams
of any notice are left before templates are met, and, as a word of no notice makes at least half a bigram of none, units with over 2 (1 - q) a
such distinct words before bigrams are made.

Bodies (BODIES) are looked for wherever they stand: in windows of a body's number of words, which begin at every STEPS-th part of it and at the
last place, over documents that mention a licence at all (KEYWORDS, one of which each body has) and have c >= q b of a body's b bigrams. An
exact copy is at most half a step from a window, so that its coefficient there is 1 - 1 / (2 STEPS) or more.

The best template of a unit or window counts, of equal ones the first by name.

Result: a row per document and licence found: doc_id, licence, n_units (distinct units and windows), best_dice. Null text: nothing is found. Rows
with equal doc_id count as one document. Very long texts are scanned whole. An empty table gives no rows. Columns other than doc_id and text are
not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import null_safe_text, table
from plinth.llm.licence_texts import BODIES

#: Fixed values: wordings of public licence notices.
TEMPLATES = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]
LEAST = 0.8
STEPS = 8
#: Documents in which bodies are looked for have one of these in lower case.
KEYWORDS = ["licen", "permission", "redistribut", "warrant", "copyright", "public domain"]
#: What rounding may take from a bound.
SLACK = 1e-6


def bigrams_of(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).strip().split(" ")
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def _sizes(least: float) -> tuple[int, int]:
    """The fewest and most bigrams a unit can have to match any template."""
    ratio = least / (2 - least)
    each = [len(bigrams_of(t)) for _, t in TEMPLATES]
    return max(1, int(min(each) * ratio)), int(max(each) / ratio) + 1


def _pairs(words: str) -> Column:
    """Bigrams of an array of words, in order."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - 1)), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(2))))


def word_count(text: str) -> int:
    return len(re.sub("[^a-z0-9]+", " ", text.lower()).strip().split(" "))


def bodies(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, unit, best): for each window that matches a body, where it is and (minus the coefficient, licence)."""
    ratio = least / (2 - least)
    # exploding an array of one keeps the optimizer from repeating what it is made from
    low = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.array(F.lower(null_safe_text()))).alias("low"))
    likely = low.filter(" OR ".join(f"contains(low, '{k}')" for k in KEYWORDS))
    words = likely.select("doc_id", F.explode(F.array(F.split(F.trim(F.regexp_replace("low", "[^a-z0-9]+", " ")), " "))).alias("words")).filter(F.size("words") > 1)
    grams = words.select("doc_id", F.explode(F.array(_pairs("words"))).alias("grams"))
    known = F.array(*(F.struct(F.lit(name).alias("licence"), F.lit(len(bigrams_of(t))).alias("n"), F.lit(word_count(t) - 1).alias("size"), F.array(*map(F.lit, bigrams_of(t))).alias("grams")) for name, t in BODIES))
    held = F.filter(known, lambda t: F.size(F.array_intersect("grams", t["grams"])) >= t["n"] * ratio - SLACK)
    near = grams.select("doc_id", "grams", F.explode(held).alias("t"))
    last = F.greatest(F.lit(0), F.size("grams") - F.col("t.size"))
    step = F.greatest(F.lit(1), F.floor((F.col("t.size") + 1) / STEPS).cast("int"))
    starts = F.array_union(F.sequence(F.lit(0), last, step), F.array(last))
    at = near.select("doc_id", "grams", "t", F.explode(starts).alias("start"))
    window = at.select("doc_id", "t", "start", F.explode(F.array(F.array_distinct(F.slice("grams", F.col("start") + 1, F.col("t.size"))))).alias("w"))
    dice = F.lit(2.0) * F.size(F.array_intersect("w", "t.grams")) / (F.size("w") + F.col("t.n"))
    scored = window.select("doc_id", F.format_string("%d+%d", "start", "t.size").alias("unit"), F.col("t.licence").alias("licence"), F.explode(F.array(dice)).alias("dice"))
    return scored.filter(F.col("dice") >= least).groupBy("doc_id", "unit").agg(F.min(F.struct((-F.col("dice")).alias("minus"), "licence")).alias("best"))


def find_licences(docs: DataFrame, least: float = LEAST) -> DataFrame:
    found = notices(docs, least).unionAll(bodies(docs, least))
    return found.groupBy("doc_id", F.col("best.licence").alias("licence")).agg(F.count("*").alias("n_units"), F.max(-F.col("best.minus")).alias("best_dice"))


def notices(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, unit, best): for each unit that matches a notice, (minus the coefficient, licence)."""
    text, ratio = null_safe_text(), least / (2 - least)
    low, high = _sizes(least)
    known_grams = sorted({g for _, t in TEMPLATES for g in bigrams_of(t)})
    known_words = sorted({w for g in known_grams for w in g.split(" ")})
    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n[\x20\x09-\x0D]*\n"), F.array(text)))
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(units).alias("unit"))
    plain = F.trim(F.regexp_replace(F.lower("unit"), "[^a-z0-9]+", " "))
    # exploding an array of one keeps the optimizer from moving a filter below, and so repeating, what it is made from
    normal = each.select("doc_id", F.explode(F.array(plain)).alias("unit"))
    # a unit that matches has at most ``high`` distinct bigrams, so its first words bound what a long one can have
    head = normal.select("doc_id", "unit", F.explode(F.array(F.split("unit", " ", 2 * high))).alias("head")).filter(F.size("head") > low)
    foreign = F.size(F.array_distinct(F.filter(F.slice("head", 1, 2 * high - 1), lambda w: ~w.isin(known_words))))
    likely = head.filter(foreign <= 2 * (1 - ratio) * F.least(F.size("head") - 1, F.lit(high)) + SLACK)
    words = likely.select("doc_id", "unit", F.explode(F.array(F.split("unit", " "))).alias("words"))
    grams = words.select("doc_id", "unit", F.explode(F.array(F.array_distinct(_pairs("words")))).alias("grams")).withColumn("n", F.size("grams")).filter(F.col("n").between(low, high))
    grams = grams.filter(F.size(F.filter("grams", lambda g: g.isin(known_grams))) >= F.col("n") * ratio - SLACK)
    known = F.array(*(F.struct(F.lit(name).alias("licence"), F.lit(len(bigrams_of(t))).alias("n"), F.array(*map(F.lit, bigrams_of(t))).alias("grams")) for name, t in TEMPLATES))
    fitting = F.filter(known, lambda t: F.least(F.col("n"), t["n"]) >= F.greatest(F.col("n"), t["n"]) * F.lit(ratio))
    pairs_near = grams.select("doc_id", "unit", "n", "grams", F.explode(fitting).alias("t"))
    scored = pairs_near.select("doc_id", "unit", F.explode(F.array(F.lit(2.0) * F.size(F.array_intersect("grams", "t.grams")) / (F.col("n") + F.col("t.n")))).alias("dice"), F.col("t.licence").alias("licence"))
    return scored.filter(F.col("dice") >= least).groupBy("doc_id", "unit").agg(F.min(F.struct((-F.col("dice")).alias("minus"), "licence")).alias("best"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(table(spark, sf_dir, "documents"))


def _values(templates: list[tuple[str, str]]) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"  # noqa: E731
    return ", ".join(f"({quoted(n)}, {word_count(t) - 1}, [{', '.join(map(quoted, bigrams_of(t)))}])" for n, t in templates)


_SQL_GRAMS = "list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])"
OP9_SQL = rf"""
WITH t(licence, size, grams) AS (VALUES {_values(TEMPLATES)}),
bt(licence, size, grams) AS (VALUES {_values(BODIES)}),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT doc_id, unnest(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '
[ 	-]*
'), [text])) AS unit FROM d),
p AS (SELECT DISTINCT doc_id, trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')) AS unit FROM u),
w AS (SELECT doc_id, unit, string_split(unit, ' ') AS words FROM p),
g AS (SELECT doc_id, unit, list_distinct({_SQL_GRAMS}) AS grams FROM w WHERE len(words) >= 2),
x AS (SELECT doc_id, unit, licence, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice FROM g, t),
bw AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM d WHERE {' OR '.join(f"contains(lower(text), '{k}')" for k in KEYWORDS)}),
bg AS (SELECT doc_id, {_SQL_GRAMS} AS grams FROM bw WHERE len(words) >= 2),
bs AS (SELECT doc_id, bg.grams, licence, size, bt.grams AS body, greatest(0, len(bg.grams) - size) AS last FROM bg, bt WHERE len(list_intersect(bg.grams, bt.grams)) >= {LEAST} / (2 - {LEAST}) * len(bt.grams) - {SLACK}),
bx AS (SELECT doc_id, unnest(list_distinct(list_append(range(0, last + 1, greatest(1, (size + 1) // {STEPS})), last))) AS start, grams, licence, size, body FROM bs),
bz AS (SELECT doc_id, start || '+' || size AS unit, licence, body, list_distinct(grams[start + 1 : start + size]) AS wg FROM bx),
z AS (SELECT doc_id, unit, licence, dice, false AS body FROM x UNION ALL SELECT doc_id, unit, licence, 2.0::DOUBLE * len(list_intersect(wg, body)) / (len(wg) + len(body)), true FROM bz),
b AS (SELECT doc_id, unit, licence, dice, row_number() OVER (PARTITION BY doc_id, body, unit ORDER BY dice DESC, licence) AS r FROM z)
SELECT doc_id, licence, count(*) AS n_units, max(dice) AS best_dice FROM b WHERE r = 1 AND dice >= CAST({LEAST} AS DOUBLE) GROUP BY doc_id, licence
"""
