"""License scan: units of normalised text against license templates by Dice coefficient.

Units are a document's lines, the sentences of lines that have several, and the
whole text. A unit is lower-cased and reduced to words of letters and digits;
its set of word bigrams A and a template's set B give 2 |A & B| / (|A| + |B|).
A coefficient of t or more needs t / (2 - t) <= |A| / |B| <= (2 - t) / t, so
only templates within these size bounds are compared. It also needs at least
t / (2 - t) |B| common bigrams; ``pivots`` are template words chosen so that
fewer of a template's bigrams avoid all of them, hence a unit without a pivot
matches nothing and is dropped by one pattern before any bigram is made.

All in DataFrame functions, row by row: nothing is shuffled, and the templates
are a constant inside the plan.

Defined cases: null or empty text matches nothing; a unit of one word has no
bigram and matches nothing; equal coefficients go to the smaller license id;
the whole text is a unit only if it has several lines or sentences (else it is
the line itself); each input row is judged alone, so repeated rows and null ids
give their own matches; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm.common import let, read

# Usual short notices of public licenses.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "BSD-2-Clause": "Use of this source code is governed by the BSD 2-Clause License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-short": "Licensed under CC BY 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved. No part of this work may be reproduced without written permission.",
    "Public-domain": "This work has been released into the public domain.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
MIN_DICE = 0.75
#: Words too common in any text to serve as pivots.
COMMON = {"a", "an", "and", "any", "as", "at", "be", "by", "for", "in", "is", "it", "may", "no", "not", "of", "or", "that", "the",
          "this", "to", "under", "use", "with", "you"}


def normal_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigram_set(ws: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(ws, ws[1:])})


def pivots(templates: dict[str, str], least: float) -> list[str]:
    """Words such that a unit with none of them can't reach the coefficient with any template."""
    out: list[str] = []
    sets = [bigram_set(normal_words(t)) for t in templates.values()]
    while True:
        open_sets = []
        for b in sets:
            free = [x for x in b if not set(x.split()) & set(out)]
            if len(free) >= least / (2 - least) * len(b):
                open_sets.append(free)
        if not open_sets:
            return sorted(out)
        # long words are rarer in texts; of those take the one in most bigrams
        count: dict[str, int] = {}
        for free in open_sets:
            ws = {w for x in free for w in x.split()}
            plain = {w for w in ws if not w.isdigit() and w not in COMMON}
            for w in [w for w in plain if len(w) > 4] or plain or ws:
                count[w] = count.get(w, 0) + sum(w in x.split() for x in free)
        out.append(max(sorted(count), key=lambda w: (count[w], len(w))))


def _units(text: Column) -> Column:
    """array<struct<level, at, unit>>: lines, their sentences, the whole text."""
    lines = F.split(text, "\n", -1)
    sentences = F.split(F.regexp_replace(text, "([.!?])[ \t]+", "$1\n"), "\n", -1)
    several = F.size(sentences) > 1
    at = lambda level: lambda u, i: F.struct(F.lit(level).alias("level"), i.alias("at"), u.alias("unit"))
    none = F.array().cast("array<struct<level:string,at:int,unit:string>>")
    return F.concat(F.transform(lines, at("line")),
                    F.when(F.size(sentences) > F.size(lines), F.transform(sentences, at("sentence"))).otherwise(none),
                    F.when(several, F.transform(F.array(text), at("text"))).otherwise(none))


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = MIN_DICE) -> DataFrame:
    """(doc_id, level, at, license, n_bigrams, n_common, dice): each unit's best template of ``least`` or more."""
    known = F.array(*[F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, bigram_set(normal_words(t)))).alias("b"))
                      for name, t in sorted(templates.items())])
    hint = F.lit(rf"(?i)(?<![a-z0-9])({'|'.join(pivots(templates, least))})(?![a-z0-9])")
    sizes = [len(bigram_set(normal_words(t))) for t in templates.values()]
    most = int(max(sizes) * (2 - least) / least)
    text = F.coalesce(F.col("text"), F.lit(""))
    units = F.filter(_units(text), lambda u: F.regexp_like(u["unit"], hint))
    rows = docs.where(F.regexp_like(text, hint)).select("doc_id", F.inline(units))
    ws = F.filter(F.split(F.regexp_replace(F.lower("unit"), "[^a-z0-9]+", " "), " ", -1), lambda w: w != "")
    pairs = let(ws, lambda w: F.transform(F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda b, i: F.concat_ws(" ", F.get(w, i), b)))
    rows = rows.withColumn("a", F.array_distinct(pairs)).where((F.size("a") > 0) & (F.size("a") <= most)).drop("unit")
    n = F.size("a")
    near = F.filter(known, lambda t: (n >= F.size(t["b"]) * (least / (2 - least)) - 1e-9) & (n <= F.size(t["b"]) * ((2 - least) / least) + 1e-9))
    scored = F.transform(near, lambda t: F.struct(
        (-2.0 * F.size(F.array_intersect("a", t["b"])) / (n + F.size(t["b"]))).alias("d"), t["license"].alias("license"),
        F.size(F.array_intersect("a", t["b"])).alias("common")))
    return (rows.withColumn("best", F.array_min(scored)).where(-F.col("best.d") >= least)
            .select("doc_id", "level", "at", "best.license", n.cast("bigint").alias("n_bigrams"),
                    F.col("best.common").cast("bigint").alias("n_common"), F.round(-F.col("best.d"), 6).alias("dice")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return find_licenses(read(spark, sf_dir, "documents", "doc_id", "text"))


def _sql() -> str:
    values = ", ".join("('{}', [{}])".format(n, ", ".join("'" + b.replace("'", "''") + "'" for b in bigram_set(normal_words(t))))
                       for n, t in sorted(TEMPLATES.items()))
    return rf"""
WITH t(license, b) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
u AS (
  SELECT r, doc_id, 'line' AS level, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS "at" FROM d
  UNION ALL
  SELECT r, doc_id, 'sentence', unnest(s), generate_subscripts(s, 1) - 1 FROM (
    SELECT r, doc_id, text, string_split(regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10)) AS s FROM d)
    WHERE len(s) > len(string_split(text, chr(10)))
  UNION ALL
  SELECT r, doc_id, 'text', text, 0 FROM d WHERE len(string_split(regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))) > 1),
w AS (SELECT r, doc_id, level, "at", list_filter(string_split(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM u),
a AS (SELECT r, doc_id, level, "at", list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS a FROM w WHERE len(w) > 1),
p AS (SELECT r, doc_id, level, "at", license, len(a) AS n, len(list_intersect(a, b)) AS c, 2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
  FROM a JOIN t ON list_has_any(a, b)),
q AS (SELECT *, row_number() OVER (PARTITION BY r, level, "at" ORDER BY dice DESC, license) AS k FROM p WHERE dice >= {MIN_DICE})
SELECT doc_id, level, "at"::INT AS "at", license, n::BIGINT AS n_bigrams, c::BIGINT AS n_common, round(dice, 6) AS dice FROM q WHERE k = 1
"""


OP1_SQL = _sql()
