"""Licence scans: normalised text compared to licence templates by the Dice
coefficient over word bigrams, with size bounds that prune templates.

Every line of a text is compared, and the whole text. Normalising lower-cases
A-Z and turns each run of characters other than a-z and 0-9 into one space. With
sets of a and b bigrams the coefficient is at most 2 min(a, b) / (a + b), so a
template can reach ``least`` only when a is between least / (2 - least) and
(2 - least) / least times b; other templates are not compared.

Before any of this, texts and lines go that hold none of the ``anchors``: words
that together touch so many bigrams of every template that what is left cannot
reach ``least`` without one of them. The check is a plain search for each word.

The bigrams of the lines and texts inside some template's bounds meet the
templates' bigrams by a broadcast join (the templates are constants), so only
matching bigrams are shuffled, and a common licence line is no hot key: rows
meet by document and line. A null text has no lines; units of fewer than two
words have no bigrams and match nothing. Repeated rows give one result; rows
without doc_id are one document. Extra columns play no part.

``scan`` sees neither a licence wrapped over some of a text's lines nor full
licence texts. ``scan_runs`` (the registered query) does: it compares every run
of consecutive lines, paragraphs and the whole text among them, with the notices
and with the texts in ``license_texts``. A text is first cut, per template, where
no run can reach from one side to the other. Each piece is held as one array;
lines that repeat a template's words with little between them are not cut.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions.once import compute_once
from tallyflow.llm.common import LOWER, UPPER, ascii_lower, stage
from tallyflow.llm.line_windows import touched

LEAST = 0.8

# The wording of public licences and their usual notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "All-rights-reserved": (
        "All rights reserved.",
    ),
}


def normalise(col: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(col), "[^a-z0-9]+", " "))


def bigrams(norm: Column) -> Column:
    """The distinct word bigrams of a normalised text."""
    return _pairs(F.split(norm, " "))


def _pairs(w: Column) -> Column:
    n = F.size(w)
    return F.array_distinct(F.zip_with(
        F.slice(w, 1, F.greatest(n - 1, F.lit(0))), F.slice(w, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b)))


def anchors(templates: dict[str, tuple[str, ...]], least: float) -> list[str]:
    """Words one of which every text holds that reaches ``least``.

    A text that shares c of a template's b bigrams has c at least, and the
    coefficient is 2 c / (a + b) <= 2 c / (c + b), so it misses at most
    b - b least / (2 - least) bigrams. The words are picked greedily, long ones
    first among equals, until they touch more bigrams than that in each template.
    """
    todo = []
    for t in (t for ts in templates.values() for t in ts):
        w = re.sub("[^a-z0-9]+", " ", t.translate(str.maketrans(UPPER, LOWER))).split()
        grams = set(zip(w, w[1:]))
        todo.append([grams, len(grams) - math.ceil(len(grams) * least / (2 - least) - 1e-9) + 1])
    words = sorted({w for grams, _ in todo for g in grams for w in g}, key=lambda w: (-len(w), w))
    picked = []
    while any(need > 0 for _, need in todo):
        gain = {w: sum(min(need, sum(w in g for g in grams)) for grams, need in todo if need > 0)
                for w in words if w not in picked}
        best = max(gain, key=lambda w: (gain[w] * (len(w) >= 6), gain[w], len(w), w))
        picked.append(best)
        for t in todo:
            hit = {g for g in t[0] if best in g}
            t[0], t[1] = t[0] - hit, t[1] - len(hit)
    return picked


def _templates(docs: DataFrame, templates: dict[str, tuple[str, ...]], least: float) -> DataFrame:
    rows = [(lic, k, t) for lic, ts in templates.items() for k, t in enumerate(ts)]
    t = docs.sparkSession.createDataFrame(rows, "license string, wording int, template string")
    t = compute_once(t, F.split(normalise(F.col("template")), " ").alias("w"), keep=("license", "wording"))
    t = compute_once(t, _pairs(F.col("w")).alias("grams"), keep=("license", "wording"))
    b = F.size("grams")
    return t.select("license", "wording", b.alias("b"), "grams",
                    F.ceil(b * least / (2 - least) - 1e-9).alias("lo"),
                    F.floor(b * (2 - least) / least + 1e-9).alias("hi"))


def scan(docs: DataFrame, least: float = LEAST,
         templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """Per document and licence: the best coefficient of its lines and its
    whole text, and how many different lines or texts reach ``least``."""
    t = _templates(docs, templates, least)
    lo, hi = t.agg(F.min("lo"), F.max("hi")).first()
    words = anchors(templates, least)

    def anchored(rows: DataFrame, col: str) -> DataFrame:
        low = compute_once(rows, F.lower(col).alias("_low"))       # once, not per word
        return low.where(reduce(Column.__or__, (F.contains("_low", F.lit(w)) for w in words))).drop("_low")

    units = anchored(docs.select("doc_id", F.col("text").alias("unit")), "unit")
    units = anchored(units.select("doc_id", F.explode(F.array_append(F.split("unit", "\n"), F.col("unit"))).alias("unit")),
                     "unit")
    units = units.withColumn("unit", normalise(F.col("unit"))).where(F.length("unit") >= 3)
    units = units.withColumn("grams", bigrams(F.col("unit"))).withColumn("a", F.size("grams"))
    units = units.where(F.col("a").between(lo, hi))
    rows = units.select("doc_id", F.xxhash64("unit").alias("unit"), "a", F.explode("grams").alias("gram"))
    post = F.broadcast(t.select("license", "wording", "b", "lo", "hi", F.explode("grams").alias("gram")))
    shared = (rows.join(post, "gram").where(F.col("a").between(F.col("lo"), F.col("hi")))
              .select("doc_id", "unit", "license", "wording", "a", "b", "gram").distinct()
              .groupBy("doc_id", "unit", "license", "wording", "a", "b").agg(F.count("*").alias("c")))
    dice = (2 * F.col("c") / (F.col("a") + F.col("b"))).cast("double")
    return (shared.withColumn("dice", dice).where(F.col("dice") >= least)
            .groupBy("doc_id", "license").agg(F.max("dice").alias("dice"),
                                              F.countDistinct("unit").alias("units")))


def full_templates() -> dict[str, tuple[str, ...]]:
    """The notices and the texts of ``license_texts`` (``<licence>.txt`` and
    ``<licence>+<part>.txt``)."""
    out = dict(TEMPLATES)
    for f in sorted((resources.files("tallyflow.llm") / "license_texts").iterdir(), key=lambda f: f.name):
        if f.name.endswith(".txt"):
            lic = f.name.removesuffix(".txt").split("+")[0]
            out[lic] = (*out.get(lic, ()), f.read_text(encoding="utf-8"))
    return out


def _occurrences(texts: DataFrame) -> DataFrame:
    """Per text ``h`` its bigrams in order: the line ``i`` of the first word,
    ``j`` of the second, ``prev``, the line where the bigram last began, and
    ``next`` (``pos`` and ``j``) of where it begins again. Of those that begin on
    one line only the first is kept."""
    lines = F.transform(F.split("text", "\n"), normalise)
    words = F.filter(F.flatten(F.transform(lines, lambda line, i: F.transform(
        F.split(line, " "), lambda w: F.struct(w.alias("w"), i.alias("i"))))), lambda x: x.w != "")
    once = compute_once(texts, words.alias("w"), keep=("h",))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    grams = F.zip_with(F.slice("w", 1, n), F.slice("w", 2, n), lambda a, b: F.struct(
        F.concat(a.w, F.lit(" "), b.w).alias("gram"), a.i.alias("i"), b.i.alias("j")))
    rows = once.select("h", F.posexplode(grams).alias("pos", "g")).select("h", "pos", "g.*")
    again = Window.partitionBy("h", "gram").orderBy("pos")
    prev = F.coalesce(F.lag("i").over(again), F.lit(-1))
    return (rows.withColumn("prev", prev).where(F.col("prev") < F.col("i"))
            .withColumn("next", F.lead(F.struct("pos", "j")).over(again)))


def _islands(occ: DataFrame, text: list[str]) -> DataFrame:
    """The occurrences that a run of ``least`` can hold, with the ``island`` they
    are on; no such run has parts of two islands.

    A run that reaches ``least`` has at most ``hi`` bigrams and lacks at most
    ``gap`` of the template's. It begins and ends on lines that a shared bigram
    touches. So a line with more than ``hi`` bigrams is in no run, and where more
    than ``gap`` different bigrams begin between two touched lines, none of them
    shared, no run goes across.
    """
    along = Window.partitionBy(*text).orderBy("pos")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    line = Window.partitionBy(*text, "i")
    ends = (F.lag("j").over(along) == F.col("i")) & (F.lag("m").over(along) == 1)
    occ = occ.withColumn("ends", F.coalesce(ends, F.lit(False)).cast("int"))
    occ = (occ.withColumn("hit", F.max("m").over(line))
           .withColumn("touched", F.max(F.greatest("m", "ends")).over(line) == 1)
           .withColumn("fits", F.sum((F.col("i") == F.col("j")).cast("int")).over(line) <= F.col("hi")))
    occ = occ.withColumn("used", F.col("touched") & F.col("fits"))
    occ = occ.withColumn("at", F.last(F.when(F.col("used"), F.col("i")), ignorenulls=True).over(so_far)).where(F.col("at").isNotNull())
    other = (F.when(F.col("used"), 0).when(~F.col("fits"), F.col("gap") + 1)
             .otherwise((F.col("prev") < F.col("at")).cast("int")))
    after = Window.partitionBy(*text, "at")
    occ = occ.withColumn("cut", F.sum(other).over(after) > F.col("gap"))
    first = (F.col("pos") == F.min("pos").over(after)) & F.col("cut")
    occ = occ.withColumn("first", first.cast("int"))
    occ = occ.withColumn("island", F.sum("first").over(so_far) - F.col("cut").cast("int"))
    return occ.where(~F.col("cut") | (F.col("used") & (F.col("i") == F.col("j"))))


def _best_run() -> Column:
    """Of ``occs`` (one island): the best coefficient of a run of lines, the
    shortest and then first of equals, with its length and first line negative.

    A bigram counts in a run from line s once: where it begins on s or later and
    ``prev`` is before s. From each start these are counted on; the coefficient is
    taken where a line is complete. The best run starts on a line where a shared
    bigram begins that does not come again in the run (without that line it would
    be as good), and more than ``hi`` bigrams are too many for ``least``.
    """
    n = F.size("occs")
    at = lambda k: F.get("occs", k)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda k: (at(k).hit == 1) & (
        (k == 0) | (F.coalesce(at(k - 1).i, F.lit(-1)) != at(k).i)))

    def counted(k: Column) -> Column:
        new = lambda size: F.filter(F.slice("occs", k + 1, size), lambda x: (
            x.prev < at(k).i) & (x.j < at(k).stop.j))
        most = F.least(n, at(k).stop.pos - at(k).pos + 1)
        span = F.least(most, 4 * (F.col("hi") + 1))
        # mostly a few times hi is enough to see more than hi different ones
        near = F.when((span >= most) | (F.size(new(span)) > F.col("hi")), new(span)).otherwise(new(most))
        return F.slice(near, 1, F.col("hi") + 1)

    def closed(acc: Column) -> tuple[Column, Column]:
        dice = (2 * acc.c / (acc.a + F.col("b"))).cast("double")
        return F.greatest(dice, acc.best), F.when(dice > acc.best, acc.j).otherwise(acc.end)

    def step(acc: Column, x: Column) -> Column:
        best, end = closed(acc)
        return F.struct((acc.a + 1).alias("a"), (acc.c + x.m).alias("c"), x.j.alias("j"),
                        F.when(x.j != acc.j, best).otherwise(acc.best).alias("best"),
                        F.when(x.j != acc.j, end).otherwise(acc.end).alias("end"))

    zero = F.struct(F.lit(0).alias("a"), F.lit(0).alias("c"), F.lit(-1).alias("j"),
                    F.lit(0.0).alias("best"), F.lit(-1).alias("end"))
    return F.array_max(F.transform(starts, lambda k: F.aggregate(counted(k), zero, step, lambda acc: F.struct(
        closed(acc)[0].alias("dice"), (at(k).i - closed(acc)[1]).alias("more"), (-at(k).i).alias("first")))))


def scan_runs(docs: DataFrame, least: float = LEAST,
              templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per document and licence: the best coefficient of its runs of consecutive
    lines, and the first and last line of that run (the shortest and then first
    of equals).

    A run that reaches ``least`` shares at least ``lo`` bigrams with the template,
    so only texts that hold as many are taken apart.
    """
    t = _templates(docs, templates or full_templates(), least)
    t = t.withColumn("gap", F.floor(F.col("b") * 2 * (1 - least) / least + 1e-9))
    docs = docs.where(F.col("text").isNotNull()).select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("h"))
    post = t.select("license", "wording", F.explode("grams").alias("gram"))
    key = ["license", "wording"]
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    words = compute_once(rows, F.split(normalise(F.col("text")), " ").alias("w"), keep=("h", "row"))    # once, not per use
    sizes = t.select(*key, *[F.col(c).cast("int").alias(c) for c in ("b", "lo", "hi", "gap")])
    # a row's bigrams are all in one task, so the counts are whole before the shuffle
    cand = (words.select("h", "row", F.explode(_pairs(F.col("w"))).alias("gram"))
            .join(F.broadcast(post), "gram").groupBy("h", "row", *key).agg(F.count("*").alias("c"))
            .join(F.broadcast(sizes), key).where(F.col("c") >= F.col("lo")).drop("c", "row").distinct())
    cand = stage(cand, "license-candidates")
    some, _ = touched(docs.select("text", "h", F.lit(0).alias("id"), F.col("h").alias("th")),
                      cand.select(F.lit(0).alias("id"), F.col("h").alias("th")))
    texts = some.join(cand.select("h").distinct(), "h", "left_semi").select("h", "text").dropDuplicates(["h"])
    occ = (_occurrences(texts).join(cand, "h")
           .join(F.broadcast(post.withColumn("m", F.lit(1))), [*key, "gram"], "left")
           .withColumn("m", F.coalesce("m", F.lit(0))))
    occ = _islands(occ, ["h", *key])
    never = F.struct(F.lit(2**30).alias("pos"), F.lit(2**30).alias("j"))
    again = F.max(F.when(F.col("m") == 1, F.coalesce("next", never))).over(Window.partitionBy("h", *key, "i"))
    best = (occ.withColumn("stop", F.coalesce(again, never))
            .groupBy("h", *key, "island", "b", "lo", "hi")
            .agg(F.sum("m").alias("c"),
                 F.sort_array(F.collect_list(F.struct("pos", "i", "j", "prev", "m", "hit", "stop"))).alias("occs"))
            .where(F.col("c") >= F.col("lo"))
            .select("h", "license", _best_run().alias("run")).where(F.col("run.dice") >= least))
    first = 1 - F.col("run.first")
    return (docs.select("doc_id", "h").join(best, "h").groupBy("doc_id", "license").agg(F.max("run").alias("run"))
            .select("doc_id", "license", "run.dice", first.alias("first_line"),
                    (first - F.col("run.more")).alias("last_line")))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ORACLE = f"""
WITH tpl(license, wording, body) AS (VALUES {', '.join(
    f"({_sql_text(lic)}, {k}, {_sql_text(t)})" for lic, ts in full_templates().items() for k, t in enumerate(ts))}),
texts AS (SELECT row_number() OVER () AS h, text FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)),
split AS (SELECT h, NULL AS license, 0 AS wording, unnest(string_split(text, chr(10))) AS line,
              unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM texts
          UNION ALL SELECT NULL, license, wording, body, 1 FROM tpl),
norm AS (SELECT * EXCLUDE (line), trim(regexp_replace(translate(line, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')) AS line FROM split),
w AS (SELECT * EXCLUDE (line), unnest(string_split(line, ' ')) AS w, unnest(range(len(string_split(line, ' ')))) AS k
      FROM norm WHERE line <> ''),
g AS (SELECT h, license, wording, i, lead(i) OVER o AS j, w || ' ' || lead(w) OVER o AS gram
      FROM w WINDOW o AS (PARTITION BY h, license, wording ORDER BY i, k)),
tg AS (SELECT DISTINCT license, wording, gram, 1 AS m FROM g WHERE h IS NULL AND gram IS NOT NULL),
tb AS (SELECT license, wording, count(*) AS b FROM tg GROUP BY license, wording),
dg AS (SELECT h, gram, i, min(j) AS j FROM g WHERE h IS NOT NULL AND gram IS NOT NULL GROUP BY h, gram, i),
cand AS (SELECT h, license, wording, b FROM (SELECT DISTINCT h, gram FROM dg) JOIN tg USING (gram) JOIN tb USING (license, wording)
         GROUP BY h, license, wording, b HAVING count(*) >= b * {LEAST} / (2 - {LEAST}) - 1e-9),
occ AS (SELECT dg.*, license, wording, b, coalesce(m, 0) AS m
        FROM dg JOIN cand USING (h) LEFT JOIN tg USING (license, wording, gram)),
starts AS (SELECT DISTINCT h, license, wording, i AS s FROM occ WHERE m = 1),
firsts AS (SELECT h, license, wording, s, b, gram, m, min(j) AS j FROM starts JOIN occ USING (h, license, wording)
           WHERE i >= s GROUP BY h, license, wording, s, b, gram, m),
runs AS (SELECT h, license, s, j, 2.0::DOUBLE * sum(sum(m)) OVER o / (sum(count(*)) OVER o + b) AS dice
         FROM firsts GROUP BY h, license, wording, s, b, j
         WINDOW o AS (PARTITION BY h, license, wording, s, b ORDER BY j)),
best AS (SELECT doc_id, license, dice, s, j, row_number() OVER (
             PARTITION BY doc_id, license ORDER BY dice DESC, j - s, s) AS r
         FROM runs JOIN texts USING (h) JOIN (SELECT DISTINCT doc_id, text FROM documents) USING (text) WHERE dice >= {LEAST})
SELECT doc_id, license, dice, s AS first_line, j AS last_line FROM best WHERE r = 1
"""
