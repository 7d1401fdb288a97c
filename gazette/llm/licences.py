"""Licence scan: Dice coefficient over word bigrams against templates.

Every line of a text, and the whole text if it has several lines, is normalised
to lower-case words and compared with each template by the Dice coefficient of
the two bigram bags, ``2 * common / (bigrams of the unit + of the template)``.
Since ``common`` is at most the smaller count, the two counts alone bound the
coefficient; templates that fail the bound are pruned before any bigram is
built, so long texts cost one word count.  A match also needs two thirds of a
template's bigrams, so a unit without any of a few key words matches nothing:
such lines and texts are passed over before they are normalised.

Only DataFrame operations, all inside the row: nothing is shuffled.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

TENTHS = 8  # similarity: 0.8 or more

# Licence names and the public wording that states them.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License."),
    ("bsd-2-clause", "Released under the BSD 2-Clause License."),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met:"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
     "rights to this work."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
     "(at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def template_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def key_words(templates) -> list[str]:
    """Words of which every unit that matches a template holds at least one.

    A match needs ``common >= TENTHS * m / (20 - TENTHS)`` of a template's ``m``
    bigrams, so it cannot miss a set of more than the rest.  Words are taken, long
    ones first, until in every template the bigrams that hold one are such a set.
    """
    bags = [list(zip(w, w[1:])) for w in (template_words(t) for _, t in templates) if len(w) > 1]
    open_ = [(b, len(b) + TENTHS * len(b) // (TENTHS - 20) + 1) for b in bags]  # m less its share, and one more
    words, taken = sorted({w for b in bags for pair in b for w in pair}), []

    def gain(word):
        return sum(min(need, sum(word in pair for pair in bag)) for bag, need in open_)

    while open_:
        best = max(words, key=lambda w: (gain(w) > 0 and len(w) > 4, gain(w), len(w), w))
        taken.append(best)
        open_ = [([p for p in bag if best not in p], need - sum(best in p for p in bag)) for bag, need in open_]
        open_ = [(bag, need) for bag, need in open_ if need > 0]
    return taken


def _templates(templates) -> Column:
    rows = []
    for name, text in templates:
        words = template_words(text)
        bag = Counter(zip(words, words[1:]))
        rows.append({"name": name, "n": sum(bag.values()),
                     "bag": [{"b": " ".join(b), "c": c} for b, c in sorted(bag.items())]})
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<name:string,n:int,bag:array<struct<b:string,c:int>>>>")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def _passes(common: Column, n: Column, m: Column) -> Column:
    return 20 * common >= TENTHS * (n + m)


def scan_licences(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: what licence statements its text holds.

    ``doc_id``; ``n_lines``; ``n_statements``, units that match a template;
    ``licence`` and ``dice`` of the best match (ties: the smaller name; NULL if
    none); ``licences``, all names found, sorted and comma-joined.  NULL and
    empty texts have no lines.  Units of fewer than two words match nothing.
    Repeated rows give repeated results.
    """
    lines, units, known = (fresh(docs, x) for x in ("_lines", "_units", "_templates"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keys = key_words(templates)

    def may_match(unit):
        low = F.lower(unit)
        return reduce(or_, [F.contains(low, F.lit(w)) for w in keys], F.lit(False))

    df = docs.select("doc_id", F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))
                     .alias(lines), text.alias(units))
    # the whole text's words are those of its lines in a row: a line's end is no part of a word
    some = F.transform(F.filter(F.col(lines), may_match), _words)
    some = F.when(F.size(lines) > 1, F.concat(some, F.array(_words(F.col(units))))).otherwise(some)
    df = df.withColumn(units, F.when(may_match(F.col(units)), some).otherwise(F.array().cast("array<array<string>>")))
    df = df.withColumn(known, _templates(templates))
    # the bound over all templates first: most lines and nearly all whole texts end here
    counts = [len(template_words(t)) - 1 for _, t in templates]
    least = -(-TENTHS * min(counts) // (20 - TENTHS))
    most = (20 - TENTHS) * max(counts) // TENTHS
    short = F.filter(F.col(units), lambda w: (F.size(w) > F.greatest(F.lit(least), F.lit(1))) & (F.size(w) <= most + 1))
    df = df.withColumn(units, short)
    df = df.withColumn(units, F.transform(F.col(units), lambda w: F.zip_with(
        F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda x, y: F.concat_ws(" ", x, y))))

    def matches(pairs):
        n = F.size(pairs)
        near = F.filter(F.col(known), lambda t: _passes(F.least(n, t["n"]), n, t["n"]))

        def dice(t):
            common = F.aggregate(t["bag"], F.lit(0), lambda acc, x: acc + F.least(
                x["c"], F.size(F.filter(pairs, lambda p: p == x["b"]))))
            return F.struct((-2.0 * common / (n + t["n"])).alias("d"), t["name"].alias("name"),
                            _passes(common, n, t["n"]).alias("ok"))

        return F.array_min(F.filter(F.transform(near, dice), lambda m: m["ok"]))

    best = fresh(df, "_best")
    df = df.withColumn(best, F.filter(F.transform(F.col(units), matches), lambda m: m.isNotNull()))
    names = F.array_sort(F.array_distinct(F.transform(F.col(best), lambda m: m["name"])))
    return df.select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                     F.size(best).cast("long").alias("n_statements"),
                     F.array_min(best)["name"].alias("licence"), (-F.array_min(best)["d"]).alias("dice"),
                     F.array_join(names, ",").alias("licences"))
