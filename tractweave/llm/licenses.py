"""Licence scan: lines and whole texts compared with licence templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording of the licences, as their publishers give it.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD-3-Clause": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}

THRESHOLD = 0.8


def normalised_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def template_bigrams(templates: Mapping[str, tuple[str, ...]]) -> list[tuple[str, list[str]]]:
    """Licence and distinct word bigrams of every wording that has two words."""
    out = []
    for name in sorted(templates):
        for wording in templates[name]:
            words = normalised_words(wording)
            pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
            if pairs:
                out.append((name, pairs))
    return out


def _bigrams(words: Column) -> Column:
    n = F.size(words) - 1
    return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b)))


def scan(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``licenses``: an array of (unit, license, dice), empty where nothing matches.

    Units are the lines of the text (numbered from 1) and the whole text (0), lower-cased and cut into words of ASCII
    letters and digits. A unit matches a licence if the Dice coefficient of its bigrams with one of the wordings reaches
    ``threshold``; the best wording counts, ties go to the first licence by name. Wordings whose number of bigrams alone
    rules the threshold out are never compared, and neither are units with too few words of any wording. All
    is done inside the row, so nothing is shuffled. NULL and empty texts match nothing; repeated rows are treated alike.
    """
    wordings = template_bigrams(templates)
    if not wordings:
        return docs.withColumn("licenses", F.array().cast("array<struct<unit:int,license:string,dice:double>>"))
    share = threshold / (2 - threshold)  # |A & B| >= share * |A|, and share <= |A| / |B| <= 1 / share
    low, high = min(len(b) for _, b in wordings) * share, max(len(b) for _, b in wordings) / share
    vocabulary = sorted({w for _, pairs in wordings for p in pairs for w in p.split()})
    known = F.array(
        *[
            F.struct(F.lit(name).alias("license"), F.lit(len(pairs)).alias("size"), F.array(*[F.lit(p) for p in pairs]).alias("pairs"))
            for name, pairs in wordings
        ]
    )

    text = F.lower(F.coalesce(F.col("text"), F.lit("")))
    lines = F.transform(
        F.split(text, "\n"),
        lambda line, i: F.struct((i + 1).alias("unit"), F.array_remove(F.split(line, "[^a-z0-9]+"), "").alias("words")),
    )
    whole = F.array(F.struct(F.lit(0).alias("unit"), F.flatten(F.transform("_lines", lambda u: u["words"])).alias("words")))
    units = F.when(F.size("_lines") > 1, F.concat("_lines", whole)).otherwise(F.col("_lines"))

    def likely_words(words: Column) -> Column:
        # n distinct words make n - 1 distinct bigrams or more, and shared bigrams consist of words of the vocabulary
        n = F.size(F.array_distinct(words))
        return (n <= high + 1) & (F.size(F.filter(words, lambda w: w.isin(vocabulary))) >= share * (n - 1) + 1)

    likely = F.filter(units, lambda u: likely_words(u["words"]))
    paired = F.transform(likely, lambda u: F.struct(u["unit"].alias("unit"), _bigrams(u["words"]).alias("pairs")))
    sized = F.filter(paired, lambda u: (F.size(u["pairs"]) >= low) & (F.size(u["pairs"]) <= high))

    def best(u: Column) -> Column:
        n = F.size(u["pairs"])
        candidates = F.filter("_known", lambda t: (n >= t["size"] * share) & (n * share <= t["size"]))
        return F.transform(
            candidates,
            lambda t: F.struct(
                (2.0 * F.size(F.array_intersect(u["pairs"], t["pairs"])) / (n + t["size"])).alias("dice"),
                t["license"].alias("license"),
            ),
        )

    scored = F.transform(sized, lambda u: F.struct(u["unit"].alias("unit"), F.filter(best(u), lambda m: m["dice"] >= threshold).alias("m")))
    hits = F.filter(scored, lambda u: F.size(u["m"]) > 0)

    def first_best(m: Column) -> Column:
        top = F.array_max(F.transform(m, lambda x: x["dice"]))
        return F.struct(F.array_min(F.transform(F.filter(m, lambda x: x["dice"] == top), lambda x: x["license"])).alias("license"), top.alias("dice"))

    out = F.transform(
        hits, lambda u: F.struct(u["unit"].alias("unit"), first_best(u["m"])["license"].alias("license"), first_best(u["m"])["dice"].alias("dice"))
    )
    return docs.withColumn("_known", known).withColumn("_lines", lines).withColumn("licenses", out).drop("_known", "_lines")


def license_table(docs: DataFrame) -> DataFrame:
    """Per document the number of matching lines, the licences found and the best coefficient (0 where there is none)."""
    found = scan(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda m: m["license"]))), ",").alias("licenses"),
        F.round(F.coalesce(F.array_max(F.transform("licenses", lambda m: m["dice"])), F.lit(0.0)), 6).alias("best_dice"),
    )


def license_sql(templates: Mapping[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    rows = ", ".join(
        "('{}', [{}])".format(name, ", ".join("'" + p.replace("'", "''") + "'" for p in pairs)) for name, pairs in template_bigrams(templates)
    )
    return f"""
WITH t(license, pairs) AS (VALUES {rows}),
d AS (SELECT doc_id, lower(coalesce(text, '')) AS text FROM documents),
l AS (SELECT doc_id, string_split(text, chr(10)) AS l, text FROM d),
u AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS unit, unnest(l) AS line FROM l
      UNION ALL SELECT doc_id, 0, text FROM l WHERE len(l) > 1),
w AS (SELECT doc_id, unit, list_filter(regexp_split_to_array(line, '[^a-z0-9]+'), lambda x: x <> '') AS w FROM u),
b AS (SELECT doc_id, unit, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS a FROM w WHERE len(w) > 1 AND len(w) < 2000),
m AS (SELECT doc_id, unit, license, max(2.0 * len(list_intersect(a, pairs)) / (len(a) + len(pairs))) AS dice
      FROM b, t WHERE len(a) BETWEEN len(pairs) * {threshold / (2 - threshold)} AND len(pairs) / {threshold / (2 - threshold)} GROUP BY ALL),
k AS (SELECT doc_id, unit, arg_min(license, (-dice, license)) AS license, max(dice) AS dice FROM m WHERE dice >= {threshold} GROUP BY ALL),
r AS (SELECT doc_id, count(*) AS n, list(DISTINCT license ORDER BY license) AS found, max(dice) AS dice FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(array_to_string(found, ','), '') AS licenses,
       round(coalesce(dice, 0.0)::DOUBLE, 6) AS best_dice
FROM d LEFT JOIN r USING (doc_id)
"""
