"""Licence scan: normalised units of a text against templates, by the Dice coefficient of word bigrams."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.text import let, need

# Public licence notices, and of licence texts a sentence that tells them apart
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met:",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
               "and accompanying documentation covered by this license",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    "MIT-warranty": "The software is provided \"as is\", without warranty of any kind, express or implied, including but not "
                    "limited to the warranties of merchantability",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
    "Public-Domain": "This is free and unencumbered software released into the public domain.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty.",
}
THRESHOLD = 0.8


def template_words(text: str) -> list[str]:
    """The words of a template, normalised as texts are."""
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    """The different word bigrams of a template."""
    words = template_words(text)
    return sorted({" ".join(p) for p in zip(words, words[1:])})


def probe_bigrams(bigrams: list[str], threshold: float) -> set[str]:
    """Bigrams one of which is in every unit that reaches the threshold with a template.

    Such a unit holds at least t / (2 - t) of the template's n bigrams, hence one
    of any n - t / (2 - t) * n + 1 of them: those with the longest words are taken.
    """
    n = len(bigrams)
    enough = n - math.ceil(n * threshold / (2 - threshold) - 1e-9) + 1
    return set(sorted(bigrams, key=lambda b: (-max(map(len, b.split())), b))[:enough])


def _words(unit: Column) -> Column:
    """Words of A-Z, a-z and 0-9, in small letters; other characters part words."""
    return F.split(F.lower(F.trim(F.regexp_replace(unit, "[^A-Za-z0-9]+", " "))), " ")


def _pairs(w: Column) -> Column:
    """The bigrams of at least two words, in order and with repeats."""
    return F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b))


def _bigrams(unit: Column, most: float) -> Column:
    """Different bigrams of a unit; none where different words show that there are more than ``most``."""
    return let(_words(unit), lambda w: F.when(
        (F.size(w) < 2) | (F.size(F.array_distinct(w)) > most + 1), F.array().cast("array<string>")
    ).otherwise(F.array_distinct(_pairs(w))))


def _window_scores(text: Column, known: dict[str, list[str]], sizes: dict[str, int], threshold: float) -> Column:
    """(d, k) of the best window of each template that has one of at least ``threshold``.

    A window is as many consecutive words of the whole text as the template has.
    One that reaches the threshold holds one of the template's probes, so only the
    windows around the places of these are compared.
    """
    probes = {k: sorted(probe_bigrams(g, threshold)) for k, g in known.items()}
    every = sorted(set().union(*probes.values()))

    def of_bigrams(b: Column) -> Column:
        places = F.filter(F.transform(b, lambda x, i: F.struct(x.alias("x"), (i + 1).alias("i"))), lambda s: s["x"].isin(every))
        return let(places, lambda hits: F.array_compact(F.array(*[best(b, hits, k) for k in known])))

    def best(b: Column, hits: Column, k: str) -> Column:
        size, t = sizes[k] - 1, known[k]  # bigrams of a window, and of the template
        last = F.size(b) - size + 1  # the last start
        own = F.filter(hits, lambda s: s["x"].isin(probes[k]) & (last >= 1))
        starts = F.array_distinct(F.flatten(F.transform(own, lambda s: F.sequence(
            F.greatest(s["i"] - size + 1, F.lit(1)), F.least(s["i"], last)))))

        def score(i: Column) -> Column:
            return let(F.array_distinct(F.slice(b, i, size)), lambda g: (
                2.0 * F.size(F.array_intersect(g, F.array(*map(F.lit, t)))) / (F.size(g) + len(t))))

        return let(F.array_max(F.transform(starts, score)), lambda d: F.when(d >= threshold, F.struct(d.alias("d"), F.lit(k).alias("k"))))

    return let(_words(text), lambda w: F.when(F.size(w) < 2, F.array().cast("array<struct<d:double,k:string>>")).otherwise(
        let(_pairs(w), of_bigrams)))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``n_matches``, ``n_templates``, and ``license`` and ``dice`` of the best match.

    Units are the lines of a text, the whole text, where it has several lines, and
    for each template all windows of its number of words, across line ends: a
    notice within a longer line and a licence text wrapped in any way are found by
    these. ``n_matches`` counts pairs of a line or whole text and a template,
    ``n_templates`` the different templates that any unit or window reaches.
    2|A and B| / (|A| + |B|) can reach the threshold t only where |A| is from
    t / (2 - t) to (2 - t) / t times |B|: a template is compared only with units
    of such a size that share a bigram with any template; units without any of the
    templates' ``probe_bigrams`` cannot reach it and are passed over. Ties go to the template
    whose name comes first. A null text has no match (0, null, null); null ids
    and repeated rows are passed on; other columns are not read. All of it is one
    projection: nothing is shuffled, no user function runs.
    """
    known = {k: template_bigrams(t) for k, t in sorted((templates or TEMPLATES).items())}
    known = {k: g for k, g in known.items() if g}
    none = F.array().cast("array<struct<d:double,k:string>>")
    every = sorted({b for g in known.values() for b in g})
    low = min((len(g) for g in known.values()), default=1) * threshold / (2 - threshold) - 1e-9
    high = max((len(g) for g in known.values()), default=0) * (2 - threshold) / threshold + 1e-9

    def compared(g: Column) -> Column:
        scores = []
        for k, t in known.items():
            fits = F.size(g).between(len(t) * threshold / (2 - threshold) - 1e-9, len(t) * (2 - threshold) / threshold + 1e-9)
            both = F.size(F.array_intersect(g, F.array(*map(F.lit, t))))
            scores.append(F.when(fits, F.struct((2.0 * both / (F.size(g) + len(t))).alias("d"), F.lit(k).alias("k"))))
        return F.filter(F.array_compact(F.array(*scores)), lambda s: s["d"] >= threshold)

    def of_unit(unit: Column) -> Column:
        return let(_bigrams(unit, high), lambda g: F.when(
            F.size(g).between(low, high) & F.arrays_overlap(g, F.array(*map(F.lit, every))), compared(g)).otherwise(none))

    probes: dict[str, set[str]] = {}
    for p in set().union(*[probe_bigrams(g, threshold) for g in known.values()]):
        probes.setdefault(max(p.split(), key=len), set()).add(p.replace(" ", "[^a-z0-9]+"))

    def probed(c: Column) -> Column:
        """Whether a lower-case text holds a probe; its longer word is looked for first."""
        tests = [F.contains(c, F.lit(word)) & c.rlike("|".join(sorted(p))) for word, p in sorted(probes.items())]
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    texts = need(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lower(F.coalesce("text", F.lit(""))).alias("low"))
    lines = F.split(F.col("text"), "\n")
    units = F.when(F.size(lines) > 1, F.concat(lines, F.array("text"))).otherwise(lines)
    units = F.filter(units, lambda u: let(F.lower(u), probed))
    hopeful = texts.select("doc_id", "text", probed(F.col("low")).alias("hopeful"))
    units = F.when(F.col("hopeful"), units).otherwise(F.array().cast("array<string>"))
    if not known:
        return texts.select("doc_id", *[F.lit(0).cast("long").alias(n) for n in ("n_matches", "n_templates")],
                            F.lit(None).cast("string").alias("license"), F.lit(None).cast("double").alias("dice"))
    sizes = {k: len(template_words((templates or TEMPLATES)[k])) for k in known}
    windows = F.when(F.col("hopeful"), _window_scores(F.col("text"), known, sizes, threshold)).otherwise(none)
    found = hopeful.select("doc_id", F.flatten(F.transform(units, of_unit)).alias("u"), windows.alias("v"))
    found = found.select("doc_id", F.size("u").cast("long").alias("n_matches"), F.concat("u", "v").alias("f"))
    best = F.coalesce(F.array_max(F.transform("f", lambda s: s["d"])), F.lit(-1.0))
    names = F.array_min(F.transform(F.filter("f", lambda s: s["d"] == best), lambda s: s["k"]))
    n_templates = F.size(F.array_distinct(F.transform("f", lambda s: s["k"])))
    return found.select("doc_id", "n_matches", n_templates.cast("long").alias("n_templates"), names.alias("license"),
                        F.when(best >= 0, best).alias("dice"))
