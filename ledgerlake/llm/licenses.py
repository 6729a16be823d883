"""License scan: MinHash bands over overlapping windows, then exact containment.

Notices are word templates. Templates of similar length form a class of
windows: a class whose longest template has ``m`` shingles slides windows of
``3m`` shingles by ``m``, so every occurrence spread over at most ``2m``
shingles lies whole in some window, at any place in the text: words put into a
notice may stretch it by the ``m`` shingles of the longest template. (Templates
of one shingle can't be stretched: windows of 2 by 1.) A window that holds
``threshold`` of a template's shingles has a Jaccard similarity of at least
``threshold * m_min / (3m + (1 - threshold) * m_min)`` with it. The number of
one-row bands follows from that: the chance of missing all bands is at most
``MISS``. Retrieved (window, template) pairs are verified by the exact share of
the template's shingles in the window.

Only DataFrame functions run. A sound test comes first: each template has
words (``anchors``) that more than 1 - threshold of its shingles hold, so a
text or window without any anchor cannot reach the threshold.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
THRESHOLD = 0.8
MISS = 1e-4

# License notices as they are written in texts.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
]


def template_words(text: str) -> list[str]:
    """Lower-case ASCII words of letters and digits, as ``_words`` cuts them."""
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def template_shingles(text: str, k: int = SHINGLE) -> list[str]:
    w = template_words(text)
    return sorted({" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))})


def _words(text: Column) -> Column:
    # Only ASCII letters and digits make words; ``lower`` may change other letters, which separate either way.
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def anchors(templates: list[tuple[str, str]], k: int = SHINGLE, threshold: float = THRESHOLD) -> list[str]:
    """Words such that, of each template, the shingles without any are less than the threshold share."""
    corpus = [template_words(t) for _, t in templates]
    rare = {w: sum(w in c for c in corpus) for c in corpus for w in c}
    chosen: set[str] = set()
    for _, text in templates:
        sh = [set(s.split()) for s in template_shingles(text, k)]
        while sum(not (s & chosen) for s in sh) >= threshold * len(sh):
            bare = [s for s in sh if not (s & chosen)]
            every = {w for s in bare for w in s}
            # most shingles first, then the longer word: it is rarer in running text
            chosen.add(max(every, key=lambda w: (len(w) > 5, sum(w in s for s in bare), len(w), -rare[w], w)))
    return sorted(chosen)


def bands_for(similarity: float, miss: float = MISS) -> int:
    """One-row bands so that a pair of this Jaccard similarity is missed with at most this chance."""
    return 1 if similarity >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - similarity)))


def classes(templates: list[tuple[str, str]], k: int = SHINGLE, threshold: float = THRESHOLD) -> list[dict]:
    """Window classes: templates whose shingle counts are within a factor of two, each with its own
    word width (a template of fewer words than a shingle is one shingle of that width)."""
    out: dict[tuple[int, int], dict] = {}
    for t, (name, text) in enumerate(templates):
        width = min(k, len(template_words(text)))
        sh = template_shingles(text, k)
        c = out.setdefault((width, len(sh).bit_length()), {"width": width, "items": [], "low": len(sh), "high": len(sh)})
        c["items"].append((t, name, sh))
        c["low"], c["high"] = min(c["low"], len(sh)), max(c["high"], len(sh))
    for c in out.values():
        # A window has ``span`` shingles and starts every ``high``: some window holds any run of span - high shingles.
        c["span"] = 3 * c["high"] if c["high"] > 1 else 2
        c["bands"] = bands_for(threshold * c["low"] / (c["span"] + (1 - threshold) * c["low"]))
    return [out[key] for key in sorted(out)]


def _window_class(words: DataFrame, spec: dict, marks: list[str], threshold: float) -> DataFrame:
    spark = words.sparkSession
    width, step, bands = spec["width"], spec["high"], spec["bands"]
    span = spec["span"] + width - 1  # words of a window
    items = spark.createDataFrame([(t, name, sh) for t, name, sh in spec["items"]],
                                  "template int, license string, wanted array<string>")
    key = lambda arr, b: F.array_min(F.transform(arr, lambda s: F.xxhash64(s, F.lit(b))))
    sign = lambda arr: F.array(*[key(arr, b) for b in range(bands)])
    wanted = items.withColumn("sig", sign(F.col("wanted"))).select(
        "template", "license", "wanted", F.posexplode("sig").alias("band", "key"))
    last = F.greatest(F.size("w") - width, F.lit(0))
    windows = (
        words.filter(F.size("w") >= width)
        .withColumn("start", F.explode(F.sequence(F.lit(0), last, F.lit(step))))
        .withColumn("part", F.slice("w", F.col("start") + 1, span))
        .filter(F.arrays_overlap("part", F.array(*map(F.lit, marks))) & (F.size("part") >= width))
        .select("doc_id", "row", "start", "part")
        .withColumn("sh", F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size("part") - width + 1),
            lambda i: F.array_join(F.slice(F.col("part"), i, width), " "))))
    )
    signed = windows.select("doc_id", "row", "start", "sh", F.posexplode(sign(F.col("sh"))).alias("band", "key"))
    # The template table is a fixed list: broadcast.
    met = signed.join(F.broadcast(wanted), ["band", "key"]).dropDuplicates(["doc_id", "row", "start", "template"])
    found = met.withColumn("n_found", F.size(F.array_intersect("sh", "wanted"))).filter(
        F.col("n_found") >= threshold * F.size("wanted"))
    return found.select("doc_id", "row", "license", "template", "start", F.col("n_found").cast("long").alias("n_found"),
                        F.size("wanted").cast("long").alias("n_shingles"))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, k: int = SHINGLE,
                  threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, template, n_found, n_shingles, containment, n_places, first_word).

    One row per document and template of which some window holds at least
    ``threshold`` of the shingles: the best window, the number of windows that
    qualify, and the word at which the first of them starts. Null and empty
    texts have no match; rows of one doc_id with different texts are told
    apart only in ``n_places``. A null doc_id is reported as null.
    """
    marks = anchors(templates, k, threshold)
    text = F.lower(F.coalesce("text", F.lit("")))
    words = docs.select("doc_id", "text").filter(text.rlike("|".join(marks))).select(
        "doc_id", F.xxhash64("text").alias("row"), _words(F.col("text")).alias("w"))
    out = None
    for spec in classes(templates, k, threshold):
        part = _window_class(words, spec, marks, threshold)
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc_id", "license", "template").agg(
        F.max("n_found").alias("n_found"), F.max("n_shingles").alias("n_shingles"),
        F.count("*").alias("n_places"), F.min("start").cast("long").alias("first_word")).withColumn(
        "containment", F.col("n_found") / F.col("n_shingles"))
