"""License scans (1): templates found by MinHash bands over overlapping windows. DataFrame functions only.

Texts and templates are reduced to lower-case words of letters and digits.  By
template size class c (a power of two that holds the template), a text is cut
to windows of 3c/2 words that start every c/2 words, so that any run of c words
lies in one window.  A window's word shingles are minhashed ``bands`` times, and
a window that shares a value with a template in any band is a candidate.  A
template of which a share t of the shingles stands in a window has a Jaccard
similarity of at least about t/6 with it (a template fills more than half of
its class), a typical one t/2, so ``bands`` of one row each meet with
probability 1 - (1 - j)**bands.  Candidates are verified by exact shingle
containment.

Windows without any of the templates' key words are not hashed: key words are
chosen so that every containment of ``threshold`` needs one of them, which is
exact and not a heuristic.

Defined cases: null, empty and wordless texts match nothing and give no row;
the result has a row per document and template, the best window's; rows that
repeat an id are matched as one document; a null id is an id; templates of
fewer words than a shingle have one shingle, the whole; extra columns never
enter.  The template table is a parameter of bounded size: it is held by the
driver and broadcast up to ``most_broadcast`` band rows; beyond, Spark joins it as it
sees fit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only

# FIXED VALUES: notices as their authors publish them
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                      "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                      "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                         "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                      "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                    "conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}


@dataclass(frozen=True)
class Scan:
    shingle: int = 3
    bands: int = 48
    threshold: float = 0.8
    least_class: int = 4          # so that a template of three words or more fills more than half of its class
    most_broadcast: int = 200_000   # band rows of the templates up to which their tables are broadcast


def template_words(text: str) -> list[str]:
    """Lower-case runs of letters and digits (templates are ASCII)."""
    return re.findall(r"[a-z0-9]+", text.lower())


def template_shingles(words: list[str], k: int) -> list[str]:
    return sorted({" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}) if len(words) >= k else [" ".join(words)]


def size_class(n: int, s: Scan) -> int:
    c = s.least_class
    while c < n:
        c *= 2
    return c


def key_words(templates: list[list[str]], s: Scan) -> list[str]:
    """Words without which no template can reach the threshold, few of them (greedy)."""
    def open_(sh, keys):
        free = [x for x in sh if not keys & set(x.split())]
        return len(free) >= s.threshold * len(sh)
    sets = [template_shingles(t, s.shingle) for t in templates]
    keys: set[str] = set()
    while left := [x for x in sets if open_(x, keys)]:
        gain: dict[str, float] = {}
        for x in left:
            for w in {w for y in x for w in y.split()}:
                # long words are rare: prefer them among those that hit as many shingles
                gain[w] = gain.get(w, 0) + sum(w in y.split() for y in x if not keys & set(y.split())) / len(x) * len(w)
        keys.add(max(sorted(gain), key=lambda w: gain[w]))
    return sorted(keys)


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _shingles(words: str, k: int) -> Column:
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice(words, i, k), " "))
    return F.array_distinct(F.when(n >= k, many).otherwise(F.array(F.array_join(words, " "))))


def _minhash(shingles: str, bands: int) -> Column:
    """Least hash of each band: one row a band."""
    hashed = F.transform(shingles, lambda x: F.xxhash64(x))
    return F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda b: F.array_min(F.transform(hashed, lambda h: F.xxhash64(h, b))))


def _windows(c: int, keys: list[str]) -> Column:
    """Windows of size class c over the words ``w`` that hold a key word."""
    first = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - c // 2 - 1), F.lit(c // 2))
    win = F.transform(first, lambda i: F.struct(F.lit(c).alias("cls"), i.alias("first"), F.slice("w", i + 1, 3 * c // 2).alias("words")))
    return F.filter(win, lambda y: F.arrays_overlap(y["words"], F.array(*map(F.lit, keys))))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, s: Scan = Scan(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, license_id, containment, matched (shingles), shingles (of the template), first_word, n_windows."""
    spark = docs.sparkSession
    words = {k: template_words(v) for k, v in (templates if templates is not None else TEMPLATES).items()}
    words = {k: v for k, v in words.items() if v}
    by: dict[int, list[str]] = {}
    for name, w in words.items():
        by.setdefault(size_class(len(w), s), []).append(name)
    table = spark.createDataFrame([(n, c, template_shingles(words[n], s.shingle)) for c, names in by.items() for n in names],
                                  "license_id string, cls int, want array<string>")
    bands = table.select("license_id", "cls", F.posexplode(_minhash("want", s.bands)).alias("band", "value"))

    d = only(docs, **{"doc_id": id_col, "text": text})
    keys = {c: key_words([words[n] for n in names], s) for c, names in by.items()}
    every = sorted({k for v in keys.values() for k in v})
    hit = F.lit(False)
    for k in every:
        hit = hit | F.contains(F.lower("text"), F.lit(k))
    d = d.where(hit).select("doc_id", _words(F.col("text")).alias("w"))
    # windows of every class in one pass over the words
    kinds = [_windows(c, keys[c]) for c in sorted(keys)]
    if not kinds:
        return d.selectExpr("doc_id", "cast(null as string) license_id", "cast(null as double) containment", "0 matched", "0 shingles", "0 first_word", "0L n_windows").where("false")
    win = d.select("doc_id", F.explode(F.flatten(F.array(*kinds))).alias("x")).select("doc_id", "x.*")
    win = win.select("doc_id", "cls", "first", _shingles("words", s.shingle).alias("have"))
    cand = win.select("doc_id", "cls", "first", "have", F.posexplode(_minhash("have", s.bands)).alias("band", "value"))
    # one band that meets is enough. Shingles are joined to the few candidates only, by the template's name
    want = table.select("license_id", "want")
    if len(words) * s.bands <= s.most_broadcast:  # both tables follow the parameter, not the data
        bands, want = F.broadcast(bands), F.broadcast(want)
    cand = cand.join(bands, ["cls", "band", "value"]).join(want, "license_id")
    both = F.size(F.array_intersect("have", "want"))
    ok = cand.withColumn("matched", both).where(F.col("matched") >= F.lit(s.threshold) * F.size("want"))
    best = ok.groupBy("doc_id", "license_id").agg(
        F.max(F.struct("matched", (-F.col("first")).alias("back"))).alias("m"), F.first(F.size("want")).alias("shingles"), F.count_distinct("first").alias("n_windows"))
    return best.select("doc_id", "license_id", (F.col("m.matched") / F.col("shingles")).alias("containment"), F.col("m.matched").alias("matched"), "shingles",
                       (-F.col("m.back")).alias("first_word"), "n_windows")
