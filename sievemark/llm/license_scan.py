"""License notices in texts, by MinHash bands over overlapping windows.

Everything runs in DataFrame expressions. A text is its lower-case words, and
those are 5-word shingles. Templates of like length form a class; for each class
the text is cut into overlapping windows of one and a half times that length. A
window's MinHash is of one permutation: the range of hashes is cut into ``BANDS``
equal bands, and the smallest hash in each band is that band's value. A window and
a template of its class with one band value in common meet. Then the template's
shingles are counted exactly in each window of the text, and those with ``CONTAINED`` of them are matches. What a template that is
whole in a window, or to four fifths, is missed with is bounded by ``miss``. The
window of a template of one shingle is one shingle, which is its only band value.

Texts that share no shingle with any template are left out before any window is cut;
they can match nothing.

Templates are constants of the plan, so their number is checked.

Defined results: a null or empty text matches nothing; a template of fewer than five
words is refused. Repeated rows each have their matches; ties between templates are
all reported, in order of their names; an empty table gives an empty result. Columns
of the input pass through, whatever their names, but for ``matches``, which is replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import fresh, quoted
from .license_texts import WHOLE

WORDS, CONTAINED, BANDS = 5, 0.8, 32
_BAND_SHIFT = 59  # 64 bits less the 5 of a band's number
#: Shingles that the templates may have together: they are constants of the plan.
MOST_SHINGLES = 50_000

#: Short notices and first sentences of public licenses, and the whole text of short ones. A notice
#: of up to four shingles matches only whole, so that versions and variants differ.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed-notice": "Licensed under the MIT License.",
    "bsd-notice": "Licensed under the BSD License.",
    "bsd-2-clause-notice": "Licensed under the BSD-2-Clause License.",
    "bsd-3-clause-notice": "Licensed under the BSD-3-Clause License.",
    "isc-notice": "Licensed under the ISC License.",
    "gpl-notice": "Licensed under the GNU General Public License",
    "lgpl-notice": "Licensed under the GNU Lesser General Public License",
    "agpl-notice": "Licensed under the GNU Affero General Public License",
    "mpl-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "epl-2.0-notice": "Licensed under the Eclipse Public License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
}
#: The Creative Commons licenses, by their short notice and their full name.
for _short, _full in {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items():
    TEMPLATES[f"cc-{_short.lower()}-4.0-notice"] = f"Licensed under CC {_short} 4.0."
    TEMPLATES[f"cc-{_short.lower()}-4.0-name"] = f"Creative Commons {_full} 4.0 International"
TEMPLATES |= WHOLE


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(text: Column) -> Column:
    """Hashes of the 5-word shingles, in order; none for fewer words."""
    def bind(hashed: Column) -> Column:
        parts = [lambda i, k=k: F.get(hashed, i + k) for k in range(WORDS)]
        return F.when(F.size(hashed) >= WORDS, F.transform(F.sequence(F.lit(0), F.size(hashed) - WORDS), lambda i: F.xxhash64(*(p(i) for p in parts)))).otherwise(F.array().cast("array<long>"))

    each = F.transform(words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w))
    # The array of one makes the hashed words a variable, evaluated once.
    return F.element_at(F.transform(F.array(each), bind), 1)


def windows(size: int) -> tuple[int, int]:
    """(width, step) in shingles for templates of up to ``size``: whatever its
    place, a template is whole in one window."""
    step = max(1, size // 2)
    return (size + step if size > 1 else 1), step


def _cut(hashes: Column, width: int, step: int) -> Column:
    """The windows of a text, each the array of its hashes; the last may be shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(hashes), F.lit(1)), F.lit(step))
    return F.transform(starts, lambda s: F.slice(hashes, s, width))


def band_values(hashes: Column, width: int, step: int) -> Column:
    """Band values of all windows: in order of size, the first hash of each band."""
    if width == 1:
        return hashes
    ordered = F.transform(_cut(hashes, width, step), lambda w: F.sort_array(w))
    band = lambda x: F.shiftrightunsigned(x, _BAND_SHIFT)
    first = lambda w: F.filter(w, lambda x, i: (i == 0) | (band(x) != band(F.get(w, i - 1))))
    return F.flatten(F.transform(ordered, first))


def miss(size: int, contained: float = CONTAINED) -> float:
    """The chance that a template of ``size`` shingles, of which a share ``contained``
    is in a window, has no band value in common with it, if hashes are random.

    Window and template agree in a band if the smallest of all their hashes there is a
    shared one. Which shingles are smallest in the k bands that hold any is then a
    random choice of k, and how many bands hold any follows from dealing them one by one.
    """
    width, _ = windows(size)
    if width == 1:
        return 0.0
    shared = max(1, -int(-contained * size // 1))
    every = width + size - shared
    filled = [1.0] + [0.0] * BANDS
    for _ in range(every):
        filled = [filled[k] * k / BANDS + (filled[k - 1] * (BANDS - k + 1) / BANDS if k else 0.0) for k in range(BANDS + 1)]
    lost, none_shared = 0.0, 1.0
    for k in range(1, min(BANDS, every) + 1):
        none_shared *= max(0, every - shared - k + 1) / (every - k + 1)
        lost += filled[k] * none_shared
    return lost


def _classes(sizes: list[int]) -> list[int]:
    """Class sizes: the largest of each run of sizes within a third of it."""
    out: list[int] = []
    for n in sorted(set(sizes), reverse=True):
        if not out or n < 0.7 * out[-1]:
            out.append(n)
    return out


def prepared(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """Each template's shingles, class and band values, by the expressions used on texts."""
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string").select("name", F.array_distinct(shingle_hashes(F.col("text"))).alias("shingles")).collect()
    if any(not r["shingles"] for r in rows):
        raise ValueError(f"a template needs at least {WORDS} words")
    classes = _classes([len(r["shingles"]) for r in rows])
    out = []
    for r in rows:
        size = min(c for c in classes if c >= len(r["shingles"]))
        values = {}
        for x in sorted(r["shingles"], reverse=True):
            values[(x % (1 << 64)) >> _BAND_SHIFT] = x
        out.append({"name": r["name"], "size": size, "shingles": list(r["shingles"]), "bands": list(r["shingles"]) if windows(size)[0] == 1 else list(values.values())})
    if sum(len(t["shingles"]) for t in out) > MOST_SHINGLES:
        raise ValueError(f"the templates have more than {MOST_SHINGLES} shingles")
    return out


def _literal(value: list, kind: str) -> Column:
    """A constant of the plan, folded once, so that the plan does not grow with the templates."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan(df: DataFrame, templates: dict[str, str] | None = None, text: str = "text") -> DataFrame:
    """``df`` with ``matches``: array<struct<license, first_word, containment>>,
    one for each template that is contained, at its best window."""
    known = prepared(df.sparkSession, templates or TEMPLATES)
    sizes = sorted({t["size"] for t in known})
    kept = [quoted(c) for c in df.columns if c.lower() != "matches"]
    hashes, shares, *met = fresh(df, "hashes", "shares", *(f"met{n}" for n in sizes))
    asked = _literal(sorted({x for t in known for x in t["shingles"]}), "array<bigint>")
    # Hash the text once; look at the windows of those that share a shingle with any template.
    hashed = df.select(*kept, shingle_hashes(quoted(text)).alias(hashes)).withColumn(shares, F.arrays_overlap(hashes, asked))
    for n, name in zip(sizes, met, strict=True):
        values = _literal(sorted({v for t in known if t["size"] == n for v in t["bands"]}), "array<bigint>")
        hashed = hashed.withColumn(name, F.when(F.col(shares), F.array_intersect(band_values(F.col(hashes), *windows(n)), values)))

    def matches(n: int, name: str) -> Column:
        """The templates of a class that meet, each at its best window."""
        width, step = windows(n)
        own = _literal([{k: t[k] for k in ("name", "shingles", "bands")} for t in known if t["size"] == n], "array<struct<name:string,shingles:array<bigint>,bands:array<bigint>>>")

        def best(t: Column) -> Column:
            share = lambda w: F.size(F.array_intersect(w, t["shingles"])) / F.size(t["shingles"]).cast("double")
            top = F.array_max(F.transform(_cut(F.col(hashes), width, step), lambda w, i: F.struct(share(w).alias("containment"), (-i * step).alias("place"))))
            return F.struct(t["name"].alias("license"), (-top["place"]).cast("int").alias("first_word"), top["containment"].alias("containment"))

        meet = F.filter(own, lambda t: F.arrays_overlap(F.col(name), t["bands"]))
        return F.when(F.size(name) > 0, F.filter(F.transform(meet, best), lambda m: m["containment"] >= CONTAINED))

    none = F.array().cast("array<struct<license:string,first_word:int,containment:double>>")
    found = F.sort_array(F.concat(*(F.coalesce(matches(n, name), none) for n, name in zip(sizes, met, strict=True))))
    return hashed.select(*kept, F.when(F.col(shares), found).otherwise(none).alias("matches"))
