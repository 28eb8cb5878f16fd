"""License scans: MinHash bands over text windows find templates, shingles confirm them.

A text is cut into overlapping windows of ``WINDOW`` words, every ``STRIDE`` words, and a
template into pieces short enough that each lies whole within some window. Windows and
pieces are sets of word pairs; per band the pair nearest to that band's point of the
64-bit space is the set's minimum, which two sets share with a probability equal to their
similarity. With ``BANDS`` bands of one row, a window that holds a piece of five words (4 of
15 pairs) meets it with probability 0.998, one that holds a piece of eight words with
0.999997 (``collision_probability``), and a long template has many pieces. A retrieved
template counts if the text has 80 percent or more of its five-word shingles.

All of it happens in the row, in built-in expressions: no shuffle, no Python.

Defined results: null, empty and very short texts have no license; very long texts are
scanned whole in their row; repeated rows are scanned alike; an empty table stays empty;
extra columns are kept, those named like a result are replaced. Templates of fewer than
five words are an error.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm.common import bound, number, numbered, restored

WINDOW, STRIDE, BANDS, SHINGLE = 16, 8, 20, 5
#: Share of a template's shingles that a text must have, in percent.
CONTAINED = 80
SEPARATORS = "[^\\p{L}\\p{N}]+"

# Notices of public licenses as their authors publish them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)


def collision_probability(similarity: float, bands: int = BANDS) -> float:
    """That two sets of this Jaccard similarity share a band."""
    return 1 - (1 - similarity) ** bands


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^0-9a-z]+", text.lower()) if w]


def pieces(words: list[str]) -> list[list[str]]:
    """Pieces of at most WINDOW - STRIDE words, of which some window holds each whole."""
    size = min(len(words), WINDOW - STRIDE)
    starts = sorted({*range(0, len(words) - size + 1, size), len(words) - size})
    return [words[s : s + size] for s in starts]


def band_points() -> list[int]:
    """One point of the space per band, by a fixed rule."""
    out, x = [], 0
    for _ in range(BANDS):
        x = (x + 0x9E3779B97F4A7C15) & (2**64 - 1)
        y = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        out.append((y ^ (y >> 27)) - 2**63)
    return out


def _runs_of(words: str, n: int) -> str:
    of = ", ".join(f"get({words}, i + {k})" for k in range(n))
    return f"if(size({words}) >= {n}, transform(sequence(0, size({words}) - {n}), i -> xxhash64({of})), cast(array() as array<bigint>))"


def _minima(pairs: str, starts: str) -> str:
    """The minimum of each window in the band of point ``p``."""
    return f"transform({starts}, s -> array_min(transform(slice({pairs}, s, {WINDOW - 1}), x -> x ^ p)))"


def _numbers(values) -> str:
    """A constant array as SQL; a column of constants would be copied with every row."""
    return "array(" + ", ".join(f"cast('{v}' as bigint)" for v in values) + ")"


class Templates:
    """Templates prepared for scans. Their number is the caller's, and a constant of the plan."""

    def __init__(self, spark: SparkSession, templates=TEMPLATES):
        words = [template_words(text) for _, text in templates]
        if any(len(w) < SHINGLE for w in words):
            raise ValueError(f"a template has fewer than {SHINGLE} words")
        self.ids = [license_id for license_id, _ in templates]
        parts = [(t, piece) for t, w in enumerate(words) for piece in pieces(w)]
        rows = spark.createDataFrame([(t, p) for t, p in parts], "t int, words array<string>")
        self.points = _numbers(band_points())
        rows = rows.select("t", F.expr(_runs_of("words", 2)).alias("pairs"))
        found = rows.select("t", "pairs", F.expr(f"transform({self.points}, p -> {_minima('pairs', 'array(1)')})").alias("m")).collect()
        self.pairs = sorted({p for r in found for p in r["pairs"]})
        #: (template, band, minimum) of all pieces.
        self.bands = sorted({(r["t"], k, v[0]) for r in found for k, v in enumerate(r["m"])})
        whole = spark.createDataFrame(list(enumerate(words)), "t int, words array<string>")
        shingles = whole.select("t", F.expr(f"array_distinct({_runs_of('words', SHINGLE)})").alias("s")).collect()
        self.shingles = [r["s"] for r in sorted(shingles, key=lambda r: r["t"])]

    def window_starts(self) -> str:
        """The places of the windows that hold a word pair of some piece. Any other window has
        no minimum in common with a piece, in any band, and is left out at once."""
        pairs = ", ".join(f"cast('{p}' as bigint)" for p in self.pairs)
        start = f"cast(i div {STRIDE} as int) * {STRIDE} + 1"
        # Pair i lies in the window of its own stride and, if not the last of it, in the one before.
        both = f"if(i >= {STRIDE} and i % {STRIDE} < {WINDOW - 1 - STRIDE}, array({start}, {start} - {STRIDE}), array({start}))"
        hits = f"filter(sequence(0, size(_pairs) - 1), i -> get(_pairs, i) in ({pairs}))"
        return f"if(size(_pairs) > 0, array_distinct(flatten(transform({hits}, i -> {both}))), cast(array() as array<int>))"

    def band_minima(self) -> str:
        """Per band the minima of all pieces."""
        return "array(" + ", ".join(_numbers(sorted({v for _, k, v in self.bands if k == b})) for b in range(BANDS)) + ")"

    def band_rows(self) -> str:
        """(template, band, minimum) of all pieces."""
        columns = (_numbers(r[c] for r in self.bands) for c in range(3))
        return "transform(arrays_zip({}, {}, {}), z -> struct(z.`0` as t, z.`1` as band, z.`2` as value))".format(*columns)

    def shingle_rows(self) -> str:
        return "array(" + ", ".join(map(_numbers, self.shingles)) + ")"


def scanned(df: DataFrame, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """``df`` with ``n_words``, ``n_windows``, ``n_candidates``, ``n_licenses`` and ``licenses``."""
    known = Templates(df.sparkSession, templates)
    df, names = numbered(df)
    split = F.array_remove(F.split(F.lower(F.coalesce(F.col(number(names, text)), F.lit(""))), SEPARATORS, -1), "")
    df = bound(df, "_words", split)
    df = bound(df, "_pairs", F.expr(_runs_of("_words", 2)))
    df = bound(df, "_starts", F.expr(known.window_starts()))
    met = (
        f"flatten(transform({known.points}, (p, k) -> transform(array_intersect({_minima('_pairs', '_starts')},"
        f" get({known.band_minima()}, k)), v -> struct(k as band, v as value))))"
    )
    df = bound(df, "_met", F.when(F.size("_starts") > 0, F.expr(met)))
    mine = F.expr(
        f"array_distinct(transform(filter({known.band_rows()}, r -> exists(_met, m -> m.band = r.band and m.value = r.value)), r -> r.t))"
    )
    none = F.array().cast("array<bigint>")
    df = bound(df, "_candidates", F.when(F.size("_met") > 0, mine).otherwise(none))
    df = bound(df, "_shingles", F.when(F.size("_candidates") > 0, F.expr(_runs_of("_words", SHINGLE))).otherwise(none))
    templates = known.shingle_rows()
    verified = F.expr(
        f"filter(_candidates, t -> 100 * size(array_intersect(get({templates}, cast(t as int)), _shingles))"
        f" >= {CONTAINED} * size(get({templates}, cast(t as int))))"
    )
    df = bound(df, "_found", F.when(F.size("_candidates") > 0, verified).otherwise(none))
    names_of = F.array(*[F.lit(i) for i in known.ids])
    ids = F.sort_array(F.array_distinct(F.transform("_found", lambda t: F.get(names_of, t.cast("int")))))
    results = {
        "n_words": F.size("_words").cast("long"), "n_windows": F.ceil(F.size("_pairs") / STRIDE).cast("long"),
        "n_candidates": F.size("_candidates").cast("long"), "n_licenses": F.size(ids).cast("long"), "licenses": F.array_join(ids, ","),
    }
    return restored(df.withColumns(results), names, *results)
