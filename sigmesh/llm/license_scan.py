"""License scans: MinHash bands over overlapping text windows, exact containment.

Templates are cut into windows of shingles (five words each) of two lengths,
and the MinHash bands of every window at every offset are kept in a small
table that travels with the task. A text is cut into overlapping windows of
the same lengths; a window that shares a band with a template retrieves it.

Settings: templates of fewer than ``LONG`` shingles are met by windows of a
single shingle, whose MinHash is the shingle itself, so any kept shingle
retrieves them with certainty. Longer ones are met by windows of 8 shingles
every 4 shingles: a whole copy always holds a whole window (the same bands
for certain), and a window that agrees with a template's window on 80 % of
their shingles shares one of 16 bands of 2 rows with a chance over 0.9999.

A retrieved template is verified exactly around its window: at least 80 % of
its distinct shingles must lie in one stretch of the text of at most 1.25
times its length.

Defined cases: null and empty texts have no match; a text matches a template
several times at several places (counted as occurrences); repeated rows match
each; templates of fewer than five words are one shingle; an empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import textkit
from .common import documents, ship_package

SHINGLE = 5
CONTAINED = 0.8
LONG = 12
WINDOW, STRIDE = 8, 4
BANDS, ROWS = 16, 2
STRETCH = 1.25

# Wording of public licenses, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

_RNG = np.random.default_rng(90210)
_MUL = (_RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_ADD = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_EDGE = np.zeros(256, dtype=bool)
_EDGE[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def shingles(chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes in order, the first of each text (one more at the end), and each text's words.

    Words are lower-cased, without punctuation at their ends; a text of fewer than five words is one shingle.
    """
    starts, ends, first = chunk.words()
    for _ in range(3):
        ends = ends - ((ends - starts > 1) & _EDGE[chunk.buf[ends - 1]])
        starts = starts + ((ends - starts > 1) & _EDGE[chunk.buf[starts]])
    h = chunk.spans(chunk.sums(textkit.LOWER), starts, ends)
    pos, begin = textkit.windows(first, SHINGLE)
    return textkit.combine(h, pos, SHINGLE), begin, np.diff(first)


def band_keys(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Keys (windows x bands) of the windows of ``size`` shingles that begin at ``at``."""
    low = np.empty((len(at), BANDS * ROWS), dtype=np.uint32)
    short = (h >> np.uint64(32)).astype(np.uint32)
    for i in range(BANDS * ROWS):
        x = short * _MUL[i] + _ADD[i]
        best = x[at]
        for j in range(1, size):
            best = np.minimum(best, x[at + j])
        low[:, i] = best
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(at), BANDS)).copy()
    for r in range(ROWS):
        key = textkit.mix(key ^ low[:, r::ROWS].astype(np.uint64), r + 1)
    return key


class Templates:
    """Sets of the templates, and the keys by which windows retrieve them."""

    def __init__(self, templates=TEMPLATES):
        self.names = [n for n, _ in templates]
        self.sets, keys, owners, singles, single_owners = [], [], [], [], []
        for i, (_, text) in enumerate(templates):
            c = next(textkit.chunks(pa.array([text])))
            h, _, _ = shingles(c)
            self.sets.append(np.unique(h))
            if len(h) >= LONG:
                k = band_keys(h, np.arange(len(h) - WINDOW + 1), WINDOW).reshape(-1)
                keys.append(np.unique(k))
                owners.append(np.full(len(keys[-1]), i))
            else:
                singles.append(self.sets[-1])
                single_owners.append(np.full(len(singles[-1]), i))
        self.keys, self.owners = self._sorted(keys, owners)
        self.singles, self.single_owners = self._sorted(singles, single_owners)

    @staticmethod
    def _sorted(keys, owners):
        k = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        o = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(k, kind="stable")
        return k[order], o[order]

    @staticmethod
    def _hits(values: np.ndarray, keys: np.ndarray, owners: np.ndarray) -> list[tuple[int, int]]:
        """(place in ``values``, template) of every value among ``keys``."""
        a, b = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
        return [(int(i), int(o)) for i in np.flatnonzero(b > a) for o in owners[a[i]:b[i]]]

    @classmethod
    def _stretches(cls, h: np.ndarray, want: np.ndarray, reach: int, lo: int, hi: int) -> list[tuple[int, int, int]]:
        """(shingles of ``want``, first, last) of the best stretch in a range of shingles, and of those before it.

        Of the stretches that hold as many, the shortest, then the first; what follows it is left to later windows.
        """
        hit = np.flatnonzero(np.isin(h[lo:hi], want)) + lo if hi > lo else np.zeros(0, np.int64)
        best = (0, 0, 0)
        for i, a in enumerate(hit):
            inside = hit[i:np.searchsorted(hit, a + reach)]
            new = np.unique(h[inside], return_index=True)[1]
            n, last = len(new), int(inside[new.max()])
            if n > best[0] or n == best[0] and last - a < best[2] - best[1]:
                best = (n, int(a), last)
        if not best[0] or best[0] < CONTAINED * len(want):
            return []
        return [*cls._stretches(h, want, reach, lo, best[1] - SHINGLE + 1), best]

    def matches(self, h: np.ndarray, begin: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(text, template, first word, end word, containment) of all verified places, for the texts of a chunk."""
        found: dict[tuple[int, int], list[int]] = {}
        text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        for at, t in self._hits(h, self.singles, self.single_owners):
            found.setdefault((int(text[at]), t), []).append(at)
        pos, _ = textkit.windows(begin, WINDOW)
        pos = pos[(pos - begin[text[pos]]) % STRIDE == 0] if len(pos) else pos
        if len(pos):
            keys = band_keys(h, pos, WINDOW)
            for at, t in self._hits(keys.reshape(-1), self.keys, self.owners):
                w = int(pos[at // BANDS])
                found.setdefault((int(text[w]), t), []).append(w)
        out = []
        for (d, t), places in sorted(found.items()):
            done = -1
            want = self.sets[t]
            reach = max(len(want), int(np.ceil(len(want) * STRETCH)))
            for w in sorted(set(places)):
                if w <= done:
                    continue
                lo, hi = max(begin[d], w - reach), min(begin[d + 1], w + reach + WINDOW)
                for n, first, last in self._stretches(h, want, reach, max(lo, done + SHINGLE) if done >= 0 else lo, hi):
                    done = last
                    out.append((d, t, first - int(begin[d]), last - int(begin[d]) + SHINGLE, n / len(want)))
        # of templates that overlap, the one that is contained best stays, then the longest
        kept: dict[int, list[tuple[int, int, int, int, float]]] = {}
        for m in sorted(out, key=lambda m: (m[0], -m[4], -len(self.sets[m[1]]), m[1], m[2])):
            if all(m[3] <= k[2] or m[2] >= k[3] for k in kept.setdefault(m[0], [])):
                kept[m[0]].append(m)
        return [m for d in sorted(kept) for m in sorted(kept[d], key=lambda m: m[2:4])]


@lru_cache(maxsize=4)
def _templates(templates) -> Templates:
    return Templates(templates)


def license_matches(spark: SparkSession, docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per match: doc_id, license, template, first_word, end_word, containment."""
    ship_package(spark)
    templates = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _templates(templates)
        for b in batches:
            ids = b.column("doc_id")
            for c in textkit.chunks(b.column("text"), 1 << 20):
                h, begin, _ = shingles(c)
                m = t.matches(h, begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[c.lo + x[0]].as_py() for x in m], pa.int64()), pa.array([t.names[x[1]] for x in m], pa.string()),
                     pa.array([x[1] for x in m], pa.int32()), pa.array([x[2] for x in m], pa.int64()),
                     pa.array([x[3] for x in m], pa.int64()), pa.array([x[4] for x in m], pa.float64())],
                    names=["doc_id", "license", "template", "first_word", "end_word", "containment"])

    return documents(docs).mapInArrow(run, "doc_id long, license string, template int, first_word long, end_word long, containment double")
