"""License notices inside documents: MinHash bands over overlapping windows
retrieve templates, exact shingle containment verifies them.

Texts are lower-cased (A-Z), ASCII punctuation is read as white space, and words
form shingles of five (a template of fewer words is one shingle of its own
size and is matched as such). A template is looked up by windows of its size
class (of 5, 6, 7, ... growing by a fifth up to 256 the largest that leaves
room for a step), its own windows at the first offsets are indexed (of one of
more than 256 words, windows all over it), and
documents are covered by windows at a step of an eighth of that: up to 15
words, every word. A window's signature is the minima of `BANDS` x `ROWS` hash functions over
its shingles; windows that agree in all rows of a band are candidates. With 8
bands of 2 rows, two windows of Jaccard similarity 0.8 meet with probability
1 - (1 - 0.8^2)^8 = 0.9997, equal ones always.

A candidate counts if the passage of the template's length, with the step's
slack at either end, has `least` of the template's shingles.

One pass over the documents and no shuffle; templates are a short list
of texts (their bytes are checked against `TEMPLATE_BYTES`), sent to all tasks.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickguard.llm.common import fresh, map_texts, slabs
from clickguard.llm.decontaminate import LARGEST, SEGMENT, SHINGLE, placed, shingles, step
from clickguard.llm.words import WordHasher, mixed

BANDS, ROWS = 8, 2
TEMPLATE_BYTES = 16 << 20
_SLAB = 1 << 20
_PART = 1 << 15  # windows a step

#: Wordings of public licenses' notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                 "software and associated documentation files (the \"Software\"), to deal in the Software "
                 "without restriction, including without limitation the rights to use, copy, modify, merge, "
                 "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
                 "to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0-text", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                        "file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0-text", "This program is free software: you can redistribute it and/or modify it under the terms "
                     "of the GNU General Public License as published by the Free Software Foundation, either "
                     "version 3 of the License, or (at your option) any later version."),
    ("BSD-text", "Redistribution and use in source and binary forms, with or without modification, are "
                 "permitted provided that the following conditions are met:"),
    ("proprietary", "All rights reserved."),
    ("MIT-licensed", "Licensed under the MIT License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Licensed under the BSD License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
                 "without fee is hereby granted, provided that the above copyright notice and this permission "
                 "notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]

_U = np.uint64
_PLAIN = bytes(32 if chr(b) in string.punctuation else b for b in range(256))
_A = np.array([xxhash.xxh64_intdigest(bytes([i]), 8) | 1 for i in range(BANDS * ROWS)], _U)[:, None]
_B = np.array([xxhash.xxh64_intdigest(bytes([i]), 88) for i in range(BANDS * ROWS)], _U)[:, None]


def hasher() -> WordHasher:
    return WordHasher(_PLAIN)


def doubled(s: np.ndarray, most: int) -> dict[int, np.ndarray]:
    """Minima of the hash functions over 1, 2, 4, ... shingles from each."""
    out, w = {1: s * _A + _B}, 1
    while 2 * w <= most:
        last = out[w]
        out[2 * w] = np.minimum(last[:, :-w], last[:, w:]) if last.shape[1] > w else last[:, :0]
        w *= 2
    return out


def minima(levels: dict[int, np.ndarray], start: np.ndarray, m: int) -> np.ndarray:
    """[functions, windows] over m shingles from each start."""
    w = 1 << (m.bit_length() - 1)
    return np.minimum(levels[w][:, start], levels[w][:, start + m - w])


def band_keys(low: np.ndarray) -> np.ndarray:
    """[BANDS, windows]"""
    rows = low.reshape(BANDS, ROWS, -1)
    key = rows[:, 0]
    for r in range(1, ROWS):
        key = mixed(key) + rows[:, r]
    return mixed(key)


class Templates:
    """The templates by size class, each band's keys sorted."""

    def __init__(self, templates: list[tuple[object, str]]):
        if sum(len(t or "") for _, t in templates) > TEMPLATE_BYTES:
            raise ValueError("templates are a short list; scan with a part of them at a time")
        self.names, self.size, self.sets, self.tiny, found = [], [], [], {}, {}
        for (name, _), w in zip(templates, hasher()([t for _, t in templates])):
            if not len(w):
                continue
            k = len(self.names)
            self.names.append(name)
            self.size.append(len(w))
            if len(w) < SHINGLE:  # too short for a window: the words in a row
                self.sets.append(None)
                self.tiny[k] = w
                continue
            s, (c, off) = shingles(w), placed(len(w))
            self.sets.append(np.unique(s))
            m = c - SHINGLE + 1
            keys = band_keys(minima(doubled(s, m), off, m))
            found.setdefault(c, []).append((keys, np.full(len(off), k), off))
        self.size = np.array(self.size, np.int64)
        self.classes = {}
        for c, parts in found.items():
            keys = np.concatenate([p[0] for p in parts], axis=1)
            name, off = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
            bands = []
            for k in keys:
                seen = np.zeros(1 << 16, bool)
                seen[(k >> _U(48)).astype(np.int64)] = True
                order = np.argsort(k)
                bands.append((seen, k[order], order))
            self.classes[c] = name, off, bands

    def lookup(self, c: int, keys: np.ndarray):
        """(window, indexed window) pairs with a band in common."""
        name, _, bands = self.classes[c]
        rows, hits = [], []
        for key, (seen, mine, order) in zip(keys, bands):
            at = np.flatnonzero(seen[(key >> _U(48)).astype(np.int64)])
            lo, hi = np.searchsorted(mine, key[at], "left"), np.searchsorted(mine, key[at], "right")
            n = hi - lo
            rows.append(np.repeat(at, n))
            hits += [order[a:b] for a, b in zip(lo[n > 0], hi[n > 0])]
        return np.concatenate(rows), np.concatenate(hits) if hits else np.zeros(0, np.int64)


def _search(t: Templates, words: list[np.ndarray], least: float):
    n = np.array([len(w) for w in words], np.int64)
    w = np.concatenate(words) if words else np.zeros(0, _U)
    best: dict = {}

    def keep(k, value):
        best[k] = min(best.get(k, (0.0, 0)), value)

    text = np.repeat(np.arange(len(n)), n)
    end = np.cumsum(n)
    begin = end - n
    for k, mine in t.tiny.items():
        z = len(w) - len(mine) + 1
        if z > 0:
            same = np.all([w[i:i + z] == x for i, x in enumerate(mine)], axis=0)
            for p in np.flatnonzero(same & (text[:z] == text[len(mine) - 1:])):
                keep((int(text[p]), k), (-1.0, int(p - begin[text[p]])))
    s = shingles(w)
    if not len(s):
        return best
    todo = set()

    def candidates(c, near, start, keys):
        row, hit = t.lookup(c, keys)
        name, off, _ = t.classes[c]
        of = text[start[row]]
        todo.update(zip(of.tolist(), name[hit].tolist(), (start[row] - off[hit] - begin[of]).tolist(),
                        [near] * len(row)))

    place = np.arange(len(w)) - begin[text]
    most = max((c for c in t.classes), default=SHINGLE) - SHINGLE + 1
    for lo in range(0, len(s), _PART):
        levels = doubled(s[lo:lo + _PART + most], most)
        for c in t.classes:
            near, m = step(c), c - SHINGLE + 1
            p = np.arange(lo, min(lo + _PART, len(w) - c + 1))
            p = p[(place[p] % near == 0) & (place[p] + c <= n[text[p]])]
            if len(p):
                candidates(c, near, p, band_keys(minima(levels, p - lo, m)))
    for c in t.classes:  # texts shorter than the window, as a whole
        for i in np.flatnonzero((n < c) & (n >= SHINGLE)):
            low = (s[begin[i]:end[i] - SHINGLE + 1] * _A + _B).min(axis=1, keepdims=True)
            candidates(c, 1, begin[i:i + 1], band_keys(low))
    for i, k, a, near in todo:
        m = int(t.size[k]) - SHINGLE + 1
        mine = s[begin[i]:end[i] - SHINGLE + 1][max(a - near, 0):max(a + m + near, 0)]
        have = np.isin(t.sets[k], mine).mean()
        if have >= least:
            keep((i, k), (-float(have), max(a, 0)))
    return best


def search(t: Templates, words: list[np.ndarray], least: float):
    """{(text, template): (containment, first word)}, a long text in segments
    that overlap by more than the longest template."""
    over, best = int(t.size.max(initial=0)) + LARGEST, {}
    for i, w in enumerate(words):
        if len(w) > SEGMENT + over:
            for base in range(0, len(w), SEGMENT):
                for (_, k), (v, a) in _search(t, [w[base:base + SEGMENT + over]], least).items():
                    best[i, k] = min(best.get((i, k), (0.0, 0)), (v, a + base))
    short = [i for i, w in enumerate(words) if len(w) <= SEGMENT + over]
    for (j, k), v in _search(t, [words[i] for i in short], least).items():
        best[short[j], k] = v
    return {k: (-v, a) for k, (v, a) in best.items()}


def template_rows(templates: DataFrame, name_col: str = "name", text_col: str = "text") -> list[tuple[str, str]]:
    """The templates of a table, for `license_hits`: short notices or whole
    license texts, one row per wording; several may share a name. Raises if
    their texts are over `TEMPLATE_BYTES`, before any is fetched; rows with a null
    are left out."""
    rows = templates.select(F.col(name_col).cast("string").alias("name"),
                            F.col(text_col).cast("string").alias("text")).dropna()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} bytes, {TEMPLATE_BYTES} at most")
    return sorted(tuple(r) for r in rows.collect())


def license_hits(docs: DataFrame, templates: list[tuple[str, str]] | DataFrame = TEMPLATES,
                 id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """(`id_col`, license, containment, word_start) per row of `docs` and
    template found in it: the passage with the most shingles, the first of
    several; word_start counts words without punctuation. `templates` are pairs
    (name, text) or a table for `template_rows`. Null and empty texts
    hold nothing, nor do templates without words match; null ids and repeated
    rows stay; an empty table gives an empty one; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    t = Templates(template_rows(templates) if isinstance(templates, DataFrame) else templates)

    def run(batches):
        words = hasher()
        for b in slabs(batches, "text", _SLAB):
            best = search(t, words(b.column("text").to_pylist()), least)
            if best:
                key = sorted(best)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array([i for i, _ in key])),
                     pa.array([t.names[k] for _, k in key], pa.string()),
                     pa.array([best[x][0] for x in key], pa.float64()),
                     pa.array([best[x][1] for x in key], pa.int64())],
                    ["id", "license", "containment", "word_start"])

    out = ["license", "containment", "word_start"]
    return map_texts(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, license string, "
                                "containment double, word_start long").select(
        F.col("id").alias(id_col), *[F.col(c).alias(fresh(c, [id_col])) for c in out])
