"""License scan: fingerprints, inverted index, banded alignment (operator 3).

Templates and documents are word sequences (lower-cased, letters and digits).
Of a template's words, ordered by rarity, winnowing keeps the least one of every window of w
places; single words (k = 1), since words may be inserted anywhere and no longer gram need stand intact.
A match covers ``least`` of its template's n words, m at least, so it holds one of any n - m + 1
places: w is the largest window that keeps so many, and no match is without a fingerprint. They form an inverted index, word -> (template, position), a fixed small table that every
task holds. A document's words found there name diagonals; those whose surroundings
hold m words of the template at all are aligned locally within a band,
which allows words to be inserted, left out or changed, at every diagonal whose band holds
the fingerprint. So the matches are those that aligning at every diagonal of every
document would give. Each has its coverage and its span in the text. Nothing is shuffled.

Edge cases: a null or empty text has no matches; very long texts are scanned whole, in runs; a license named twice is
reported twice; of alignments that cover the same words the better, then the earlier one counts; an empty table gives an empty result; equal rows get equal answers; other columns are ignored. Offsets are code
points, end exclusive; coverage counts matched template words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORD, LOWER, runs, span_hashes, word_spans

LEAST = 0.8
BAND = 12
CELLS = 1 << 18  # of alignments computed at a time
#: Words that count as the most common ones; this decides on time only.
COMMON = frozenset("a all an and any are as be by for from in is it no not of on or provided that the this to under use with work you".split())
GAP, CHANGE, HIT = 1, 1, 2

# fixed values: notices as they stand in files and pages
TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "mit": ("Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    "lgpl-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3",),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies.",),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
    "cc-by-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-nd-4.0": ("Licensed under CC BY-ND 4.0",),
    "all-rights-reserved": ("All rights reserved. No part of this publication may be reproduced",),
}

MATCH = T.StructType([T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
                      T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def _words(buf: np.ndarray, off: np.ndarray):
    starts, ends, doc = word_spans(buf, off, ALNUM_WORD)
    return span_hashes(LOWER[buf], starts, ends), starts, ends, doc


def winnowed(rank: list, need: int) -> list[int]:
    """Places with the least rank of some window of w places, for the largest w that keeps ``need`` of them."""
    kept = set(range(len(rank)))
    for w in range(2, len(rank) + 1):
        fewer = {min(range(i, i + w), key=rank.__getitem__) for i in range(len(rank) - w + 1)}
        if len(fewer) < need:
            break
        kept = fewer
    return sorted(kept)


class LicenseIndex:
    def __init__(self, templates=None, least: float = LEAST):
        self.names, self.words, self.least, self.bands = [], [], [], []
        spelt = []
        for name, texts in (templates or TEMPLATES).items():
            for text in texts:
                buf = np.frombuffer(text.encode(), np.uint8)
                words, starts, ends, _ = _words(buf, np.array([0, len(buf)]))
                size = len(words)
                self.names.append(name)
                self.words.append(words)
                self.least.append(max(1, int(np.ceil(least * size))))
                self.bands.append(min(BAND + size // 8, max(2, size // 2)))  # narrow for short notices, which may follow each other closely
                spelt.append([LOWER[buf[x:y]].tobytes().decode() for x, y in zip(starts, ends)])
        self.vocabulary = np.unique(np.concatenate(self.words))
        self.ids = [np.searchsorted(self.vocabulary, w) for w in self.words]
        uses = np.bincount(np.concatenate(self.ids))
        self.holds = np.zeros((len(self.words), len(self.vocabulary) + 1), bool)  # last column: words of no template
        keys, where = [], []
        for t, (ids, words) in enumerate(zip(self.ids, spelt)):
            self.holds[t, ids] = True
            kept = winnowed([(words[i] in COMMON, uses[ids[i]], -len(words[i]), i) for i in range(len(ids))], len(ids) - self.least[t] + 1)
            keys += [int(ids[i]) for i in kept]
            where += [(t, i) for i in kept]
        order = np.argsort(keys, kind="stable")
        self.keys, self.where = np.array(keys)[order], np.array(where)[order]

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Each word's number in the vocabulary, or its size for words of no template."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, len(self.vocabulary))

    def candidates(self, ids: np.ndarray, doc: np.ndarray, first: np.ndarray):
        """Per template its (document, diagonal) named by fingerprints with enough words around them, sorted. ``first``: first word of each document, and the end."""
        lo, hi = np.searchsorted(self.keys, ids, "left"), np.searchsorted(self.keys, ids, "right")
        at = np.flatnonzero(hi > lo)
        n, low = hi[at] - lo[at], lo[at]
        pos, post = np.repeat(at, n), self.where[np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        order = np.argsort(post[:, 0], kind="stable")
        pos, post = pos[order], post[order]
        cut = np.searchsorted(post[:, 0], np.arange(len(self.words) + 1))
        for t in np.flatnonzero(np.diff(cut)).tolist():
            p, i = pos[cut[t]:cut[t + 1]], post[cut[t]:cut[t + 1], 1]
            reach = 2 * self.bands[t]
            seen = np.concatenate([[0], np.cumsum(self.holds[t][ids])])
            d = doc[p]
            start, end = np.maximum(p - i - reach, first[d]), np.minimum(p - i + len(self.ids[t]) + reach, first[d + 1])
            enough = seen[end] - seen[start] >= self.least[t]
            if enough.any():
                yield t, np.unique(np.stack([d, p - i], 1)[enough], axis=0)

    def matches(self, words: np.ndarray, doc: np.ndarray, docs: int):
        """(document, template, matched words, first word, end word) of the alignments that cover enough."""
        first = np.searchsorted(doc, np.arange(docs + 1))
        ids = self.numbers(words)
        for t, named in self.candidates(ids, doc, first):
            band = self.bands[t]
            hits, s, e, score = align_all(self.ids[t], ids, first[named[:, 0]], first[named[:, 0] + 1], named[:, 1], band)
            # an intact notice is the best alignment at every diagonal whose band holds it
            rest = named[score < HIT * len(self.ids[t])]
            more = np.unique(np.stack([np.repeat(rest[:, 0], 2 * band + 1), (rest[:, 1][:, None] + np.arange(-band, band + 1)).ravel()], 1), axis=0)
            found = [(named[:, 0], hits, s, e)]
            if len(more):
                found.append((more[:, 0], *align_all(self.ids[t], ids, first[more[:, 0]], first[more[:, 0] + 1], more[:, 1], band)[:3]))
            d, hits, s, e = (np.concatenate(x) for x in zip(*found))
            keep = hits >= self.least[t]
            for row in np.unique(np.stack([d, hits, s, e], 1)[keep], axis=0).tolist():
                yield row[0], t, *row[1:]


def align_all(template: np.ndarray, words: np.ndarray, lo: np.ndarray, hi: np.ndarray, diagonal: np.ndarray, band: int):
    """Best local alignments with document position - template position within ``band`` of each
    ``diagonal``, in ``words`` from ``lo`` to ``hi``: matched words, first word, end word, score."""
    width = 2 * band + 1
    step = max(1, CELLS // width)
    if len(diagonal) > step:
        parts = [align_all(template, words, lo[a:a + step], hi[a:a + step], diagonal[a:a + step], band) for a in range(0, len(diagonal), step)]
        return tuple(np.concatenate(x) for x in zip(*parts))
    n = len(diagonal)
    out = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1), np.zeros(n, np.int64)
    if not n or not len(words):
        return out
    offset, row = np.arange(width), np.arange(n)
    lo, hi = lo[:, None], hi[:, None]
    score, hits, first = np.zeros((n, width), np.int64), np.zeros((n, width), np.int64), np.full((n, width), -1)
    up = lambda x, last: np.concatenate([x[:, 1:], np.full((n, 1), last)], 1)
    for i, w in enumerate(template):
        j = offset + (diagonal[:, None] - band + i)  # document position of each cell of the row
        inside = (j >= lo) & (j < hi)
        same = inside & (words[np.clip(j, 0, len(words) - 1)] == w)
        # from the row before: the diagonal step keeps the cell's place, leaving out a template word moves it one up
        straight = score + np.where(same, HIT, -CHANGE)
        skip = up(score, 0) - GAP
        take = straight >= skip
        new = np.where(take, straight, skip)
        got = np.where(take, hits + same, up(hits, 0))
        start = np.where(take, np.where((first < 0) & same, j, first), up(first, -1))
        dead = (new <= 0) | ~inside
        new, got, start = np.where(dead, 0, new), np.where(dead, 0, got), np.where(dead, -1, start)
        # inserted document words: a running maximum along the row
        lift = new + GAP * offset
        top = np.maximum.accumulate(lift, axis=1)
        source = np.maximum.accumulate(np.where(lift == top, offset, 0), axis=1)
        score = np.maximum(top - GAP * offset, 0)
        hits, first = np.take_along_axis(got, source, 1), np.take_along_axis(start, source, 1)
        k = score.argmax(1)
        better = score[row, k] > out[3]
        for x, y in zip(out, (hits[row, k], first[row, k], j[row, k] + 1, score[row, k])):
            x[better] = y[better]
    return out


def align(template: np.ndarray, words: np.ndarray, diagonal: int, band: int):
    """One alignment of ``align_all``: (matched words, first word, end word)."""
    return tuple(int(x[0]) for x in align_all(template, words, np.array([0]), np.array([len(words)]), np.array([diagonal]), band)[:3])


def scan_licenses(docs: DataFrame, templates=None, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``matches``, an array of (license,
    coverage, start, end) by start; of alignments that overlap, the one with most
    matched words stays, then the one of higher coverage."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("matches", T.ArrayType(MATCH))])

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        index = LicenseIndex(templates, least)
        for batch in batches:
            out = [[] for _ in range(batch.num_rows)]
            for a, b, buf, off in runs(batch.column(1)):
                words, starts, ends, doc = _words(buf, off)
                found: dict[int, list] = {}
                for d, t, hits, x, y in index.matches(words, doc, b - a):
                    found.setdefault(d, []).append((hits, index.names[t], hits / len(index.words[t]), int(starts[x]), int(ends[y - 1])))
                for d, matches in found.items():
                    kept = []
                    for m in sorted(matches, key=lambda m: (-m[0], -m[2], m[3], m[1])):
                        if not any(m[3] < k[4] and k[3] < m[4] for k in kept):
                            kept.append(m)
                    chars = np.concatenate([[0], np.cumsum((buf[off[d]:off[d + 1]] & 0xC0) != 0x80)])
                    out[a + d] = [{"license": n, "coverage": c, "start": int(chars[s - off[d]]), "end": int(chars[e - off[d]])}
                                  for _, n, c, s, e in sorted(kept, key=lambda m: (m[3], m[1]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow.field(1).type)], schema=arrow)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(work, schema)


def license_digest(docs: DataFrame) -> DataFrame:
    """Per document the licenses found and their spans as ``license:percent:start:end``."""
    line = F.transform("matches", lambda m: F.concat_ws(":", m["license"], F.round(100 * m["coverage"]).cast("int").cast("string"),
                                                        m["start"].cast("string"), m["end"].cast("string")))
    return scan_licenses(docs).select("doc_id", F.size("matches").cast("long").alias("n_matches"),
                                      F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))).alias("licenses"),
                                      F.concat_ws(",", line).alias("spans"))
