"""License scan: winnowed fingerprints, inverted index, banded alignment.

Templates become word sequences (lower case, ``\\w+``). Of their Karp-Rabin hashes of
``k`` words, winnowing keeps the smallest of every ``window`` in a row; those go into
an inverted index. Every k-gram of a document is looked up (not only its own winnowed
ones), so a document that holds any indexed gram is a candidate, short notices
included. A seed is not assured at ``threshold`` 0.8, least of all in short templates,
so places are found by words too: around a diagonal at which ``threshold`` of the
template's words occur within the template's own length, which every such place has.
The whole template is aligned with the text around those diagonals (+1 a match, -1 a
substitution, insertion or deletion; free ends in the document), in a band as wide as
the text there, so that inserted runs do not split a notice: a place needs under two
template lengths of insertions to be worth more in parts. A place is reported from
``threshold`` matched share of the template on; overlapping places of one template keep
the best.

The index is built from the templates, a parameter of bounded size, in every worker;
documents are scanned in place, without a shuffle.

Cases: null or empty texts match nothing, as do templates without a word. Null ids and repeated rows keep their rows; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verso.llm.common import arrow_map
from verso.llm.seeds import WORD, Block, slices

K = 3
WINDOW = 4
BAND = 8
THRESHOLD = 0.8
_MATCH, _SCORE = 1 << 24, 1 << 36  # units of a matched word and of the score
_AT_ONCE = 1 << 22  # words aligned at once

# License notices and openings of license texts.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
    "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions kept: the last smallest hash of every window (of all, if fewer)."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    w = min(window, n)
    view = np.lib.stride_tricks.sliding_window_view(hashes, w)[:, ::-1]
    return np.unique(np.arange(n - w + 1) + w - 1 - view.argmin(axis=1))


def align(template: np.ndarray, doc: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """(words matched, start, stop) of the best banded alignment of the whole
    template: word i of it lies within ``band`` of word i+diagonal of ``doc``."""
    n, none = len(doc), (-(10**9), 0, 0)
    # score, matched words, minus the start: larger is better, all else equal the longer span.
    row = {j: (0, 0, -j) for j in range(max(0, diagonal - band), min(n, diagonal + band) + 1)}
    for i, word in enumerate(template.tolist(), 1):
        new: dict[int, tuple[int, int, int]] = {}
        left = none
        for j in range(max(0, i + diagonal - band), min(n, i + diagonal + band) + 1):
            s, m, at = row.get(j - 1, none)
            hit = j > 0 and doc[j - 1] == word
            best = (s + 1, m + 1, at) if hit else (s - 1, m, at)
            s, m, at = row.get(j, none)
            best = max(best, (s - 1, m, at), (left[0] - 1, left[1], left[2]))
            new[j] = left = best
        row = new
    if not row:
        return 0, 0, 0
    (_, matched, at), stop = max((cell, -j) for j, cell in row.items())
    return matched, -at, -stop


def places(template: np.ndarray, doc: np.ndarray, seeds: list[tuple[int, int]], band: int, threshold: float) -> list[tuple[int, int, int]]:
    """Non-overlapping (start, stop, matched) of one template in one document."""
    band = min(band, len(template) // 4)  # two places in a row stay apart
    near: list[int] = []
    for d in sorted({j - i for i, j in seeds}):  # one alignment for diagonals within half a band
        if not near or d - near[-1] > band // 2:
            near.append(d)
    found = []
    for d in near:
        matched, start, stop = align(template, doc, d, band)
        if matched >= threshold * len(template):
            found.append((-matched, stop - start, start, stop))
    out: list[tuple[int, int, int]] = []
    for m, _, start, stop in sorted(set(found)):
        if all(stop <= a or b <= start for a, b, _ in out):
            out.append((start, stop, -m))
    return sorted(out)


def near_diagonals(template: np.ndarray, doc: np.ndarray, need: int) -> np.ndarray:
    """Diagonals with ``need`` template words in the document at most the template's
    length away, each at its own place of the template (a necessary condition)."""
    n, order = len(template), np.argsort(doc, kind="stable")
    lo = np.searchsorted(doc[order], template)
    size = np.searchsorted(doc[order], template, side="right") - lo
    i = np.repeat(np.arange(n), size)
    j = order[np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)]
    start, stop = j - i - n, j - i + n + 1  # increasing for one i
    same = i[1:] == i[:-1]
    start[1:] = np.where(same, np.maximum(start[1:], stop[:-1]), start[1:])
    step = np.zeros(len(doc) + 3 * n + 2, dtype=np.int64)  # diagonal c at c + 2n
    np.add.at(step, start + 2 * n, 1)
    np.add.at(step, stop + 2 * n, -1)
    return np.flatnonzero(np.cumsum(step) >= need) - 2 * n


def whole_align(template: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words matched, start) of the best alignment of the whole template that ends
    before each word of ``doc`` (and at its end); a score is one whole number of score,
    matched words and minus the start, as in ``align``."""
    one, at = _SCORE, np.arange(len(doc) + 1)
    row, gap = -at, at * one
    for word in template.tolist():
        new = row - one
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(doc == word, one + _MATCH, -one))
        row = np.maximum.accumulate(new + gap) - gap
    start = -row % _MATCH
    return (row + start) // _MATCH % (_SCORE // _MATCH), start


def whole_places(template: np.ndarray, doc: np.ndarray, diagonals: np.ndarray, need: int) -> list[tuple[int, int, int]]:
    """Non-overlapping (start, stop, matched) around increasing ``diagonals``."""
    n, found = len(template), []
    cuts = np.flatnonzero(np.diff(diagonals) > 3 * n) + 1
    for run in np.split(diagonals, cuts):
        first, last = max(0, int(run[0]) - n), min(len(doc), int(run[-1]) + 2 * n)
        for lo in range(first, max(last, first + 1), _AT_ONCE):  # an alignment spans at most 3n words
            part = doc[max(first, lo - 4 * n) : min(last, lo + _AT_ONCE)]
            matched, start = whole_align(template, part)
            for stop in np.flatnonzero(matched >= need).tolist():
                a = max(first, lo - 4 * n)
                found.append((-int(matched[stop]), stop - int(start[stop]), a + int(start[stop]), a + stop))
    out: list[tuple[int, int, int]] = []
    for m, _, start, stop in sorted(set(found)):
        if all(stop <= a or b <= start for a, b, _ in out):
            out.append((start, stop, -m))
    return sorted(out)


def candidates(index: Block, docs: list[np.ndarray], needs: list[int]) -> Iterator[tuple[int, int]]:
    """(document, template) of those with ``need`` of the template's words at all."""
    has = np.zeros((len(docs), len(index.vocab) + 1), dtype=np.float32)
    has[np.repeat(np.arange(len(docs)), [len(d) for d in docs]), np.concatenate(docs)] = 1
    weight = np.stack([np.bincount(t, minlength=has.shape[1]) for t in index.items], axis=1).astype(np.float32)
    for d, item in np.argwhere(has @ weight >= np.array(needs)).tolist():
        yield d, item


@functools.lru_cache(maxsize=4)
def _index(templates: tuple[str, ...], k: int, window: int) -> Block:
    return Block(list(templates), k, lambda h: winnow(h, window))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc_id, license, coverage, matched_words, start, stop, n_words): every place
    where a template is matched; start and stop are code points of the text."""
    chosen = dict(sorted((TEMPLATES if templates is None else templates).items()))
    names, texts = list(chosen), tuple(chosen.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(texts, k, window)
        needs = [max(1, math.ceil(threshold * len(t) - 1e-9)) for t in index.items]
        for batch, held in slices(batches):
            ids, rows = batch.column("doc_id").to_pylist(), []
            docs_ids = [index.ids(t) for t in held]
            if not names:
                continue
            seeded = {(d, item): [j - i for i, j in seeds] for d, by_item in index.seeds(docs_ids) for item, seeds in by_item.items()}
            for d, item in sorted({*seeded, *candidates(index, docs_ids, needs)}):
                template = index.items[item]
                near = near_diagonals(template, docs_ids[d], needs[item])
                near = np.unique(np.concatenate([near, np.array(seeded.get((d, item), []), dtype=np.int64)]))
                if not len(near):
                    continue
                spans = _word_spans(held[d])
                for start, stop, matched in whole_places(template, docs_ids[d], near, needs[item]):
                    rows.append((ids[d], names[item], matched / len(template), matched, spans[start][0], spans[stop - 1][1], len(template)))
            if rows:
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
                names_out = ["doc_id", "license", "coverage", "matched_words", "start", "stop", "n_words"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names_out)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, run, "doc_id long, license string, coverage double, matched_words int, start long, stop long, n_words int")


def _word_spans(text: str) -> list[tuple[int, int]]:
    """Code point spans in ``text`` of the words of its lower-cased form."""
    low = text.lower()
    if len(low) == len(text):
        return [m.span() for m in WORD.finditer(low)]
    # A few letters grow in lower case: map every lower-cased position back.
    back = [i for i, c in enumerate(text) for _ in c.lower()]
    back += [len(text)] * (len(low) - len(back) + 1)
    return [(back[a], back[b - 1] + 1) for a, b in (m.span() for m in WORD.finditer(low))]
