"""Word k-gram seeds shared by the passage operators (decontamination, licenses).

A reference set (benchmark items, license templates) is a bounded block of word
sequences. Words get small ids, 0 for a word that the block does not have; every
k-gram window of a batch of documents gets its Karp-Rabin hash at once and is looked
up among the block's seed hashes. Hits are checked by their words, so a colliding
hash never counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = re.compile(r"\w+")
CHARS_AT_ONCE = 2_000_000
PAIRS_AT_ONCE = 1 << 18  # seed pairs held at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hash of every window of k ids (modulo 2^64)."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h = h * _BASE + ids[j : j + n].astype(np.uint64)
    return h ^ (h >> np.uint64(29))


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All of range(lo, hi), one after the other."""
    size = hi - lo
    return np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)


def _chained(item: np.ndarray, diagonal: np.ndarray, i: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of n windows from item position i on, joined where one follows the other on
    its diagonal; sorted."""
    if not len(item):
        return item, diagonal, i, n
    order = np.lexsort((i, diagonal, item))
    item, diagonal, i, n = item[order], diagonal[order], i[order], n[order]
    new = np.ones(len(i), dtype=bool)
    new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (i[1:] != i[:-1] + n[:-1])
    first = np.flatnonzero(new)
    return item[first], diagonal[first], i[first], np.add.reduceat(n, first)


class Block:
    """Reference sequences with an inverted index: seed hash -> (item, position)."""

    def __init__(self, texts: list[str | None], k: int, pick=None):
        """``pick``: which window positions of a hash array to index (default all)."""
        self.k = k
        split = [words(t) for t in texts]
        self.vocab: dict[str, int] = {}
        for ws in split:
            for w in ws:
                self.vocab.setdefault(w, len(self.vocab) + 1)
        self.items = [np.array([self.vocab[w] for w in ws], dtype=np.int64) for ws in split]
        hashes, item, pos = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, ids in enumerate(self.items):
            h = rolling(ids, k)
            at = np.arange(len(h)) if pick is None else pick(h)
            hashes.append(h[at])
            item.append(np.full(len(at), i))
            pos.append(at)
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.pos = h[order], np.concatenate(item)[order], np.concatenate(pos)[order]
        self.maybe = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.maybe[self.hash >> np.uint64(64 - _TABLE_BITS)] = True
        self.size = np.array([len(x) for x in self.items], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.concatenate([*self.items, np.empty(0, np.int64)])
        self.item_of = np.repeat(np.arange(len(self.items)), self.size)

    def _hits(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document index, window position, first and last posting) of the windows whose
        hash the block has, in order."""
        gap = np.zeros(self.k - 1, dtype=np.int64)
        flat = np.concatenate([x for d in docs for x in (d, gap)])
        size = np.array([len(d) + self.k - 1 for d in docs], dtype=np.int64)
        begin = np.cumsum(size) - size
        h = rolling(flat, self.k)
        at = np.flatnonzero(self.maybe[h >> np.uint64(64 - _TABLE_BITS)])
        lo = np.searchsorted(self.hash, h[at])
        hi = np.searchsorted(self.hash, h[at], side="right")
        at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
        owner = np.searchsorted(begin, at, side="right") - 1
        return owner, at - begin[owner], lo, hi

    def runs(self, docs: list[np.ndarray], share: float) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document index, item, matches) where shared seeds cover at least ``share`` of
        the item's words. Matches are maximal: rows (item position, document position,
        words), at least k words each, by diagonal, then position.

        Items below ``share`` are ruled out before any pair of positions is listed. Pairs
        are listed a bounded number at a time and kept as runs on their diagonals, so a
        text of one repeated word takes one row a diagonal, not one a pair.
        """
        if not len(self.hash) or not docs:
            return
        owner, at, lo, hi = self._hits(docs)
        for part in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1):
            if len(part):
                d = int(owner[part[0]])
                for item, matches in self._document_runs(docs[d], at[part], lo[part], hi[part], share):
                    yield d, item, matches

    def _document_runs(self, doc: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, share: float) -> Iterator[tuple[int, np.ndarray]]:
        k = self.k
        _, once = np.unique(lo, return_index=True)  # every shared seed of the block once
        e = _ranges(lo[once], hi[once])
        covered = np.unique((self.start[self.item[e]] + self.pos[e])[:, None] + np.arange(k))
        items, n = np.unique(self.item_of[covered], return_counts=True)
        items = items[n >= share * self.size[items]]
        if not len(items):
            return
        doc = np.concatenate([doc, np.zeros(k - 1, dtype=np.int64)])
        found, before, upto = [], 0, np.cumsum(hi - lo)
        while before < len(at):
            held = upto[before - 1] if before else 0
            after = max(before + 1, int(np.searchsorted(upto, held + PAIRS_AT_ONCE, side="right")))
            e = _ranges(lo[before:after], hi[before:after])
            j = np.repeat(at[before:after], (hi - lo)[before:after])
            before = after
            wanted = np.isin(self.item[e], items)
            e, j = e[wanted], j[wanted]
            word = self.start[self.item[e]] + self.pos[e]
            same = np.logical_and.reduce([self.flat[word + x] == doc[j + x] for x in range(k)])
            item, i, j = self.item[e][same], self.pos[e][same], j[same]
            found.append(_chained(item, j - i, i, np.ones(len(i), dtype=np.int64)))
        item, diagonal, i, n = _chained(*(np.concatenate(c) for c in zip(*found)))
        for part in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1):
            if len(part):
                yield int(item[part[0]]), np.stack([i[part], i[part] + diagonal[part], n[part] + k - 1], axis=1)

    def seeds(self, docs: list[np.ndarray]) -> Iterator[tuple[int, dict[int, list[tuple[int, int]]]]]:
        """(document index, {item: [(item position, document position)]}) of the
        documents that share a seed with the block."""
        if not len(self.hash) or not docs:
            return
        owner, at, lo, hi = self._hits(docs)
        found: dict[int, list[tuple[int, int]]] = {}
        last = -1
        for j, x, y, d in zip(at.tolist(), lo.tolist(), hi.tolist(), owner.tolist()):
            if d != last and found:
                yield last, found
                found = {}
            last = d
            window = docs[d][j : j + self.k]
            for e in range(x, y):
                i = int(self.pos[e])
                if np.array_equal(self.items[self.item[e]][i : i + self.k], window):
                    found.setdefault(int(self.item[e]), []).append((i, j))
        if found:
            yield last, found

    def ids(self, text: str | None) -> np.ndarray:
        ws = words(text)
        return np.fromiter((self.vocab.get(w, 0) for w in ws), np.int64, len(ws))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Batches cut so that a slice's texts stay below a bound (one text at least)."""
    for batch in batches:
        texts, lo, held, size = batch.column(column), 0, [], 0
        for i, t in enumerate(texts):
            held.append(t.as_py())
            size += len(held[-1] or "")
            if size >= CHARS_AT_ONCE or i + 1 == batch.num_rows:
                yield batch.slice(lo, len(held)), held
                lo, held, size = i + 1, [], 0
