"""Language ID with hyperdimensional profiles.

Every letter has a random vector of ``dim`` entries +1/-1, drawn from a generator
seeded with its code point (no alphabet is learned). An n-gram vector binds the
letter vectors, each permuted (rolled) by its place in the n-gram, by
multiplication. A text is the bundle (sum) of its n-gram vectors; a language
prototype is the bundle of all its training texts. Prediction: the prototype of
largest cosine after the mean prototype direction is taken off the prototypes.

Text is lower-cased, each run of non-letters becomes one blank, and a blank stands
on either side. Counts of n-grams are exact; the trigram vectors of a task are kept
in a bounded cache.

Training adds integer vectors: each task sends ``dim`` numbers for each language
that it met, which Spark sums. The driver gets languages x dim numbers, independent
of the number of documents.

Cases: null text or one without a letter is ``und`` with score 0, as is any text if
nothing was learned. Training ignores rows with null text or language. Ties go to
the first language in code point order. Null ids and repeated rows keep their rows;
other columns are ignored.

``keep_identified`` drops a text with letters only on evidence. If it has nothing in
common with a prototype, its n-gram vectors are random to it, and their sum along the
prototype has mean 0 and the standard deviation |counts|. A text goes if no language
lies beyond what that noise gives with chance ``CHANCE``, and if it has so many n-grams
that a text of any learned language, even with ``SHARE`` of the usual likeness, would
lie at twice that bound. Texts too short or repetitive for that stay.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verso.llm.common import arrow_map, ship

DIM = 1024
N = 3
UNKNOWN = "und"
MIN_SCORE = 0.05  # no stage uses it; the brute force of test_pipeline.py reads it
CHANCE = 0.001  # that a text unlike every language passes for one
SHARE = 0.5
_SEED = 20_177
_CHARS_AT_ONCE = 1_500_000
_DOCS_AT_ONCE = 500
_CACHED_GRAMS = 20_000
_BITS = 21  # of a code point


class Space:
    """Letter codes and n-gram vectors; one for each Python worker."""

    def __init__(self, dim: int):
        self.dim = dim
        self.code = np.full(0x110000, -1, dtype=np.int32)  # lower-cased letter, 0 for others, -1 not looked up yet
        self.letters: dict[int, np.ndarray] = {}
        # Sorted n-gram keys, and the row of ``vectors`` that each has.
        self.keys, self.slot = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.vectors = np.empty((_CACHED_GRAMS, dim), dtype=np.float32)

    def letter(self, cp: int) -> np.ndarray:
        if cp not in self.letters:
            self.letters[cp] = np.random.default_rng((_SEED, cp)).integers(0, 2, self.dim, dtype=np.int8) * 2 - 1
        return self.letters[cp]

    def codes(self, cp: np.ndarray) -> np.ndarray:
        out = self.code[cp]
        new = np.unique(cp[out < 0])
        if len(new):
            for c in new.tolist():
                low = chr(c).lower()
                self.code[c] = ord(low[0]) if chr(c).isalpha() else 0
            out = self.code[cp]
        return out

    def grams(self, keys: np.ndarray) -> np.ndarray:
        """Rows of ``self.vectors`` (until the next call) for at most
        ``_CACHED_GRAMS`` sorted distinct n-gram keys."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if known.all():
            return self.slot[at]
        if len(self.keys) + int((~known).sum()) > _CACHED_GRAMS:  # full: start again
            self.keys, self.slot, known = self.keys[:0], self.slot[:0], np.zeros(len(keys), dtype=bool)
        fresh = keys[~known]
        made = np.ones((len(fresh), self.dim), dtype=np.float32)
        for place in range(N):
            distinct, inv = np.unique((fresh >> (_BITS * place)) & ((1 << _BITS) - 1), return_inverse=True)
            made *= np.stack([np.roll(self.letter(int(c)), place) for c in distinct])[inv]
        used = len(self.keys)
        self.vectors[used : used + len(fresh)] = made
        own, slot = np.concatenate([self.keys, fresh]), np.concatenate([self.slot, np.arange(used, used + len(fresh))])
        order = np.argsort(own, kind="stable")
        self.keys, self.slot = own[order], slot[order]
        return self.slot[np.searchsorted(self.keys, keys)]


@functools.lru_cache(maxsize=2)
def space(dim: int) -> Space:
    return Space(dim)


def gram_counts(texts: list[str], own: Space) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted n-gram keys, their counts) for each text."""
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    cp = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le"), dtype="<u4")
    code = own.codes(cp)
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)  # one blank for a run of others
    border = np.cumsum(sizes)
    keep[border[:-1]] = True  # texts do not share a blank
    kept = np.cumsum(keep)
    code, border = code[keep].astype(np.int64), kept[border - 1]
    key = code[: len(code) - N + 1].copy() if len(code) >= N else np.empty(0, np.int64)
    for place in range(1, N):
        key |= code[place : len(code) - N + 1 + place] << (_BITS * place)
    lo = 0
    for hi in border.tolist():
        part = np.sort(key[lo : max(lo, hi - N + 1)])
        head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.empty(0, np.int64)
        yield part[head], np.diff(np.append(head, len(part)))
        lo = hi


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        lo, held, size = 0, [], 0
        for i, t in enumerate(batch.column(column)):
            held.append(t.as_py() or "")
            size += len(held[-1])
            if size >= _CHARS_AT_ONCE or len(held) == _DOCS_AT_ONCE or i + 1 == batch.num_rows:
                yield batch.slice(lo, len(held)), held
                lo, held, size = i + 1, [], 0


def _sums(docs: DataFrame, dim: int) -> dict[str, np.ndarray]:
    """``dim`` sums of n-gram vectors, then the number of n-grams, of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = space(dim), {}
        for batch, texts in _slices(batches, 0):
            by: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for lang, grams in zip(batch.column(1).to_pylist(), gram_counts(texts, own)):
                by.setdefault(lang, []).append(grams)
            for lang, grams in by.items():
                keys, inv = np.unique(np.concatenate([k for k, _ in grams]), return_inverse=True)
                if len(keys):
                    n = np.bincount(inv, weights=np.concatenate([c for _, c in grams]))
                    for cut in range(0, len(keys), _CACHED_GRAMS // 2):  # exact: whole numbers below 2^53
                        rows = own.grams(keys[cut : cut + _CACHED_GRAMS // 2])
                        part = n[cut : cut + len(rows)]
                        total[lang] = total.get(lang, 0) + np.append(part @ own.vectors[rows].astype(np.float64), part.sum())
        for lang, v in total.items():
            out = [pa.array([lang] * (dim + 1), pa.string()), pa.array(np.arange(dim + 1, dtype=np.int32)), pa.array(np.rint(v).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(out, names=["lang", "at", "value"])

    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sums = arrow_map(rows, run, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for r in sums.collect():  # languages x (dim + 1) rows
        found.setdefault(r.lang, np.zeros(dim + 1))[r.at] = r.value
    return dict(sorted(found.items()))


def train(docs: DataFrame, dim: int = DIM) -> dict[str, np.ndarray]:
    """Prototype (sum of integer n-gram vectors) of each language of ``docs``
    (text, lang). Languages are the distinct non-null values of ``lang``."""
    return {lang: v[:-1] for lang, v in _sums(docs, dim).items()}


def train_with_totals(docs: DataFrame, dim: int = DIM) -> tuple[dict[str, np.ndarray], dict[str, float]]:
    """(prototypes, number of n-grams behind each), in the one pass of ``train``."""
    sums = _sums(docs, dim)
    return {lang: v[:-1] for lang, v in sums.items()}, {lang: float(v[-1]) for lang, v in sums.items()}


class Predictor:
    """Predictions of texts from prototypes."""

    def __init__(self, prototypes: dict[str, np.ndarray], dim: int = DIM):
        self.names, self.dim = list(prototypes), dim
        self.unit = np.stack([v / max(np.linalg.norm(v), 1e-9) for v in prototypes.values()]) if self.names else np.zeros((0, dim))
        # What all languages share tells none apart; with one language nothing is taken off.
        apart = self.unit - (self.unit.mean(axis=0) if len(self.names) > 1 else 0.0)
        self.apart = apart / np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-9)

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        own, said, score = space(self.dim), [], np.zeros(len(texts))
        for i, (keys, n) in enumerate(gram_counts(texts, own)):
            if not self.names or not keys.any():
                said.append(UNKNOWN)
                continue
            v, n = np.zeros(self.dim), n.astype(np.float32)
            for cut in range(0, len(keys), _CACHED_GRAMS // 2):
                rows = own.grams(keys[cut : cut + _CACHED_GRAMS // 2])
                v += n[cut : cut + len(rows)] @ own.vectors[rows]
            best = int(np.argmax(self.apart @ v))
            said.append(self.names[best])
            score[i] = min(1.0, max(0.0, float(self.unit[best] @ v) / max(float(np.linalg.norm(v)), 1e-9)))
        return said, score


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = DIM) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; score is the cosine with
    the predicted prototype, not below 0."""
    predictor = Predictor(prototypes, dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _slices(batches, 1):
            said, score = predictor(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, "doc_id long, lang_pred string, score double")


class Evidence:
    """Which texts can be told to be in no learned language."""

    def __init__(self, prototypes: dict[str, np.ndarray], totals: dict[str, float], dim: int = DIM):
        self.dim, length = dim, {k: max(float(np.linalg.norm(v)), 1e-9) for k, v in prototypes.items()}
        self.unit = np.stack([v / length[k] for k, v in prototypes.items()]) if prototypes else np.zeros((0, dim))
        self.bound = NormalDist().inv_cdf(1 - CHANCE / max(1, len(prototypes)))
        # What an n-gram of a language's own text adds along its prototype; the least of all.
        self.usual = min((length[k] / max(totals[k], 1.0) for k in prototypes), default=0.0)

    def __call__(self, texts: list[str]) -> list[bool]:
        """True for texts that stay."""
        own, stay = space(self.dim), []
        for keys, n in gram_counts(texts, own):
            if not len(self.unit) or not keys.any():
                stay.append(False)
                continue
            n = n.astype(np.float64)
            noise = float(np.linalg.norm(n))
            if SHARE * self.usual * float(n.sum()) < 2 * self.bound * noise:  # too little to judge
                stay.append(True)
                continue
            along = np.zeros(len(self.unit))
            for cut in range(0, len(keys), _CACHED_GRAMS // 2):
                rows = own.grams(keys[cut : cut + _CACHED_GRAMS // 2])
                along += self.unit @ (n[cut : cut + len(rows)].astype(np.float32) @ own.vectors[rows])
            stay.append(bool(along.max() >= self.bound * noise))
        return stay


def keep_identified(docs: DataFrame, prototypes: dict[str, np.ndarray], totals: dict[str, float], dim: int = DIM) -> DataFrame:
    """``docs`` without the rows whose language cannot be told: no letters, nothing
    learned, or enough n-grams to see that they are like no language. No shuffle."""
    evidence = Evidence(prototypes, totals, dim)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _slices(iter([batch]), batch.schema.get_field_index("text")):
                yield part.filter(pa.array(evidence(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, training: Column, dim: int = DIM) -> DataFrame:
    """Learn from the rows where ``training`` holds, predict all rows."""
    return predict(docs, train(docs.filter(training), dim), dim)
