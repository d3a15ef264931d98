"""Byte-level BPE encoding and decoding with a vectorised pre-tokeniser.

The split pattern of the vocabulary,

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

is run without a regex engine, over all texts of a batch at once:

1. every code point becomes a character class (one table look-up);
2. every class is a transition function on the states of a small automaton.
   The functions form a finite monoid, so their composition is one table look-up
   and the state before and after each character comes from an associative prefix
   scan (blocks in step, then the block totals, recursively);
3. a token starts where (state before, state after) says so; two cases look one
   character ahead: the letter after an apostrophe and the last white space.

Each slice goes through a cache of finished pair merges (bounded); a miss merges
by rank, with a heap for long slices. Token byte offsets are kept, so any range of
tokens can be decoded or mapped back to the text.

Cases: null text counts as empty: no ids, and the digest of no bytes. Null ids and
repeated rows keep their rows. Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verso.llm.common import arrow_map

CACHE_ENTRIES = 400_000
CACHED_CHARS = 64
CHARS_AT_ONCE = 2_000_000

# Code points of the White_Space property.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Classes of characters. Letters that can follow an apostrophe have their own.
OTHER, APOS, LETTER, STMD, R, E, V, ELL, NUMBER, WHITE, SPACE = range(11)
# States: what is open after a character. Q: an apostrophe that starts a token;
# QR, QV, QL: the letter after it, if a second could complete 're, 've, 'll;
# DONE: a complete contraction.
START, IN_L, IN_N, IN_O, IN_W, IN_S, Q, QR, QV, QL, DONE = range(11)
_STATES = _CLASSES = 11


@functools.lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = WHITE
    table[0x20] = SPACE
    table[0x27] = APOS
    for letters, kind in (("stmd", STMD), ("r", R), ("e", E), ("v", V), ("l", ELL)):
        table[[ord(x) for x in letters]] = kind
    return table


def step(state: int, kind: int) -> int:
    """The automaton."""
    if kind == SPACE:
        return IN_S
    if kind == WHITE:
        return IN_W
    if kind == NUMBER:
        return IN_N
    if kind == OTHER:
        return IN_O
    if kind == APOS:
        return IN_O if state in (IN_O, IN_S, Q) else Q
    if state == Q:
        return {STMD: DONE, R: QR, V: QV, ELL: QL}.get(kind, IN_L)
    if (state, kind) in ((QR, E), (QV, E), (QL, ELL)):
        return DONE
    return IN_L


# What (state before, state after) says about a token starting here.
NO, YES, UNLESS_DONE_NEXT, IF_LAST_WHITE = range(4)


def _start(before: int, after: int) -> int:
    if after in (IN_S, IN_W):
        return IF_LAST_WHITE if before in (IN_S, IN_W) else YES
    if after in (QR, QV, QL):
        return UNLESS_DONE_NEXT
    if after == DONE:
        return NO
    if after == IN_L:
        return NO if before in (IN_L, QR, QV, QL, IN_S) else YES
    if after == IN_N:
        return NO if before in (IN_N, IN_S) else YES
    if after == IN_O:
        return NO if before in (IN_O, IN_S, Q) else YES
    return YES


@functools.lru_cache(maxsize=1)
def _monoid() -> tuple[np.ndarray, ...]:
    """(generator of each class, of each class at a text's start; composition
    table; start table; effect of each element on each state)."""
    gens = [tuple(step(s, c) for s in range(_STATES)) for c in range(_CLASSES)]
    first = [(step(START, c),) * _STATES for c in range(_CLASSES)]
    found = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(_STATES)), *gens, *first]))}
    todo = list(found)
    while todo:  # close under "then"
        f = todo.pop()
        for g in [*gens, *first]:
            fg = tuple(g[x] for x in f)
            if fg not in found:
                found[fg] = len(found)
                todo.append(fg)
    elements = list(found)
    table = np.array([[found[tuple(g[x] for x in f)] for g in elements] for f in elements], dtype=np.int32)
    starts = np.array([[_start(b, a) for a in range(_STATES)] for b in range(_STATES)], dtype=np.uint8)
    return np.array([found[g] for g in gens], np.int32), np.array([found[g] for g in first], np.int32), table, starts, np.array(elements, dtype=np.uint8)


def scan(fns: np.ndarray, block: int = 64) -> np.ndarray:
    """Inclusive prefix compositions of monoid elements."""
    table = _monoid()[2]
    size, flat = len(table), table.ravel()
    n = len(fns)
    if n <= 1:
        return fns.astype(np.int32)
    blocks = -(-n // block)
    grid = np.zeros(blocks * block, dtype=np.int32)  # element 0 is the identity
    grid[:n] = fns
    grid = np.ascontiguousarray(grid.reshape(blocks, block).T)
    for t in range(1, block):
        grid[t] = flat[grid[t - 1] * size + grid[t]]
    if blocks > 1:
        before = np.zeros(blocks, dtype=np.int32)
        before[1:] = scan(grid[-1], block)[:-1]
        grid = flat[before[None, :] * size + grid]
    return grid.T.ravel()[:n]


def token_starts(cp: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Positions where a token starts, over texts laid end to end (``text_starts``:
    positions of the first character of every text that has one)."""
    n = len(cp)
    if not n:
        return np.empty(0, dtype=np.int64)
    gens, firsts, _, table, effect = _monoid()
    kinds = class_table()[cp]
    fns = gens[kinds]
    fns[text_starts] = firsts[kinds[text_starts]]
    after = effect[scan(fns), START]
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[text_starts] = START
    says = table[before, after]
    first = np.zeros(n + 1, dtype=bool)
    first[text_starts] = True
    first[n] = True
    done_next = np.zeros(n, dtype=bool)
    done_next[:-1] = after[1:] == DONE
    done_next &= ~first[1:]
    white = (after == IN_S) | (after == IN_W)
    last_white = np.zeros(n, dtype=bool)
    last_white[:-1] = white[:-1] & ~white[1:]
    last_white &= ~first[1:]
    return np.flatnonzero((says == YES) | ((says == UNLESS_DONE_NEXT) & ~done_next) | ((says == IF_LAST_WHITE) & last_white))


class Merger(dict):
    """slice -> its ids as little-endian uint32 bytes; a miss merges pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(merge(piece.encode("utf-8"), self.ranks), dtype="<u4").tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


def merge(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: repeatedly join the leftmost adjacent pair of lowest rank."""
    if (known := ranks.get(raw)) is not None:
        return [known]
    if len(raw) > 500:
        return _merge_long(raw, ranks)
    none, get = 1 << 40, ranks.get
    cut = list(range(len(raw) + 1))
    rank = [get(raw[i : i + 2], none) for i in range(len(raw) - 1)]
    while rank:
        low = min(rank)
        if low == none:
            break
        i = rank.index(low)
        del cut[i + 1], rank[i]
        if i < len(rank):
            rank[i] = get(raw[cut[i] : cut[i + 2]], none)
        if i:
            rank[i - 1] = get(raw[cut[i - 1] : cut[i + 1]], none)
    return [ranks[raw[a:b]] for a, b in zip(cut, cut[1:])]


def _merge_long(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(raw)
    end, prev = list(range(1, n + 1)), list(range(-1, n - 1))  # by start position
    alive = bytearray(b"\1" * n)
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := end[i]) >= n or end[j] != stop:
            continue
        alive[j] = 0
        end[i] = stop
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(raw[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := prev[i]) >= 0 and (r := ranks.get(raw[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[raw[i : end[i]]])
        i = end[i]
    return out


class Codec:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.merger = Merger(self.ranks)
        size = max(self.ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        self.len_of = np.zeros(size, dtype=np.int64)
        for token, i in self.ranks.items():
            self.bytes_of[i], self.len_of[i] = token, len(token)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        joined = "".join(texts)
        cp = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        stop = np.cumsum(sizes)
        at = token_starts(cp, (stop - sizes)[sizes > 0])
        cuts = [*at.tolist(), len(cp)]
        pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        upto = np.searchsorted(at, stop).tolist()
        look = self.merger.__getitem__
        return [b"".join(map(look, pieces[a:b])) for a, b in zip([0, *upto], upto)]

    def offsets(self, ids: bytes) -> np.ndarray:
        """Byte offset in the text at which each token starts, and the text's end."""
        return np.concatenate([[0], np.cumsum(self.len_of[np.frombuffer(ids, dtype="<u4")])])

    def decode(self, ids: bytes, start: int = 0, stop: int | None = None) -> bytes:
        """Bytes of a range of tokens."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4")[start:stop].tolist()))


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(doc_ids, ids of each) for slices of a batch of bounded size."""
    for batch in batches:
        lo, held, size = 0, [], 0
        for i, t in enumerate(batch.column(1)):
            held.append(t.as_py() or "")
            size += len(held[-1])
            if size >= CHARS_AT_ONCE or i + 1 == batch.num_rows:
                yield batch.column(0).slice(lo, len(held)), codec(path).encode(held)
                lo, held, size = i + 1, [], 0


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, offsets): token ids, and each token's byte offset in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for doc_ids, coded in _encoded(batches, path):
            ids = pa.array([np.frombuffer(x, dtype="<u4").astype(np.int32) for x in coded], pa.list_(pa.int32()))
            offsets = pa.array([own.offsets(x)[:-1] for x in coded], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([doc_ids, ids, offsets], names=["doc_id", "ids", "offsets"])

    return arrow_map(_narrow(docs), run, "doc_id long, ids array<int>, offsets array<long>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """(doc_id, decoded): the bytes that ``ids`` stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            out = [own.decode(np.array(x.as_py() or [], dtype="<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return arrow_map(coded.select("doc_id", "ids"), run, "doc_id long, decoded binary")


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): ids to train on, with the
    digests of ``digests``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for doc_ids, coded in _encoded(batches, path):
            sizes = np.array([0, *(len(x) // 4 for x in coded)], dtype=np.int32)
            flat = np.frombuffer(b"".join(coded), dtype="<i4")
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(sizes[1:].astype(np.int64)), ids, *_shas(own, coded)], names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return arrow_map(_narrow(docs), run, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")


def _shas(own: Codec, coded: list[bytes]) -> list[pa.Array]:
    sha = hashlib.sha256
    return [pa.array([sha(x).hexdigest() for x in coded], pa.string()), pa.array([sha(own.decode(x)).hexdigest() for x in coded], pa.string())]


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what ``encode`` then
    ``decode`` give, digested in the task, so that ids and texts stay there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for doc_ids, coded in _encoded(batches, path):
            sizes = pa.array([len(x) // 4 for x in coded], pa.int64())
            yield pa.RecordBatch.from_arrays([doc_ids, sizes, *_shas(own, coded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(_narrow(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
