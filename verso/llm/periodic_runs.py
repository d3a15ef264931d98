"""Periodic runs of words, found on a Re-Pair grammar.

A run is a stretch of words with smallest period q (words q apart are identical), at
least ``max(min_length, 2 q)`` long, that no neighbouring word extends. All runs of a
text are found exactly:

1. A block of whole documents becomes word ids, a separator after each document.
2. Re-Pair: pairs of neighbouring symbols that occur at least twice are replaced by
   nonterminals, again and again, until no pair occurs twice. A pass replaces every
   occurrence that is more frequent than both overlapping neighbours, equal symbols
   from the left. Every replacement is noted: a nonterminal's derivation positions.
   What is left of a document is paired up into a balanced tree above it.
3. Every run crosses the boundary between the two sides of the smallest nonterminal
   that holds it. So for each nonterminal, once, the runs that cross its boundary
   are computed inside its expansion. Half of such a run lies on one side: its period
   is the distance from the first word of the right side to an equal word on the left,
   or from the last word of the left side to an equal one on the right. Each such
   distance is extended both ways, word by word first, then by prefix hashes with
   binary search; whatever is found is compared word by word in the end.
4. The runs go to all derivation positions of their nonterminal; overlapping
   intervals of one period merge to the maximal ones.

Documents never share a run, and the result does not depend on the blocks.

Cases: null or empty text and texts of white space have no words, no runs and an empty
collapsed text. Repeated rows and ids stay repeated; ids may be null; other columns are
ignored. A very long text is a block of its own, and its distances are extended in
slices. An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verso.llm.common import arrow_map

MIN_LENGTH = 12
BLOCK_WORDS = 250_000
_AT_ONCE = 1_000_000  # distances extended at a time
_STEPS = 8  # words compared one by one before hashes are used
_PRIMES = ((1 << 31) - 1, (1 << 31) - 19)


# --- grammar --------------------------------------------------------------------


class Grammar:
    """Nonterminals of a block: for each, the start, boundary and end of one of its
    occurrences in the text, and the starts of all of them."""

    def __init__(self) -> None:
        self._parts: list[tuple[np.ndarray, ...]] = []

    def add(self, start: np.ndarray, middle: np.ndarray, end: np.ndarray, places: np.ndarray, n_places: np.ndarray) -> None:
        self._parts.append((start, middle, end, places, n_places))

    def done(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, middle, end, places, first place of each and the total)."""
        if not self._parts:
            none = np.empty(0, dtype=np.int64)
            return none, none, none, none, np.zeros(1, dtype=np.int64)
        start, middle, end, places, n = (np.concatenate(x) for x in zip(*self._parts))
        return start, middle, end, places, np.concatenate([[0], np.cumsum(n)])


def _runs(key: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before it (and at the first)."""
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    return new


def _offset(new: np.ndarray) -> np.ndarray:
    """Distance of each place from the last True at or before it."""
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _selected(pair: np.ndarray, eligible: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Occurrences (indexes into ``pair``) replaced in a pass: more frequent than the
    overlapping ones before and after; ties by the pair's number. The most frequent pair
    gets all its occurrences."""
    rank = np.where(eligible, count * (int(pair.max()) + 1) + pair, -1)
    before, after = np.full(len(pair), -1, dtype=np.int64), np.full(len(pair), -1, dtype=np.int64)
    before[1:], after[:-1] = rank[:-1], rank[1:]
    return np.flatnonzero((rank >= 0) & (rank > before) & (rank > after))


def grammar(ids: np.ndarray, doc: np.ndarray) -> Grammar:
    """Re-Pair of a block: ``ids`` of all words, ``doc`` the document of each."""
    out = Grammar()
    seq, pos, part = ids.astype(np.int64), np.arange(len(ids)), doc
    size = np.ones(len(ids), dtype=np.int64)
    left_over: list[tuple[np.ndarray, np.ndarray]] = []
    while len(seq) > 1:
        inside = np.flatnonzero(part[1:] == part[:-1])
        # number the pairs by the rank of their key
        seq = np.unique(seq, return_inverse=True)[1] if int(seq.max()) > 1 << 31 else seq
        key = seq[inside] * (int(seq.max()) + 1) + seq[inside + 1]
        order = np.argsort(key, kind="stable")
        pair, count = np.full(len(seq) - 1, -1, dtype=np.int64), np.zeros(len(seq) - 1, dtype=np.int64)
        pair[inside[order]] = np.cumsum(_runs(key[order])) - 1
        # in a a a a only every second pair counts, from the left
        counts = (pair >= 0) & (_offset(_runs(pair)) % 2 == 0)
        count[inside] = np.bincount(pair[counts], minlength=len(inside))[pair[inside]]
        at = _selected(pair, counts & (count > 1), count)
        # a pair that is chosen once in this pass gains nothing
        at = at[np.bincount(pair[at], minlength=len(inside) + 1)[pair[at]] > 1]
        if not len(at):
            break
        by_rule = at[np.argsort(pair[at], kind="stable")]
        head = _runs(pair[by_rule])
        first = by_rule[head]
        ends = np.append(np.flatnonzero(head), len(by_rule))
        out.add(pos[first], pos[first] + size[first], pos[first] + size[first] + size[first + 1], pos[by_rule], np.diff(ends))
        # What follows a pair that occurs once never becomes part of a repeated pair:
        # the sequence is cut there, and symbols that stand alone are set aside.
        joined = count > 1
        seq[by_rule] = int(seq.max()) + np.cumsum(head)
        size[at] += size[at + 1]
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        starts = np.ones(len(seq), dtype=bool)
        starts[1:] = ~joined
        seq, pos, size, part = seq[keep], pos[keep], size[keep], np.cumsum(starts)[keep]
        single = _runs(part)
        single[:-1] &= part[1:] != part[:-1]
        left_over.append((pos[single], size[single]))
        seq, pos, size, part = seq[~single], pos[~single], size[~single], part[~single]
    left_over.append((pos, size))
    pos, size = (np.concatenate(x) for x in zip(*left_over))
    order = np.argsort(pos)
    pos, size = pos[order], size[order]
    own = doc[pos]
    # above it: neighbours of one document in a balanced tree
    while len(pos) > 1:
        new = _runs(own)
        left = np.flatnonzero((_offset(new)[:-1] % 2 == 0) & ~new[1:])
        if not len(left):
            break
        middle = pos[left] + size[left]
        out.add(pos[left], middle, middle + size[left + 1], pos[left], np.ones(len(left), dtype=np.int64))
        size[left] += size[left + 1]
        keep = np.ones(len(own), dtype=bool)
        keep[left + 1] = False
        pos, own, size = pos[keep], own[keep], size[keep]
    return out


# --- extension ------------------------------------------------------------------


@functools.lru_cache(maxsize=2)
def _base(prime: int) -> int:
    return int(np.random.default_rng(prime).integers(1 << 20, prime - 1))


class Prefix:
    """Prefix hashes of a block (two primes), for longest common extensions."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.tables = ids, []
        for prime in _PRIMES:
            power = np.ones(len(ids) + 1, dtype=np.int64)
            have, step = 1, _base(prime)
            while have < len(power):
                more = min(have, len(power) - have)
                power[have : have + more] = power[:more] * step % prime
                have, step = have + more, step * step % prime
            value = np.random.default_rng(prime + 1).integers(1, prime, size=int(ids.max(initial=0)) + 1)[ids]
            self.tables.append((prime, power, np.concatenate([[0], np.cumsum(value * power[:-1] % prime)])))

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from a and from b (a < b) look equal."""
        ok = np.ones(len(a), dtype=bool)
        for prime, power, total in self.tables:
            x = (total[a + n] - total[a]) % prime * power[b - a] % prime
            ok &= x == (total[b + n] - total[b]) % prime
        return ok

    def extend(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """Longest common extension of positions a < b, at most ``most`` words: from
        them on, or of what ends before them."""
        low, high = np.zeros(len(a), dtype=np.int64), most.astype(np.int64)
        for _ in range(int(high.max(initial=0)).bit_length() + 1):
            mid = (low + high + 1) // 2
            ok = self.same(a, b, mid) if forward else self.same(a - mid, b - mid, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def _extensions(ids: np.ndarray, prefix: list[Prefix], a: np.ndarray, b: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
    """``Prefix.extend``, word by word for the first steps."""
    got = np.zeros(len(a), dtype=np.int64)
    alive = np.flatnonzero(most > 0)
    for step in range(_STEPS):
        if not len(alive):
            return got
        shift = step if forward else -1 - step
        alive = alive[ids[a[alive] + shift] == ids[b[alive] + shift]]
        got[alive] += 1
        alive = alive[most[alive] > step + 1]
    if len(alive):
        if not prefix:
            prefix.append(Prefix(ids))
        shift = _STEPS if forward else -_STEPS
        got[alive] += prefix[0].extend(a[alive] + shift, b[alive] + shift, most[alive] - _STEPS, forward)
    return got


def _expanded(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, 0..n-1 inside it) for counts n."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def crossing_runs(ids: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nonterminal, from, to, period): the runs across each boundary, inside start..end."""
    out = []
    big = np.flatnonzero(end - start >= min_length)
    n, prefix = len(ids), []
    order = np.argsort(ids, kind="stable")
    key = ids[order] * n + order  # ascending: all places of a word together
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    for left_heavy in (True, False):
        # words equal to the first of the right side, before it, or to the last of the
        # left side, after it; a period is at most half the expansion
        half = (end[big] - start[big]) // 2
        if left_heavy:
            here = middle[big]
            lowest = np.maximum(start[big], here - half)
            first = np.searchsorted(key, ids[here] * n + lowest)
            many = rank[here] - first
        else:
            here = middle[big] - 1
            highest = np.minimum(end[big], here + half + 1)
            first = rank[here] + 1
            many = np.searchsorted(key, ids[here] * n + highest) - first
        ends = np.cumsum(many)
        lo = 0
        while lo < len(big):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _AT_ONCE, side="right")))
            which, nth = _expanded(many[lo:hi])
            which += lo
            other = order[first[which] + nth]
            a, b = (other, here[which]) if left_heavy else (here[which], other)
            period = b - a
            x, s, e = big[which], start[big[which]], end[big[which]]
            need = np.maximum(min_length - period, period)
            room = (e - s) - period >= need
            # forwards first: most distances end there
            forth = np.zeros(len(a), dtype=np.int64)
            forth[room] = _extensions(ids, prefix, a[room], b[room], e[room] - b[room], True)
            back = np.zeros(len(a), dtype=np.int64)
            left = np.flatnonzero(room & (forth + (a - s) >= need))
            back[left] = _extensions(ids, prefix, a[left], b[left], a[left] - s[left], False)
            good = left[(forth + back)[left] >= need[left]]
            out.append((x[good], (a - back)[good], (b + forth)[good], period[good]))
            lo = hi
    return tuple(np.concatenate(c) for c in zip(*out))


# --- runs -----------------------------------------------------------------------


def _smallest_periods(lo: np.ndarray, hi: np.ndarray, period: np.ndarray, *also: np.ndarray) -> np.ndarray:
    """Indexes of the smallest period of each interval (and ``also``)."""
    order = np.lexsort((period, hi, lo, *also))
    keep = np.zeros(len(order), dtype=bool)
    keep[:1] = True
    for col in (lo, hi, *also):
        keep[1:] |= col[order[1:]] != col[order[:-1]]
    return order[keep]


def merged(lo: np.ndarray, hi: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals: of one period, two that overlap by it are one."""
    order = np.lexsort((-hi, lo, period))
    lo, hi, period = lo[order], hi[order], period[order]
    out_lo, out_hi, out_p = [], [], []
    for a, b, p in zip(lo.tolist(), hi.tolist(), period.tolist()):
        if out_p and out_p[-1] == p and a <= out_hi[-1] - p:
            out_hi[-1] = max(out_hi[-1], b)
        else:
            out_lo.append(a)
            out_hi.append(b)
            out_p.append(p)
    return np.array(out_lo, dtype=np.int64), np.array(out_hi, dtype=np.int64), np.array(out_p, dtype=np.int64)


def _really(ids: np.ndarray, lo: int, hi: int, period: int) -> bool:
    return bool((ids[lo : hi - period] == ids[lo + period : hi]).all())


def block_runs(ids: np.ndarray, doc: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, period) of all runs of a block, by from and period."""
    start, middle, end, places, first_place = grammar(ids, doc).done()
    none = np.empty(0, dtype=np.int64)
    if not len(start):
        return none, none, none
    x, lo, hi, period = crossing_runs(ids, start, middle, end, min_length)
    best = _smallest_periods(lo, hi, period, x)
    x, lo, hi, period = x[best], lo[best], hi[best], period[best]
    true = np.array([_really(ids, a, b, p) for a, b, p in zip(lo.tolist(), hi.tolist(), period.tolist())], dtype=bool)
    if not true.all():
        raise ArithmeticError("two different passages have equal hashes")  # two 31-bit hashes: chance below 1e-12 a block
    # to every place of the nonterminal
    n_places = first_place[x + 1] - first_place[x]
    which, nth = _expanded(n_places)
    shift = places[first_place[x][which] + nth] - start[x][which]
    lo, hi, period = merged(lo[which] + shift, hi[which] + shift, period[which])
    best = _smallest_periods(lo, hi, period)
    best = best[np.lexsort((period[best], lo[best]))]
    return lo[best], hi[best], period[best]


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = got = len(self)
        return got


def runs_of_texts(texts: list[str | None], min_length: int = MIN_LENGTH) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """(words, runs as (start, length, period)) of each text of a block."""
    words = [(t or "").encode().split() for t in texts]  # of bytes: ASCII white space
    table = _Ids()
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    ids = np.array([table[w] for own in words for w in own], dtype=np.int64)
    # documents below the least length cannot hold a run
    doc = np.repeat(np.arange(len(words)), sizes)
    use = (sizes >= min_length)[doc] if len(doc) else np.empty(0, dtype=bool)
    at = np.flatnonzero(use)
    lo, hi, period = block_runs(ids[at], doc[at], min_length)
    starts = np.cumsum(sizes) - sizes
    out = [(w, []) for w in words]
    where = at[lo] if len(lo) else lo
    for d, a, n, p in zip(doc[where].tolist(), (where - starts[doc[where]]).tolist(), (hi - lo).tolist(), period.tolist()):
        out[d][1].append((a, n, p))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats (after its first period)."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for a, n, p in runs:
        keep[a + p : a + n] = False
    return b" ".join(words[i] for i in np.flatnonzero(keep).tolist())


_OUT = pa.schema([
    ("doc_id", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string()),
])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, runs by start and period, collapsed: the text without the repeats, words
    joined by one space), one row for each row of ``docs``; a scan, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(ids: list, texts: list) -> pa.RecordBatch:
            found = runs_of_texts(texts, min_length)
            runs = [[{"start": a, "length": n, "period": p} for a, n, p in r] for _, r in found]
            text = [collapsed(w, r).decode() for w, r in found]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, _OUT.field("runs").type), pa.array(text, pa.string())], schema=_OUT)

        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = text.as_py()
                ids.append(doc_id)
                texts.append(t)
                size += len(t or "") // 6 + 1  # about its words
                if size >= block_words:
                    yield solve(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield solve(ids, texts)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(narrow, run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


# --- the query's texts and digests ----------------------------------------------


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h = crc32 of the decimal id, every text of h % 10 = 0 and n > 0
    words becomes periodic from word a = g % n on (g = h // 10), with period
    1 + (n - a) // (3 + g % 8). Rows without an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", chosen.alias("chosen"), g.alias("g"), F.when(chosen, words).alias("words"))
    rows = rows.withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    edited = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))))
    text = F.when(F.col("chosen") & (F.col("n") > 0), F.array_join(edited, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of the output of ``find``."""
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period")))
    top = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    length = -top["length"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), length.alias("length"), top["period"].alias("period"),
        F.floor(F.lit(1000) * length / top["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
