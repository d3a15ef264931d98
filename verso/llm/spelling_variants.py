"""Spelling variants: words one edit apart, grouped by a frequency-vector trie.

``word_counts``: maximal runs of letters, A-Z lower-cased, counted over whole texts.

``near``: two words are near if they differ by one inserted, deleted or replaced code
point. A word is arranged by how often each group of letters occurs in it: its
frequency vector. One edit moves such a vector by at most one surplus and one deficit
(a replacement spends both, a deletion a deficit only). The words of a shard form a
trie, a level for each group; a depth-first search carries the queries that can still
pay for the way, each with its budget of one surplus and one deficit, and the words at
the leaves are verified letter by letter.

The first levels of the trie are its shards: the length and the counts of the first
``levels`` groups. A word is a member of one shard and a query of the shards that its
budget reaches: of its own length (from the smaller shard to the larger, so a pair is
met once) and one letter shorter. ``levels`` grows with the number of words, which keeps
shards near ``shard_target`` words; the pairs found do not depend on it. A shard above
``max_tree`` words becomes several tries and every query of the shard visits each; one
above ``max_queries`` is dealt to several tasks, each with a copy of the trie. Members
come first in a task and queries are searched in slices, so memory is bounded by a
trie and a slice. A task sends one row for each word with a hit (number of near words
and the best of them), not one for each pair.

``forms``: a word's form is its near word of largest count if that is at least twice its
own; the root follows forms to the last by pointer doubling (counts at least double on
the way, so a chain is short).

Cases: null and empty texts have no words. A word repeated in one text counts each time;
repeated rows count again. Of equally frequent near words the smallest in code-point
order is the form. An empty table gives no rows. Very long texts are read whole, in
pieces cut between words; very long words are ordinary words. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verso.llm.common import arrow_map, written

MIN_CHARS = 5
MIN_COUNT = 3
GROUPS = 12
LEAF = 8
SHARD_TARGET = 10_000
MAX_TREE = 20_000
MAX_QUERIES = 10_000
_SLICE = 20_000
_PAIRS_AT_ONCE = 500_000
_HELD_WORDS = 300_000
_PIECE = 1 << 20

# --- words ----------------------------------------------------------------------

# Latin-1 bytes: letters stay (A-Z lower-cased), all else is a blank.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def _pieces(text: str) -> Iterator[bytes]:
    """A text's letters as Latin-1 bytes with blanks between words; long texts in pieces
    that end between words. No code point above U+00FF is a letter here."""
    raw = text.encode("latin-1", "replace").translate(_LETTERS)
    at = 0
    while len(raw) - at > _PIECE:
        end = raw.rfind(b" ", at, at + _PIECE)
        end = end if end > at else raw.find(b" ", at + _PIECE)
        if end < 0:
            break
        yield raw[at:end]
        at = end
    yield raw[at:]


def one_deleted(doc_id: int | None, word: bytes, prefix: int) -> bytes:
    """The word without one letter, if the crc32 of ``<doc_id>:<word>`` says so.
    ``prefix``: the crc32 of ``<doc_id>:``. Only the queries' planted misspellings."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, planted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over all texts. ``planted``: with ``one_deleted`` misspellings (a null id
    is empty in the hash). Counted in bounded tables in the tasks, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        total: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for piece in _pieces(text.as_py() or ""):
                    for word, n in Counter(piece.split()).items():
                        if planted:
                            word = one_deleted(doc_id, word, prefix)
                        total[word] = total.get(word, 0) + n
                    if len(total) > _HELD_WORDS:
                        yield out()
                        total = {}
        yield out()

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(narrow, run, "word string, n long").where("word != ''").groupBy("word").agg(F.sum("n").alias("n"))


# --- vectors --------------------------------------------------------------------


def letter_groups(groups: int = GROUPS) -> np.ndarray:
    """Group of each code point (modulo 1024): common letters have a group each or
    nearly, the others share."""
    table = np.arange(1024) % groups
    for i, letter in enumerate("etaonirshdlucmfpgwybvkxjqz"):
        table[ord(letter)] = i % groups
    return table


def letters_of(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(words), length)


def vectors(letters: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Frequency vector of each row: how many of its letters are in each group."""
    n, length = letters.shape
    cell = letter_groups(groups)[letters % 1024] + np.arange(n)[:, None] * groups
    return np.bincount(cell.ravel(), minlength=n * groups).reshape(n, groups)


def levels_for(words: int, shard_target: int = SHARD_TARGET) -> int:
    """Number of groups in the shard key: the length cuts shards to about an eighth, each
    level to about a half."""
    return min(6, max(1, math.ceil(math.log2(max(1, words) / shard_target)) - 3))


def _key(counts: np.ndarray) -> np.ndarray:
    """Shard number of the first counts; above 255 they share a shard."""
    out = np.zeros(len(counts), dtype=np.int64)
    for level in range(counts.shape[1]):
        out |= np.minimum(counts[:, level], 255) << (8 * level)
    return out


def targets(counts: np.ndarray) -> Iterator[tuple[bool, np.ndarray]]:
    """(shorter, shard) for every way to spend the budget on the first levels: a deficit
    in one group or in none of them and, at equal length, the same for a surplus."""
    levels = counts.shape[1]
    for less in range(-1, levels):
        for more in range(-1, levels):
            if less == more >= 0:
                continue
            moved = counts.copy()
            if less >= 0:
                moved[:, less] -= 1
            if more >= 0:
                moved[:, more] += 1
            shard = np.where((moved >= 0).all(axis=1), _key(np.maximum(moved, 0)), -1)
            yield False, shard
            if more < 0:
                yield True, shard


# --- trie -----------------------------------------------------------------------


class Trie:
    """Words of one length, arranged by frequency vector; a node is a range of them."""

    def __init__(self, words: list[str], n: np.ndarray, length: int, groups: int = GROUPS):
        letters = letters_of(words, length)
        vector = vectors(letters, groups)
        order = np.lexsort(vector.T[::-1])
        self.words, self.n = [words[i] for i in order.tolist()], n[order]
        self.letters, self.vector, self.length, self.groups = letters[order], vector[order], length, groups

    def candidates(self, vector: np.ndarray, surplus: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, words) that meet at a leaf within the budget: a deficit of one and,
        if ``surplus``, a surplus of one."""
        alive = np.arange(len(vector))
        may_more, may_less = np.full(len(alive), surplus), np.ones(len(alive), dtype=bool)
        todo = [(0, len(self.words), 0, alive, may_more, may_less)]
        while todo:
            lo, hi, level, alive, may_more, may_less = todo.pop()
            if level == self.groups or hi - lo <= LEAF:
                step = max(1, _PAIRS_AT_ONCE // (hi - lo))
                for cut in range(0, len(alive), step):
                    some = alive[cut : cut + step]
                    yield np.repeat(some, hi - lo), np.tile(np.arange(lo, hi), len(some))
                continue
            column = self.vector[lo:hi, level]
            edge = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1, [hi - lo]]).tolist()
            asked = vector[alive, level]
            for a, b in zip(edge[:-1], edge[1:]):
                off = column[a] - asked
                ok = (off == 0) | ((off == 1) & may_more) | ((off == -1) & may_less)
                if ok.any():
                    off = off[ok]
                    todo.append((lo + a, lo + b, level + 1, alive[ok], may_more[ok] & (off != 1), may_less[ok] & (off != -1)))

    def near(self, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, words) one edit apart; the queries are as long or one longer."""
        longer = letters.shape[1] > self.length
        for q, w in self.candidates(vectors(letters, self.groups), not longer):
            x, y = letters[q], self.letters[w]
            if longer:  # a common start and a common end cover the shorter word
                start = np.logical_and.accumulate(x[:, :-1] == y, axis=1).sum(axis=1)
                end = np.logical_and.accumulate((x[:, 1:] == y)[:, ::-1], axis=1).sum(axis=1)
                hit = start + end >= self.length
            else:
                hit = (x != y).sum(axis=1) == 1
            if hit.any():
                yield q[hit], w[hit]


class _Best:
    """Number of near words and the most frequent of them, for numbered words."""

    def __init__(self, size: int):
        self.count, self.n, self.form = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64), [None] * size

    def add(self, of: np.ndarray, n: np.ndarray, rank: np.ndarray, words: list[str], which: np.ndarray) -> None:
        """``words[which]`` with count n is near number ``of``; rank: their order."""
        np.add.at(self.count, of, 1)
        order = np.lexsort((rank, -n, of))
        first = order[np.concatenate([[True], of[order[1:]] != of[order[:-1]]])]
        for i, k, j in zip(of[first].tolist(), n[first].tolist(), which[first].tolist()):
            word = words[j]
            if self.form[i] is None or k > self.n[i] or (k == self.n[i] and word < self.form[i]):
                self.n[i], self.form[i] = k, word

    def rows(self, words: list[str], own: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(self.count).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in at], pa.string()), pa.array(own[at], pa.int64()), pa.array(self.count[at]),
             pa.array([self.form[i] for i in at], pa.string()), pa.array(self.n[at])], names=_FOUND)


_FOUND = ["word", "n", "n_near", "form", "form_n"]


def _ranks(words: list[str]) -> np.ndarray:
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)] = np.arange(len(words))
    return rank


def _searched(trie: Trie, member_rank: np.ndarray, best: _Best, words: list[str], n: np.ndarray, twin: np.ndarray) -> pa.RecordBatch:
    """A slice of queries of one length against a trie; hits go to ``best`` for the trie's
    words and out for the queries. ``twin``: the query's own shard, where a pair is met
    from both sides and counts from the larger word only."""
    asked, rank = _Best(len(words)), _ranks(words)
    for q, w in trie.near(letters_of(words, len(words[0]))):
        if twin.any():
            once = np.array([not t or words[i] > trie.words[j] for i, j, t in zip(q.tolist(), w.tolist(), twin[q].tolist())], dtype=bool)
            q, w = q[once], w[once]
            if not len(q):
                continue
        asked.add(q, trie.n[w], member_rank[w], trie.words, w)
        best.add(w, n[q], rank[q], words, q)
    return asked.rows(words, n)


def near(words: DataFrame, levels: int | None = None, max_tree: int = MAX_TREE, max_queries: int = MAX_QUERIES, groups: int = GROUPS) -> DataFrame:
    """(word, n, n_near, form, form_n) for every word of ``words`` (word, n; distinct) that
    has a near word: how many, and the most frequent one."""
    levels = levels or levels_for(words.count())

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["length", "shard", "kind", "word", "n"]
        for batch in batches:
            text = batch.column(0).to_pylist()
            sizes = np.array([len(w) for w in text], dtype=np.int64)
            for length in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == length)
                own, n = batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))
                counts = vectors(letters_of([text[i] for i in at.tolist()], length), groups)[:, :levels]
                home, seen = _key(counts), set()

                def rows(size: int, shard: np.ndarray, kind: int, ok: np.ndarray) -> pa.RecordBatch:
                    pick = pa.array(np.flatnonzero(ok))
                    n_ok = len(pick)
                    cols = [pa.array(np.full(n_ok, size, np.int32)), pa.array(shard[ok]), pa.array(np.full(n_ok, kind, np.int32)), own.take(pick), n.take(pick)]
                    return pa.RecordBatch.from_arrays(cols, names=names)

                yield rows(length, home, 0, np.ones(len(at), dtype=bool))
                met = {True: [], False: []}
                for shorter, shard in targets(counts):
                    ok = (shard >= 0) if shorter else (shard >= home)
                    for other in met[shorter]:  # counts above 255 share a shard: go there once
                        ok &= shard != other
                    met[shorter].append(shard)
                    if shorter and length == 1:
                        continue
                    if shorter:
                        yield rows(length - 1, shard, 3, ok)
                    else:
                        yield rows(length, shard, 1, ok & (shard == home))
                        yield rows(length, shard, 2, ok & (shard > home))

    rows = arrow_map(words.select("word", "n"), dealt, "length int, shard long, kind int, word string, n long")
    is_member = F.col("kind") == 0
    sizes = rows.groupBy("length", "shard").agg(F.count_if(is_member).alias("members"), F.count_if(~is_member).alias("queries"))
    large = sizes.select("length", "shard", *[F.ceil(F.greatest(F.col(c) / most, F.lit(1))).cast("int").alias(to) for c, most, to in (("members", max_tree, "trees"), ("queries", max_queries, "copies"))])
    large = large.where("trees > 1 OR copies > 1")
    own = lambda of: F.array(F.pmod(F.xxhash64("word"), F.col(of)).cast("int"))
    every = lambda of: F.sequence(F.lit(0), F.col(of) - 1)
    spread = (
        rows.join(large, ["length", "shard"], "left")
        .withColumns({c: F.coalesce(c, F.lit(1)) for c in ("trees", "copies")})
        .withColumn("tree", F.explode(F.when(is_member, own("trees")).otherwise(every("trees"))))
        .withColumn("copy", F.explode(F.when(is_member, every("copies")).otherwise(own("copies"))))
        .drop("trees", "copies")
        .repartition("length", "shard", "tree", "copy")
        .sortWithinPartitions("length", "shard", "tree", "copy", "kind")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, members, trie, rank, best, queries = None, [], None, None, None, []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal queries
            for longer in (False, True):
                own = [(w, n, kind == 1) for w, n, kind in queries if (kind == 3) == longer]
                if own:
                    text, n, twin = zip(*own)
                    yield _searched(trie, rank, best, list(text), np.array(n, dtype=np.int64), np.array(twin, dtype=bool))
            queries = []

        def finish() -> Iterator[pa.RecordBatch]:
            if trie is not None:
                yield from flush()
                yield best.rows(trie.words, trie.n)

        for batch in batches:
            for *key, kind, word, n in zip(*(c.to_pylist() for c in (batch.column(x) for x in ("length", "shard", "tree", "copy", "kind", "word", "n")))):
                if key != here:
                    yield from finish()
                    here, members, trie, queries = key, [], None, []
                if kind == 0:
                    members.append((word, n))
                elif members:
                    if trie is None:
                        text, own = zip(*members)
                        trie = Trie(list(text), np.array(own, dtype=np.int64), key[0], groups)
                        rank, best = _ranks(trie.words), _Best(len(trie.words))
                    queries.append((word, n, kind))
                    if len(queries) >= _SLICE:
                        yield from flush()
        yield from finish()

    found = arrow_map(spread, search, "word string, n long, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


# --- forms and roots ------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of the chain, by pointer doubling. A word
    that is nobody's key ends a chain."""
    at = written(forms.select("word", F.col("form").alias("root"), F.lit(False).alias("done")), "roots")
    while not at.where("NOT done").isEmpty():
        on = at.select(F.col("word").alias("root"), F.col("root").alias("_next"), F.col("done").alias("_done"))
        moved = at.where("NOT done").join(on, "root", "left")
        moved = moved.select("word", F.coalesce("_next", "root").alias("root"), F.coalesce("_done", F.lit(True)).alias("done"))
        at = written(at.where("done").unionByName(moved), "roots")
    return at.select("word", "root")


def variants(counts: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = 2, **search) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of ``counts`` (word, n) with at
    least ``min_chars`` code points and ``min_count`` occurrences; a form is at least
    ``ratio`` times as frequent as the word."""
    words = written(counts.where((F.char_length("word") >= min_chars) & (F.col("n") >= min_count)), "words")
    found = written(near(words, **search), "near-words")
    formed = found.withColumn("ok", F.col("form_n") >= F.col("n") * ratio)
    ends = roots(formed.where("ok").select("word", "form"))
    of = formed.select("word", "n_near", F.when(F.col("ok"), F.col("form")).alias("form"), F.when(F.col("ok"), F.col("form_n")).alias("form_n"))
    out = words.join(of, "word", "left").join(ends, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
