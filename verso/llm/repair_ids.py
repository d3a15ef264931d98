"""Token ids in binary files, compressed by Re-Pair.

``write``: every whole text is encoded with the tokenizers library, one end id is
appended to each document, and the ids go out in ascending ``doc_id`` order as
shards, one row of a Parquet table for each. A shard holds whole documents, about
``shard_tokens`` ids, and is compressed by Re-Pair: adjacent pairs that occur often
are replaced by nonterminals, again and again. One pass replaces many pairs: taken
by falling count, a symbol is used only as the left or only as the right side in a
pass, so replacements never overlap. Stored are the rules, the expansion length of
every rule and the remaining sequence; lengths make any range of ids decodable
without expanding the rest (``read_range``).

``read``: the files back as one row per document with its global start.

The text is range-partitioned by id once (no driver list of ids); starts come from
running sums inside a partition plus one total for each partition.

Encoding: normaliser and pre-tokeniser of the vocabulary never look across a blank
or line feed, so a text is cut there and each word is encoded once per worker and
kept in a bounded cache. Plain words go to the library's BPE model directly, all
else through the library's whole pipeline. Special strings in a text are ordinary
text.

Cases: null text is empty (only the end id). Null ids come first. Documents of equal
id are ordered by text. A text longer than a shard is a shard of its own. An empty
table writes no shards and reads back empty. Other columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verso.llm.common import arrow_map, scratch_path

END_ID = 1
SHARD_TOKENS = 500_000
MIN_COUNT = 8
RULES_A_PASS = 1024
PASSES = 6
CACHE_ENTRIES = 600_000
_TRAILING = ".,!?;:&%"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 10 else b for b in range(256))


class WordCache(dict):
    """word (no blank or line feed in it) -> its ids as little-endian uint32 bytes.
    Words of a Latin-1 text are keyed by their bytes, others by the string."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.vocab = self.whole.get_vocab_size(with_added_tokens=True)
        self.direct = self._model_alone_will_do()

    def _model_alone_will_do(self) -> bool:
        """Whether plain words may skip normaliser and pre-tokeniser: tried out for every
        Latin-1 letter, alone and inside a word."""
        letters = [c for c in map(chr, range(256)) if c.isalpha()]
        words = [w for c in letters for w in (c, f"x{c}y", f"{c}{c}A")] + ["plain", "Upper", "MIXed"]
        return all(self._plain(w) == self.whole.encode(w, add_special_tokens=False).ids for w in words)

    def _plain(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.lower().encode().decode("latin-1").translate(_byte_letters())
        else:
            word = word.lower()
        return [t.id for t in self.model.tokenize(word)]

    def __missing__(self, key: bytes | str) -> bytes:
        word = key.decode("latin-1") if isinstance(key, bytes) else key
        if word.isalpha():
            plain = self.direct and (word.isascii() or max(word) < "\u0100")
            ids = array("I", self._plain(word) if plain else self.whole.encode(word, add_special_tokens=False).ids).tobytes()
        elif (core := word.rstrip(_TRAILING)) != word and core.isalpha() and max(core) < "\u0100":
            # other letters may end in a mark when normalised, and a mark stays with the signs
            ids = self[key[: len(core)]] + self[key[len(core) :]]
        else:
            ids = array("I", self.whole.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[key] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian uint32 bytes."""
        try:
            # Of Latin-1 the normaliser changes white space and letter case only, so
            # lower-casing A-Z first changes nothing, and fewer words differ.
            words = text.encode("latin-1").translate(_LOWER).split(b" ")
        except UnicodeEncodeError:
            words = text.replace("\n", " ").split(" ")
        return b"".join(map(self.__getitem__, words))


@functools.lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's printable stand-in for each byte: printable Latin-1 bytes
    stand for themselves, the others for code points from 256 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(other)) for b in range(256)}


@functools.lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    return WordCache(path)


# --- Re-Pair --------------------------------------------------------------------


def compress(ids: np.ndarray, vocab: int, min_count: int = MIN_COUNT, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, rules, lengths): symbol vocab+i expands to the pair rules[i] and
    to lengths[i] ids."""
    # Pairs are packed in one number; short ones sort faster.
    short = vocab + passes * RULES_A_PASS <= 1 << 16
    kind, bits = (np.uint32, 16) if short else (np.uint64, 32)
    seq = ids.astype(kind)
    rules, size, low = [], vocab, (1 << bits) - 1
    lengths = np.ones(vocab, dtype=np.int64)
    for _ in range(passes):
        if len(seq) < 2 * min_count:
            break
        pair = (seq[:-1] << kind(bits)) | seq[1:]
        order = np.sort(pair)
        head = np.flatnonzero(order[1:] != order[:-1]) + 1  # of all runs but the first
        head = np.concatenate([[0], head])
        count = np.diff(np.append(head, len(order)))
        often = np.flatnonzero(count >= min_count)
        count, keys = count[often], order[head[often]].astype(np.int64)
        unequal = keys >> bits != keys & low
        count, keys = count[unequal], keys[unequal]
        lefts, rights, chosen = set(), set(), []
        top = np.arange(len(keys)) if len(keys) <= 8 * RULES_A_PASS else np.argpartition(-count, 8 * RULES_A_PASS)[: 8 * RULES_A_PASS]
        for key in keys[top[np.lexsort((keys[top], -count[top]))]].tolist():
            a, b = key >> bits, key & low
            if a not in rights and b not in lefts:
                lefts.add(a)
                rights.add(b)
                chosen.append(key)
                if len(chosen) == RULES_A_PASS:
                    break
        if not chosen:
            break
        # Rule of a pair: a small table by the ranks of its sides (0: never a side).
        chosen = np.array(chosen, dtype=np.int64)
        left, right = chosen >> bits, chosen & low
        left_rank, right_rank = np.zeros(size, dtype=np.int32), np.zeros(size, dtype=np.int32)
        left_rank[left], right_rank[right] = 1, 1
        left_rank, right_rank = np.cumsum(left_rank, dtype=np.int32) * left_rank, np.cumsum(right_rank, dtype=np.int32) * right_rank
        width = int(right_rank.max()) + 1
        rule_of = np.full((int(left_rank.max()) + 1) * width, -1, dtype=np.int16)
        rule_of[left_rank[left] * width + right_rank[right]] = np.arange(len(chosen))
        left_rank *= width
        which = rule_of[left_rank[seq[:-1]] + right_rank[seq[1:]]]
        at = np.flatnonzero(which >= 0)
        seq[at] = (size + which[at].astype(np.int64)).astype(kind)
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        seq = seq[keep]
        both = np.stack([left, right], axis=1)
        rules.append(both)
        lengths = np.concatenate([lengths, lengths[both].sum(axis=1)])
        size += len(chosen)
    table = np.concatenate(rules) if rules else np.empty((0, 2), dtype=np.int64)
    return seq, table, lengths[vocab:]


def expand(seq: np.ndarray, rules: np.ndarray, vocab: int) -> np.ndarray:
    """All ids that a sequence stands for: every rule is written out once (rules
    refer to earlier ones only), then each symbol copies its stretch."""
    out: list[list[int]] = []
    for a, b in rules.tolist():
        out.append((out[a - vocab] if a >= vocab else [a]) + (out[b - vocab] if b >= vocab else [b]))
    sizes = np.array([len(x) for x in out], dtype=np.int64)
    flat = np.array([i for x in out for i in x], dtype=np.uint32)
    big = seq >= vocab
    rule = seq[big].astype(np.int64) - vocab
    own = np.ones(len(seq), dtype=np.int64)
    own[big] = sizes[rule]
    ends = np.cumsum(own)
    got = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint32)
    got[(ends - own)[~big]] = seq[~big]
    n = sizes[rule]
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    got[np.repeat((ends - own)[big], n) + inside] = flat[np.repeat((np.cumsum(sizes) - sizes)[rule], n) + inside]
    return got


def read_range(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray, vocab: int, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of a shard, expanding only the symbols that hold them."""
    own = np.ones(len(seq), dtype=np.int64)
    big = seq >= vocab
    own[big] = lengths[seq[big].astype(np.int64) - vocab]
    ends = np.cumsum(own)
    lo, hi = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
    if start >= stop:
        return np.empty(0, dtype=np.int64)
    skip = start - (ends[lo] - own[lo])
    return expand(seq[lo:hi], rules, vocab)[skip : skip + stop - start]


# --- files ----------------------------------------------------------------------

_FILE = "part int, shard int, vocab int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, rules binary, lengths binary, symbol_bytes int, sequence binary"


def _numbers(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{width}")


def shard_row(ids: np.ndarray, vocab: int) -> dict:
    """The stored form of a shard's ids."""
    seq, rules, lengths = compress(ids, vocab)
    width = 2 if vocab + len(rules) <= 1 << 16 else 4
    return {"vocab": vocab, "n_tokens": len(ids), "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(),
            "symbol_bytes": width, "sequence": seq.astype(f"<u{width}").tobytes()}


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode and write all documents as Re-Pair shards below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, shard = word_cache(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        names = [f.split()[0] for f in _FILE.split(", ")]
        types = {"part": pa.int32(), "shard": pa.int32(), "vocab": pa.int32(), "symbol_bytes": pa.int32(), "n_tokens": pa.int64(), "doc_ids": pa.list_(pa.int64()), "doc_tokens": pa.list_(pa.int64())}

        def row(doc_ids: list, held: list[bytes]) -> pa.RecordBatch:
            own = {"part": part, "shard": shard, "doc_ids": doc_ids, "doc_tokens": [len(x) // 4 for x in held]}
            own |= shard_row(np.frombuffer(b"".join(held), dtype="<u4"), max(words.vocab, end_id + 1))
            return pa.RecordBatch.from_arrays([pa.array([own[n]], types.get(n, pa.binary())) for n in names], names=names)

        doc_ids, held, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.encode(text.as_py() or "") + end
                doc_ids.append(doc_id)
                held.append(ids)
                size += len(ids) // 4
                if size >= shard_tokens:
                    yield row(doc_ids, held)
                    doc_ids, held, size, shard = [], [], 0, shard + 1
        if held:
            yield row(doc_ids, held)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    arrow_map(ordered, run, _FILE).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    files = spark.read.schema(_FILE).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                seq, rules = _numbers(r["sequence"], r["symbol_bytes"]), _numbers(r["rules"], 4).reshape(-1, 2).astype(np.int64)
                ids = expand(seq, rules, r["vocab"]).astype("<u4", copy=False)
                n = np.array(r["doc_tokens"], dtype=np.int64)
                stop = np.cumsum(n)
                crc = [zlib.crc32(ids[b - k : b]) for b, k in zip(stop.tolist(), n.tolist())]
                cols = [pa.array([r["part"]] * len(n), pa.int32()), pa.array([r["shard"]] * len(n), pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                        pa.array(stop - n), pa.array(n), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = arrow_map(files, run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    prior = Window.unboundedPreceding
    shards = files.select("part", "shard", "n_tokens")
    inside = shards.withColumn("own", F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(prior, -1)))
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("all"))  # one row for each written partition
    parts = parts.select("part", F.sum("all").over(Window.orderBy("part").rowsBetween(prior, -1)).alias("before"))
    zero = F.lit(0).cast("long")
    starts = inside.join(parts, "part").select("part", "shard", (F.coalesce("own", zero) + F.coalesce("before", zero)).alias("offset"))
    return found.join(starts, ["part", "shard"]).select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-ids")
    write(docs, tokenizer, path, end_id)
    return read(docs.sparkSession, path)
