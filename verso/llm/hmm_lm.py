"""Hidden Markov language model: Baum-Welch over partitions, exact scoring.

Words (ASCII lower case, split at ASCII white space) are counted over all training
texts; the table of counts stays in Spark. The ``HEAD`` most frequent words (whole
steps of a log-scaled count histogram, so no tie is cut) go to every task; the
``OWN`` first have a symbol of their own, any other word emits the symbol of its
class (length, kind, hashed ending) and then the word given the class,
(c+1)/(class tokens + class words + 1), with one place for all unseen words.

Baum-Welch runs on the symbols of all training texts. Each task adds the expected
counts of its rows, scaled to whole numbers so that Spark's sums do not depend on
their order, and the driver gets states x symbols numbers an iteration. Expected
counts are taken over stretches of at most ``STRETCH`` tokens, where a later stretch
starts from the stationary distribution; only training does that. Scoring runs the
scaled forward recursion over each whole text, so a score is the exact log10
probability of the text under the model.

``base_score`` needs the count of every word: head words have it in the task, all
others go through one join with the table of counts. Only those words are shuffled.

Cases: null text is empty (one end token). Null ids are in no fold and count as
training; repeated rows are rows. With no training rows all counts are zero. Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verso.llm.common import arrow_map, ship, written

STATES = 8
OWN = 4096
HEAD = 131_072
ENDINGS, KINDS, LENGTHS = 32, 4, 4
CLASSES = ENDINGS * KINDS * LENGTHS
ITERATIONS = 4
STRETCH = 256
END = b""
_SIGNS = b".,;:!?&%\"')"
_SEED = 11
_FLUSH = 400_000
_TOKENS_AT_ONCE = 400_000
_UNIT = 1 << 20  # of expected counts as whole numbers
_STEPS = 8  # of the count histogram, for each doubling


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


def word_class(word: bytes) -> int:
    core = word.rstrip(_SIGNS)
    if len(word.translate(None, b"0123456789")) < len(word):
        kind = 2
    elif len(core) < len(word):
        kind = 1
    else:
        kind = 0 if word.isascii() else 3
    n = len(core)
    length = 0 if n <= 4 else 1 if n <= 7 else 2 if n <= 11 else 3
    return (length * KINDS + kind) * ENDINGS + zlib.crc32(core[-3:]) % ENDINGS


# --- counts ---------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, cls, c) over the column ``text``; the end token is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(counts: Counter) -> pa.RecordBatch:
            cls = pa.array([word_class(w) for w in counts], pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), cls, pa.array(list(counts.values()), pa.int64())], names=["word", "cls", "c"])

        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                counts.update(words(t.as_py()))
                counts[END] += 1
                if len(counts) > _FLUSH:
                    yield flush(counts)
                    counts = Counter()
        if counts:
            yield flush(counts)

    return arrow_map(texts.select(F.col("text").cast("string")), run, "word binary, cls int, c long").groupBy("word", "cls").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Corpus totals and the head words, bounded by ``head`` + 1."""

    def __init__(self, counts: DataFrame, head: int = HEAD, own: int = OWN):
        step = F.floor(F.log2("c") * _STEPS).cast("int")
        bins = {r.s: (r.n, r.t) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n"), F.sum("c").alias("t")).collect()}
        self.tokens, self.distinct = sum(t for _, t in bins.values()), sum(n for n, _ in bins.values())
        least, room = max(bins, default=0) + 1, head
        for s in sorted(bins, reverse=True):
            if (room := room - bins[s][0]) < 0:
                break
            least = s
        top = counts.filter((step >= least) | (F.length("word") == 0)).collect()
        top.sort(key=lambda r: (len(r.word) > 0, -r.c, bytes(r.word)))
        top = [(bytes(r.word), r.cls, r.c) for r in top] or [(END, word_class(END), 0)]
        self.own = min(own, len(top))
        self.symbols = self.own + CLASSES
        # Tokens and words of each class, without the words that have a symbol.
        totals = {r.cls: (r.t, r.n) for r in counts.groupBy("cls").agg(F.sum("c").alias("t"), F.count("*").alias("n")).collect()}
        size = np.zeros((CLASSES, 2))
        for k, v in totals.items():
            size[k] = v
        for w, k, c in top[: self.own]:
            size[k] -= (c, c > 0)
        self.class_tokens = size[:, 0]
        self.class_size = size.sum(axis=1) + 1
        self.index = {w: i for i, (w, _, _) in enumerate(top)}
        c = np.array([c for *_, c in top], dtype=np.float64)
        cls = np.array([k for _, k, _ in top])
        self.counts = c
        self.log_all = math.log10(self.tokens + self.distinct + 1)
        self.base = np.log10(c + 1) - self.log_all
        self.symbol = np.where(np.arange(len(top)) < self.own, np.arange(len(top)), self.own + cls)
        self.inside = np.where(np.arange(len(top)) < self.own, 0.0, np.log10(c + 1) - np.log10(self.class_size[cls]))

    def unigram(self) -> np.ndarray:
        weight = np.concatenate([self.counts[: self.own], self.class_tokens]) + 0.5
        return weight / weight.sum()


def encode(docs: DataFrame, vocabulary: Vocabulary, held_out: Column) -> DataFrame:
    """One row per document: symbols (little-endian uint16), sums over its head
    words, and its other words with their number and class size."""
    schema = ("row long, doc_id long, held_out boolean, n_tokens long, symbols binary, head_known long, head_base double, head_inside double, "
              "rest array<struct<word:binary,n:long,size:double>>")  # fmt: skip
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, part, row = sent.value, TaskContext.get().partitionId(), 0
        get, end = v.index.get, v.index[END]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.float64()]
        names = ["row", "doc_id", "held_out", "n_tokens", "symbols", "head_known", "head_base", "head_inside", "rest"]
        in_training = v.counts > 0
        for batch in batches:
            # Other words of all documents end to end, and where each document's begin.
            out, size, others, numbers, classes, begin = [], 0, [], [], [], [0]
            ids, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for i, t in enumerate(batch.column("text")):
                ws = words(t.as_py())
                ws.append(END)
                at = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
                unknown = np.flatnonzero(at < 0)
                known = at if not len(unknown) else at[at >= 0]
                symbols = v.symbol[at]
                if len(unknown):
                    found = [ws[p] for p in unknown.tolist()]
                    rest = Counter(found)
                    cls = {w: word_class(w) for w in rest}
                    symbols[unknown] = [v.own + cls[w] for w in found]
                    others.extend(rest)
                    numbers.extend(rest.values())
                    classes.extend(cls.values())
                begin.append(len(others))
                out.append((part << 40 | row, ids[i], held[i], len(at), symbols.astype("<u2").tobytes(), int(in_training[known].sum()), float(v.base[known].sum()), float(v.inside[known].sum())))
                row, size = row + 1, size + len(at)
                if size >= _TOKENS_AT_ONCE or i + 1 == batch.num_rows:
                    sizes = v.class_size[np.array(classes, dtype=np.int64)]
                    struct = pa.StructArray.from_arrays([pa.array(others, pa.binary()), pa.array(numbers, pa.int64()), pa.array(sizes)], names=["word", "n", "size"])
                    rest_column = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), struct)
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*out), kinds)), rest_column], names=names)
                    out, size, others, numbers, classes, begin = [], 0, [], [], [], [0]

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    return arrow_map(narrow, run, schema)


# --- the model ------------------------------------------------------------------


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # emit: symbols x states

    @classmethod
    def first(cls, unigram: np.ndarray, states: int = STATES) -> Model:
        """Sticky states whose emissions are the unigram, disturbed."""
        rng = np.random.default_rng(_SEED)
        move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        emit = unigram[:, None] * rng.uniform(0.5, 1.5, (len(unigram), states))
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    def stationary(self) -> np.ndarray:
        p = np.full(len(self.start), 1 / len(self.start))
        for _ in range(200):
            p = p @ self.move
        return p / p.sum()


def expected_counts(model: Model, stretches: list[np.ndarray], first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(start, move, emit counts, log-likelihood) of forward-backward over short
    symbol sequences; ``first``: which of them begin a text. Single precision:
    every step is scaled, and the counts are added up in double."""
    order = np.argsort([-len(s) for s in stretches], kind="stable")
    size = np.array([len(stretches[i]) for i in order])
    first, n, k, kind = first[order], len(order), len(model.start), np.float32
    longest = int(size[0])
    sym = np.zeros((longest, n), dtype=np.int32)
    for col, i in enumerate(order.tolist()):
        sym[: size[col], col] = stretches[i]
    active = np.searchsorted(-size, -np.arange(longest + 1), side="left").tolist()  # sequences longer than t
    obs = model.emit.astype(kind)[sym]
    forward, back = model.move.astype(kind), np.ascontiguousarray(model.move.T.astype(kind))
    alpha, flow, ones = np.zeros((longest, n, k), kind), np.zeros((longest, n, k), kind), np.ones((k, 1), kind)
    scale = np.ones((longest, n, 1), kind)
    alpha[0] = np.where(first[:, None], model.start, model.stationary()) * obs[0]
    for t in range(longest):
        m = active[t]
        now, total = alpha[t, :m], scale[t, :m]
        if t:
            np.matmul(alpha[t - 1, :m], forward, out=now)
            now *= obs[t, :m]
        np.matmul(now, ones, out=total)
        now /= total
    # flow: obs * beta / scale of each step; seen: alpha * beta, kept in alpha's place.
    obs /= scale
    last = alpha.copy() if longest > 1 else alpha
    for t in range(longest - 1, -1, -1):
        m, later = active[t], active[t + 1]
        flow[t, later:m] = obs[t, later:m]
        if later:
            beta = flow[t + 1, :later] @ back
            np.multiply(obs[t, :later], beta, out=flow[t, :later])
            alpha[t, :later] *= beta
    move = model.move * (last[:-1].reshape(-1, k).T @ flow[1:].reshape(-1, k)).astype(np.float64)
    flat, seen = sym.ravel(), alpha.reshape(-1, k)
    emit = np.stack([np.bincount(flat, weights=seen[:, s], minlength=len(model.emit)) for s in range(k)], axis=1)
    return alpha[0, first].sum(axis=0, dtype=np.float64), move, emit, float(np.log10(scale, dtype=np.float64).sum())


def fit(encoded: DataFrame, unigram: np.ndarray, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over the rows of ``encoded`` (column symbols)."""
    spark, model, symbols = encoded.sparkSession, Model.first(unigram, states), len(unigram)
    cells = states * (1 + states + symbols)
    ship(spark)
    for _ in range(iterations):
        sent = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, total = sent.value, np.zeros(cells)
            held, first, size = [], [], 0

            def add() -> None:
                start, move, emit, _ = expected_counts(own, held, np.array(first))
                total[:] += np.concatenate([start, move.ravel(), emit.ravel()])

            for batch in batches:
                for raw in batch.column(0):
                    text = np.frombuffer(raw.as_py(), dtype="<u2")
                    for lo in range(0, len(text), STRETCH):
                        held.append(text[lo : lo + STRETCH])
                        first.append(lo == 0)
                        size += len(held[-1])
                        if size >= _TOKENS_AT_ONCE // 2:
                            add()
                            held, first, size = [], [], 0
            if held:
                add()
            whole = np.rint(total * _UNIT).astype(np.int64)
            at = np.flatnonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(whole[at])], names=["at", "value"])

        sums = arrow_map(encoded.select("symbols"), run, "at int, value long").groupBy("at").agg(F.sum("value").alias("value"))
        count = np.zeros(cells)
        for r in sums.toLocalIterator():  # at most ``cells`` rows
            count[r.at] = r.value / _UNIT
        start, move = count[:states] + 0.1, count[states : states + states**2].reshape(states, states) + 0.1
        emit = count[states + states**2 :].reshape(symbols, states) + 0.5 * unigram[:, None]
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def log10_likelihoods(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Scaled forward recursion over whole texts, all texts in step."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    order = np.argsort(-size, kind="stable")
    flat = np.concatenate([texts[i] for i in order])
    size, out = size[order], np.zeros(len(texts))
    begin = np.cumsum(size) - size
    now = model.start * model.emit[flat[begin]]
    active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    for t in range(int(size[0])):
        m = int(active[t])
        if t:
            now = (now[:m] @ model.move) * model.emit[flat[begin[:m] + t]]
        total = now.sum(axis=1)
        out[:m] += np.log10(total)
        now /= total[:, None]
    back = np.empty(len(texts))
    back[order] = out
    return back


def likelihoods(encoded: DataFrame, model: Model) -> DataFrame:
    """Adds ``symbol_score``, the exact log10 probability of the symbols."""
    spark = encoded.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("symbols")
            texts = [np.frombuffer(x.as_py(), dtype="<u2") for x in batch.column(at)]
            if texts:
                score = pa.array(log10_likelihoods(sent.value, texts))
                kept = [batch.column(i) for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*kept, score], names=[n for n in batch.schema.names if n != "symbols"] + ["symbol_score"])

    schema = "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_base double, head_inside double, symbol_score double"
    return arrow_map(encoded.select("row", "doc_id", "held_out", "n_tokens", "symbols", "head_known", "head_base", "head_inside"), run, schema)


def score(docs: DataFrame, held_out: Column, states: int = STATES, iterations: int = ITERATIONS, head: int = HEAD, own: int = OWN) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row; learns from the rows where ``held_out`` is false."""
    counts = written(word_counts(docs.filter(~held_out)), "word-counts")
    vocabulary = Vocabulary(counts, head, own)
    encoded = written(encode(docs, vocabulary, held_out), "symbols")
    model = fit(encoded.filter("NOT held_out"), vocabulary.unigram(), states, iterations)
    rest = (
        encoded.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n", "r.size")
        .join(counts.select("word", "c"), "word", "left")
        .withColumn("c", F.coalesce("c", F.lit(0)))
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
            F.sum(F.col("n") * (F.log10(F.col("c") + 1) - F.lit(vocabulary.log_all))).alias("base"),
            F.sum(F.col("n") * (F.log10(F.col("c") + 1) - F.log10("size"))).alias("inside"),
        )
    )
    zero = F.lit(0.0)
    return likelihoods(encoded, model).join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("base", zero)).alias("base_score"),
        (F.col("symbol_score") + F.col("head_inside") + F.coalesce("inside", zero)).alias("score"),
    )
