"""Text features: term statistics, vocabulary, IDF, label index
(A5-A7, L3, M2-M5).

``term_stats`` makes one pass and one shuffle: each document emits every
token (for the total count) and each distinct token once (for the document
count), and both are summed per term with a partial aggregate, so a term in
every document still sends one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Tokenizer
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verso.session import materialize

# Feature settings of the reference.
VOCAB_SIZE = 10_000
MIN_DF = 5.0

# Buckets of the sketch that finds rare terms before the shuffle; raise it with the number
# of distinct terms (4 million buckets are a broadcast of 65,536 words).
SKETCH_BUCKETS = 1 << 22


def tokenize(df: DataFrame, text_col: str = "lyrics", out_col: str = "words") -> DataFrame:
    """Lower-case, split on single ASCII white-space characters
    (the MLlib tokenizer, so features match the fitted pipeline)."""
    return Tokenizer(inputCol=text_col, outputCol=out_col).transform(df)


def _term_events(tokens_df: DataFrame, tokens_col: str, *keep: str) -> tuple[DataFrame, Column]:
    """(``keep``, term) once for each token and once for each distinct token of a
    document, and the flag that tells an occurrence from a document.

    All native expressions, so the explode runs in generated code; ``posexplode_outer``
    keeps Catalyst from inferring a filter that would tokenise twice (tokens are never
    null)."""
    words = F.col(tokens_col)
    events = tokens_df.select(
        *keep, F.size(words).alias("_n"), F.posexplode_outer(F.concat(words, F.array_distinct(words))).alias("_pos", "term")
    ).where(F.col("term").isNotNull())
    return events, F.col("_pos") < F.col("_n")


def term_stats(tokens_df: DataFrame, tokens_col: str = "words") -> DataFrame:
    """Per term, total count ``tf`` and document count ``df``.

    Each document emits its tokens followed by its distinct tokens; the
    position tells the two apart (below the token count: one occurrence,
    else: one document).
    """
    events, occurrence = _term_events(tokens_df, tokens_col)
    return events.groupBy("term").agg(
        F.sum(occurrence.cast("bigint")).alias("tf"), F.sum((~occurrence).cast("bigint")).alias("df")
    )


def term_stats_by_group(
    tokens_df: DataFrame, group_col: str, groups: int, tokens_col: str = "words", min_df: float = 0.0, buckets: int = 0,
) -> DataFrame:
    """A6 for every group of documents at once: per term, ``tf`` and ``df`` as arrays with
    an entry for each group 0..groups-1.

    The same pass and the same partial aggregate as ``term_stats``, with ``groups`` pairs
    of sums for one. The statistics of any union of groups (all folds but one, say)
    are sums over its entries (``stats_of_groups``); the texts are not read again. Only
    terms in at least ``min_df`` documents of all groups together; ``buckets`` > 0 drops
    most others before the shuffle (``frequent_filter``).
    """
    if buckets and min_df > 1.0:
        events, occurrence = _frequent_events(tokens_df, min_df, buckets, tokens_col, group_col)
    else:
        events, occurrence = _term_events(tokens_df, tokens_col, group_col)

    def sums(flag: Column) -> Column:
        return F.array(*[F.sum((flag & (F.col(group_col) == g)).cast("bigint")) for g in range(groups)])

    stats = events.groupBy("term").agg(sums(occurrence).alias("tf"), sums(~occurrence).alias("df"))
    return stats.where(F.aggregate("df", F.lit(0).cast("bigint"), lambda a, x: a + x) >= min_df)


def frequent_filter(tokens_df: DataFrame, min_df: float, tokens_col: str = "words", buckets: int = SKETCH_BUCKETS) -> DataFrame:
    """(word, mask): a bitmap of the hash buckets that may hold a term of at least
    ``min_df`` documents.

    A counting sketch: every document counts once in the bucket of each of its distinct
    terms. A bucket's count is the sum of its terms' document counts, so a bucket below
    ``min_df`` holds no term that reaches it: the sketch only overestimates. Counting is
    a partial aggregate of at most ``buckets`` rows a task, whatever the number of
    terms; the bitmap has at most ``buckets`` / 64 words.
    """
    events, occurrence = _term_events(tokens_df, tokens_col)
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets))
    counts = events.where(~occurrence).groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_df)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_bucket", F.lit(64)).cast("int"))
    return counts.select(F.floor(F.col("_bucket") / 64).alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_mask"))


def _frequent_events(tokens_df: DataFrame, min_df: float, buckets: int, tokens_col: str, *keep: str) -> tuple[DataFrame, Column]:
    """``_term_events`` without the terms that ``frequent_filter`` shows to be too rare.
    The broadcast is bounded by ``buckets`` / 64 rows of two numbers."""
    events, occurrence = _term_events(tokens_df, tokens_col, *keep)
    found = F.broadcast(frequent_filter(tokens_df, min_df, tokens_col, buckets))
    hashed = events.withColumn("_bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    hashed = hashed.withColumn("_word", F.floor(F.col("_bucket") / 64)).join(found, "_word")
    return hashed.where(F.getbit("_mask", F.pmod("_bucket", F.lit(64)).cast("int")) == 1), occurrence


def frequent_term_stats(tokens_df: DataFrame, min_df: float, tokens_col: str = "words", buckets: int = SKETCH_BUCKETS) -> DataFrame:
    """``term_stats`` of the terms in at least ``min_df`` documents.

    Most distinct terms of a corpus are rare, and each task would shuffle its own. Terms
    that the sketch shows to be too rare are dropped before the shuffle; what passes is
    counted exactly and cut at ``min_df``, so the rows are those of
    ``term_stats(...).where(df >= min_df)``. ``tokens_df`` is read twice (persisted tokens,
    in a fit).
    """
    events, occurrence = _frequent_events(tokens_df, min_df, buckets, tokens_col)
    stats = events.groupBy("term").agg(F.sum(occurrence.cast("bigint")).alias("tf"), F.sum((~occurrence).cast("bigint")).alias("df"))
    return stats.where(F.col("df") >= min_df)


def stats_of_groups(stats: DataFrame, keep: Iterable[int]) -> DataFrame:
    """``term_stats`` of the documents in the groups ``keep``, from ``term_stats_by_group``."""
    keep = list(keep)
    tf, df = (reduce(add, [F.get(c, F.lit(g)) for g in keep]).alias(c) for c in ("tf", "df"))
    return stats.select("term", tf, df).where("df > 0")


def row_term_counts(tokens_df: DataFrame, tokens_col: str = "words", out_col: str = "counts") -> DataFrame:
    """Adds ``out_col``: array of (term, tf), the counts of one document's tokens.

    Row-local: the tokens are sorted, and a term's count is the distance between
    the first places of its run and the next. Nothing is shuffled."""
    ordered = tokens_df.withColumn("_sorted", F.sort_array(tokens_col))
    shifted = F.concat(F.array(F.lit(None).cast("string")), F.col("_sorted"))
    pairs = F.arrays_zip(F.col("_sorted").alias("term"), F.slice(shifted, F.lit(1), F.size("_sorted")).alias("before"))
    places = F.transform(pairs, lambda p, i: F.struct(p["term"].alias("term"), i.alias("at"), p["term"].eqNullSafe(p["before"]).alias("again")))
    heads = ordered.withColumn("_heads", F.filter(places, lambda h: ~h["again"]))
    ends = F.concat(F.slice("_heads.at", F.lit(2), F.size("_heads")), F.array(F.size("_sorted")))
    counts = F.zip_with("_heads", ends, lambda h, end: F.struct(h["term"].alias("term"), (end - h["at"]).cast("bigint").alias("tf")))
    return heads.withColumn(out_col, F.when(F.size("_sorted") > 0, counts).otherwise(F.expr("cast(array() as array<struct<term:string,tf:bigint>>)"))).drop("_sorted", "_heads")


def exploded_counts(counted: DataFrame, id_col: str = "doc_id", counts_col: str = "counts") -> DataFrame:
    """(id_col, term, tf) from ``row_term_counts``. The outer explode keeps
    Catalyst from inferring a filter on the array's size, which would compute
    the counts twice."""
    rows = counted.select(id_col, F.explode_outer(counts_col).alias("_c"))
    return rows.where(F.col("_c").isNotNull()).select(id_col, "_c.term", "_c.tf")


def vocabulary(stats: DataFrame, vocab_size: int = VOCAB_SIZE, min_df: float = MIN_DF,
               n_docs: Column | None = None, fan_in: int = 16) -> DataFrame:
    """M3 / L3: terms in at least ``min_df`` documents, the ``vocab_size``
    largest by total count; ties by term, so the list is repeatable.

    The top-k has two levels: the best of each of ``fan_in`` hash groups of
    terms (limited per map task first), then the best of those, so the last
    task sees at most ``fan_in`` x ``vocab_size`` rows however many tasks
    there were. The index is numbered over ``vocab_size`` rows only.
    """
    if min_df >= 1.0:
        kept = stats.where(F.col("df") >= F.lit(min_df))
    else:
        if n_docs is None:
            raise ValueError("a fractional min_df needs n_docs")
        kept = stats.where(F.col("df") >= F.lit(min_df) * n_docs)
    order = [F.desc("tf"), F.asc("term")]
    group = kept.withColumn("_group", F.pmod(F.xxhash64("term"), F.lit(fan_in)))
    best = group.withColumn("_rank", F.row_number().over(Window.partitionBy("_group").orderBy(*order))).where(F.col("_rank") <= vocab_size)
    top = best.drop("_group", "_rank").orderBy(*order).limit(vocab_size)
    idx = F.row_number().over(Window.orderBy(*order)) - 1
    return top.withColumn("index", idx.cast("int"))


def idf_weights(stats: DataFrame, n_docs: Column) -> DataFrame:
    """``ln((N + 1) / (df + 1))`` per term, MLlib's formula."""
    return stats.withColumn(
        "idf", F.log((n_docs.cast("double") + 1.0) / (F.col("df").cast("double") + 1.0))
    )


def label_index(df: DataFrame, label_col: str = "genre") -> DataFrame:
    """A5 / M5: label order of the MLlib indexer (count descending, then
    label ascending), index from 0. One row per class; the numbering window
    sees only those rows."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(
        F.count(F.lit(1)).alias("n")
    )
    idx = F.row_number().over(Window.orderBy(F.desc("n"), F.asc(label_col))) - 1
    return counts.withColumn("label", idx.cast("double"))


class Vocabulary(Estimator, HasInputCol, HasOutputCol):
    """Drop-in for MLlib's CountVectorizer with a repeatable vocabulary.

    MLlib breaks count ties in whatever order partitions arrive; this
    estimator orders ties by term and fits a stock ``CountVectorizerModel``
    (JVM, persistable) from the list. The list is at most ``vocabSize``
    terms, the one thing collected to the driver.
    """

    vocabSize = Param(Params._dummy(), "vocabSize", "max vocabulary size", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "min documents (>=1) or share (<1)", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol="words", outputCol="rawFeatures", vocabSize=VOCAB_SIZE, minDF=MIN_DF):
        super().__init__()
        self._setDefault(vocabSize=VOCAB_SIZE, minDF=MIN_DF)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        col = self.getInputCol()
        stats = term_stats(dataset.select(col), col)
        min_df = self.getOrDefault(self.minDF)
        n_docs = None if min_df >= 1.0 else dataset.select(F.count(F.lit(1))).scalar()
        vocab = vocabulary(stats, self.getOrDefault(self.vocabSize), min_df, n_docs)
        terms = [r["term"] for r in vocab.orderBy("index").select("term", "index").collect()]
        return CountVectorizerModel.from_vocabulary(
            terms, inputCol=col, outputCol=self.getOutputCol()
        )


def tfidf_model(terms: Sequence[str], weights: Sequence[float], input_col: str, counts_col: str, output_col: str) -> PipelineModel:
    """The fitted TF-IDF stages of a vocabulary: counts, then each count by its weight."""
    counts = CountVectorizerModel.from_vocabulary(list(terms), inputCol=input_col, outputCol=counts_col)
    product = ElementwiseProduct(scalingVec=Vectors.dense(list(weights)), inputCol=counts_col, outputCol=output_col)
    return PipelineModel(stages=[counts, product])


def weighted_vocabulary(stats: DataFrame, n_docs: Column, vocab_size: int, min_df: float) -> list[tuple[str, float]]:
    """(term, IDF weight) in index order: at most ``vocab_size`` rows on the driver."""
    vocab = idf_weights(vocabulary(stats, vocab_size, min_df, n_docs), n_docs)
    return [(r["term"], r["idf"]) for r in vocab.select("index", "term", "idf").orderBy("index").collect()]


class TfIdf(Estimator, HasInputCol, HasOutputCol):
    """Term counts and IDF weights fitted in one pass (M3 + M4 fused).

    MLlib fits CountVectorizer and IDF with two passes over the data; the
    term statistics pass already holds each term's document count, and the
    document count comes with it, so the IDF weights
    ``ln((N + 1) / (df + 1))`` (MLlib's formula) are computed there. The
    fitted model is a pipeline of two stock JVM stages: a
    ``CountVectorizerModel`` and an ``ElementwiseProduct`` with the weights,
    which multiplies each count by its term's weight exactly as
    ``IDFModel`` does.
    """

    vocabSize = Param(Params._dummy(), "vocabSize", "max vocabulary size", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "min documents (>=1) or share (<1)", TypeConverters.toFloat)
    countsCol = Param(Params._dummy(), "countsCol", "column of the raw counts", TypeConverters.toString)
    sketchBuckets = Param(Params._dummy(), "sketchBuckets", "drop rare terms before the shuffle; 0: count all terms", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="words", outputCol="features", countsCol="rawFeatures",
                 vocabSize=VOCAB_SIZE, minDF=MIN_DF, sketchBuckets=0):
        super().__init__()
        self._setDefault(vocabSize=VOCAB_SIZE, minDF=MIN_DF, countsCol="rawFeatures", sketchBuckets=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        col = self.getInputCol()
        tokens = dataset.select(col)
        n_docs = tokens.select(F.count(F.lit(1))).scalar()
        min_df, buckets = self.getOrDefault(self.minDF), self.getOrDefault(self.sketchBuckets)
        stats = frequent_term_stats(tokens, min_df, col, buckets) if buckets and min_df > 1.0 else term_stats(tokens, col)
        return self.model(weighted_vocabulary(stats, n_docs, self.getOrDefault(self.vocabSize), min_df))

    def model(self, vocab: Sequence[tuple[str, float]]) -> PipelineModel:
        """The fitted stages for a vocabulary with weights."""
        return tfidf_model([t for t, _ in vocab], [w for _, w in vocab], self.getInputCol(), self.getOrDefault(self.countsCol), self.getOutputCol())


class GroupedTfIdf:
    """TF-IDF stages for any union of groups of documents, from one aggregate.

    ``tokens`` has the estimator's input column and ``group_col`` (0..groups-1). The
    texts are read once: terms are counted in all groups together
    (``term_stats_by_group``), and every vocabulary and every weight comes from the small
    table of terms that are frequent enough somewhere, written once to the checkpoint
    folder. A smaller vocabulary is the beginning of a larger one, so each union of
    groups is ranked once for all sizes. On the driver are at most ``vocab_size`` terms
    for each union asked for.
    """

    def __init__(self, tfidf: TfIdf, tokens: DataFrame, group_col: str, groups: int, vocab_size: int | None = None):
        self.tfidf, self.groups = tfidf, groups
        self.vocab_size, self.min_df = vocab_size or tfidf.getOrDefault(tfidf.vocabSize), tfidf.getOrDefault(tfidf.minDF)
        # too rare in all groups together: too rare in any union
        least = self.min_df if self.min_df >= 1.0 else 0.0
        self.stats = materialize(term_stats_by_group(tokens, group_col, groups, tfidf.getInputCol(), least, tfidf.getOrDefault(tfidf.sketchBuckets)))
        self.n_docs = {r[group_col]: r["count"] for r in tokens.groupBy(group_col).count().collect()}  # one row a group
        self._vocab: dict[frozenset[int], list[tuple[str, float]]] = {}

    def rows(self, keep: Iterable[int]) -> int:
        """Documents in the groups ``keep``."""
        return sum(self.n_docs.get(g, 0) for g in set(keep))

    def model(self, keep: Iterable[int], vocab_size: int | None = None) -> PipelineModel:
        """The stages that ``TfIdf`` would fit on the documents in the groups ``keep``."""
        keep, size = frozenset(keep), vocab_size or self.vocab_size
        if size > self.vocab_size:
            raise ValueError(f"a vocabulary of {size} terms was asked for, {self.vocab_size} are ranked")
        if keep not in self._vocab:
            self._vocab[keep] = weighted_vocabulary(stats_of_groups(self.stats, sorted(keep)), F.lit(self.rows(keep)), self.vocab_size, self.min_df)
        return self.tfidf.model(self._vocab[keep][:size])
