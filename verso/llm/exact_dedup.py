"""Exact dedup by two-pass Bloom filtering (DataFrame functions only).

Pass one. Every row is reduced to (id, SHA-256 of the text, row number), written once.
A hash sets ``PROBES`` bits of one 64-bit word of a Bloom filter; how often each bit is
set is a partial aggregate, so a hash that a third of the rows share sends one count a
task. Kept are the bits set at least twice: the filter of possibly repeated hashes.

Pass two. Rows with a bit outside that filter are surely alone. They pass straight
through, with no shuffle. Only the rest is shuffled: counted by hash (partial
aggregates), and joined to the counts of the hashes that really repeat. Both sides of
this join are plain exchanges, so Spark splits a hot hash.

The filter is looked up in a broadcast of its words. ``bits_a_row`` sizes it, and it is
cut by hash into slices of at most ``slice_rows`` rows on average, each with its own
broadcast of at most slice_rows * bits_a_row / 64 words, however many rows there are.
A slice reads its own part of the narrow table only.

Cases: null text counts as empty, and empty texts are equal to each other. A group of
equal texts keeps the row of the largest id; ids may be null (smaller than any) or
repeated, then the row number decides and exactly one row stays. Very long texts are
hashed whole. An empty table gives no rows. Other columns, whatever their names, are
ignored by ``mark`` and kept by ``distinct``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verso.llm.common import scratch_path, written

PROBES = 2
BITS_A_ROW = 16
SLICE_ROWS = 1 << 25


def text_hash(text: Column) -> Column:
    """SHA-256 (32 bytes) of a text in UTF-8; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def _word(sha: Column, words: int) -> Column:
    """Number of the filter word that a hash belongs to."""
    return F.pmod(F.xxhash64(sha), F.lit(words))


def _bits(sha: Column) -> list[Column]:
    """PROBES different bits (0..63) of the word."""
    h = F.xxhash64(F.lit(1), sha)
    first = F.pmod(h, F.lit(64))
    step = F.lit(1) + F.pmod(F.shiftrightunsigned(h, 6), F.lit(64 // PROBES - 1))
    return [F.pmod(first + step * i, F.lit(64)).cast("int") for i in range(PROBES)]


def repeated_filter(narrow: DataFrame, words: int) -> DataFrame:
    """(word, mask): the bits that at least two rows of ``narrow`` (column sha) set.
    Words without such a bit are absent."""
    sha = F.col("sha")
    hits = narrow.select((_word(sha, words)).alias("word"), F.explode(F.array(*_bits(sha))).alias("bit"))
    twice = hits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))


def possibly_repeated(narrow: DataFrame, words: int, rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (default: ``narrow``; with a column sha) with a flag ``maybe``: true if
    the filter of ``narrow`` holds all bits of the hash. Never false for a repeated hash."""
    rows = narrow if rows is None else rows
    # At most ``words`` rows of two longs: the caller bounds it.
    found = F.broadcast(repeated_filter(narrow, words).withColumnRenamed("word", "_word"))
    sha = F.col("sha")
    need = F.lit(0).cast("long")
    for bit in _bits(sha):
        need = need.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    out = rows.withColumn("_word", _word(sha, words)).join(found, "_word", "left")
    maybe = F.coalesce(F.col("mask").bitwiseAND(need) == need, F.lit(False))
    return out.withColumn("maybe", maybe).drop("_word", "mask")


def _slices(n_rows: int, slice_rows: int) -> int:
    return max(1, math.ceil(n_rows / slice_rows))


def _words(n_rows: int, slices: int, bits_a_row: int) -> int:
    return max(1, math.ceil(n_rows / slices * bits_a_row / 64))


def _narrow(docs: DataFrame, id_col: str, text_col: str, slices: int) -> DataFrame:
    """(doc_id, sha, row, slice), written once: a retried task cannot renumber rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("sha"))
    rows = rows.select("doc_id", "sha", F.monotonically_increasing_id().alias("row"))
    if slices == 1:
        return written(rows.withColumn("slice", F.lit(0)), "text-hashes")
    path = scratch_path(docs.sparkSession, "text-hashes")
    cut = rows.withColumn("slice", F.pmod(F.xxhash64(F.lit(2), "sha"), F.lit(slices)).cast("int"))
    cut.write.partitionBy("slice").parquet(path)
    return docs.sparkSession.read.schema(cut.schema).parquet(path)


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_a_row: int = BITS_A_ROW, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, sha), one row for each row of ``docs``."""
    n_rows = docs.count()
    slices = _slices(n_rows, slice_rows)
    narrow = _narrow(docs, id_col, text_col, slices)
    parts = [narrow.where(F.col("slice") == s) for s in range(slices)]
    # the flags are used twice (counted, joined): written once, narrow
    flagged = possibly_repeated(parts[0], _words(n_rows, slices, bits_a_row))
    for part in parts[1:]:
        flagged = flagged.unionByName(possibly_repeated(part, _words(n_rows, slices, bits_a_row)))
    flagged = written(flagged.drop("slice"), "flagged-hashes")
    alone = flagged.where(~F.col("maybe"))
    maybe = flagged.where("maybe").drop("maybe")
    groups = maybe.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("stays")).where("group_size > 1")
    groups = written(groups, "repeated-hashes")
    decided = maybe.join(groups, "sha", "left")
    one = F.lit(1).cast("long")
    single = alone.select("doc_id", F.col("doc_id").alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept"), "sha")
    grouped = decided.select(
        "doc_id", F.when(F.col("stays").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", one).alias("group_size"), F.coalesce(F.col("stays.row") == F.col("row"), F.lit(True)).alias("kept"), "sha",
    )
    return single.unionByName(grouped)


def distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_a_row: int = BITS_A_ROW, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows whose text is surely
    alone keep their place; of the others each task sends one row a text, the one with
    the largest id (ties: the largest row as JSON)."""
    n_rows = docs.count()
    slices = _slices(n_rows, slice_rows)
    narrow = _narrow(docs, id_col, text_col, slices)
    words = _words(n_rows, slices, bits_a_row)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    hashed = docs.select(row.alias("row"), text_hash(F.col(text_col)).alias("sha"), F.col(id_col).cast("long").alias("id"))
    cut = hashed.withColumn("slice", F.pmod(F.xxhash64(F.lit(2), "sha"), F.lit(slices)).cast("int")) if slices > 1 else hashed.withColumn("slice", F.lit(0))
    out = None
    for s in range(slices):
        flagged = possibly_repeated(narrow.where(F.col("slice") == s), words, cut.where(F.col("slice") == s))
        best = flagged.where("maybe").groupBy("sha").agg(F.max_by("row", F.struct("id", F.to_json("row"))).alias("row"))
        part = flagged.where(~F.col("maybe")).select("row").unionByName(best.select("row"))
        out = part if out is None else out.unionByName(part)
    return out.select("row.*")


def digests(docs: DataFrame) -> DataFrame:
    """``mark`` with the hash as lower-case hex."""
    return mark(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
