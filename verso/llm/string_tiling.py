"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are word sequences (lower case, ``\\w+``). Five-word
seeds shared by a document and an item (Karp-Rabin hashes, then compared) that follow
one another on a diagonal form a maximal match. Tiles are taken longest first; a
match whose words are partly marked by then is cut into its unmarked runs and put
back; runs under ``min_match`` words are dropped. Tiles may lie anywhere and in any
order, so reordered passages count in full. ``coverage`` is the share of the item's
words in tiles; a document leaks the item from ``threshold`` on.

The benchmark is the small side: it is read in blocks of at most about
``block_words`` words (chosen by a count, split by a hash of the item), and every
block goes to the tasks as a bounded broadcast, with one pass over the documents
each. Documents are never shuffled or collected.

Very long and repetitive texts: shared seeds are held as runs on their diagonals, listed
a bounded number at a time, and only for items whose words they can cover, so memory is
about a row for each diagonal of a text and an item.

Cases: null or empty texts have no words and never match. Items under ``min_match``
words cannot be told from chance and are never reported. Null ids and repeated rows
keep their rows. Without items or documents the result is empty. Other columns are
ignored; ``clean`` keeps them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verso.llm.common import arrow_map, ship
from verso.llm.seeds import Block, slices

MIN_MATCH = 5
THRESHOLD = 0.8
BLOCK_WORDS = 2_000_000


def tiles(matches: np.ndarray, item_words: int, doc_words: int, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiling of ``matches`` (item position, document position, words): longest
    unmarked match first, ties by item, then document position."""
    heap = [(-n, i, j) for i, j, n in matches.tolist()]
    heapq.heapify(heap)
    in_item, in_doc, out = np.zeros(item_words, dtype=bool), np.zeros(doc_words, dtype=bool), []
    while heap:
        n, i, j = heapq.heappop(heap)
        marked = in_item[i : i - n] | in_doc[j : j - n]
        if not marked.any():
            out.append((i, j, -n))
            in_item[i : i - n] = True
            in_doc[j : j - n] = True
            if in_item.all():
                break
            continue
        edges = np.flatnonzero(np.diff(marked, prepend=True, append=True))  # of the unmarked runs
        for start, stop in edges.reshape(-1, 2).tolist():
            if stop - start >= min_match:
                heapq.heappush(heap, (start - stop, i + start, j + start))
    return sorted(out)


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[tuple[list[int], list[str]]]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = -(-size // block_words)
    for b in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        rows = part.distinct().collect()  # at most about block_words words
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        if rows:
            yield [r.item_id for r in rows], [r.text for r in rows]


def _found(block: Block, texts: list[str | None], threshold: float) -> Iterator[tuple[int, int, float, list]]:
    """(document index, item index, coverage, tiles) of the leaks in a slice."""
    docs = [block.ids(t) for t in texts]
    for d, item, matches in block.runs(docs, threshold):  # the seeds' words bound what tiles can cover
        total = len(block.items[item])
        got = tiles(matches, total, len(docs[d]), block.k)
        coverage = sum(n for _, _, n in got) / total
        if coverage >= threshold:
            yield d, item, coverage, got


def _task_block(sent) -> Block:
    """The block of a broadcast, built once in each Python worker."""
    if not hasattr(sent, "built"):
        texts, k = sent.value
        sent.built = Block(texts, k)
    return sent.built


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, matched_words, tiles) of every document
    and item whose tiles cover at least ``threshold`` of the item; tiles hold
    (item_start, doc_start, words), counted in words."""
    schema = "doc_id long, item_id long, coverage double, n_tiles int, matched_words int, tiles array<struct<item_start:int,doc_start:int,words:int>>"
    spark = docs.sparkSession
    ship(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tile = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("words", pa.int32())]))
    out = None
    for item_ids, texts in _blocks(benchmark, block_words):
        sent = spark.sparkContext.broadcast((texts, min_match))

        def run(batches: Iterator[pa.RecordBatch], item_ids=item_ids, sent=sent) -> Iterator[pa.RecordBatch]:
            block = _task_block(sent)
            for batch, held in slices(batches):
                ids, rows = batch.column("doc_id").to_pylist(), list(_found(block, held, threshold))
                if rows:
                    cols = [
                        pa.array([ids[d] for d, *_ in rows], pa.int64()), pa.array([item_ids[i] for _, i, _, _ in rows], pa.int64()), pa.array([c for *_, c, _ in rows]),
                        pa.array([len(t) for *_, t in rows], pa.int32()), pa.array([sum(n for _, _, n in t) for *_, t in rows], pa.int32()),
                        pa.array([[{"item_start": i, "doc_start": j, "words": n} for i, j, n in t] for *_, t in rows], tile),
                    ]
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "coverage", "n_tiles", "matched_words", "tiles"])

        part = arrow_map(narrow, run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that leak an item; no shuffle."""
    spark = docs.sparkSession
    ship(spark)
    for _, texts in _blocks(benchmark, block_words):
        sent = spark.sparkContext.broadcast((texts, min_match))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = _task_block(sent)
            for batch, held in slices(batches):
                keep = np.ones(len(held), dtype=bool)
                keep[[d for d, *_ in _found(block, held, threshold)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
