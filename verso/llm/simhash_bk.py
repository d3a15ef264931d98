"""SimHash near-dedup with BK-trees.

``fingerprints``: 64-bit SimHash of every whole text (word shingles, XXH64).
``components``: documents whose fingerprints differ in at most ``radius`` bits
are linked; the component of a document is the smallest id it can reach.

Search. Equal fingerprints are one node (a partial aggregate, so a third of all
documents being one copy costs one row a task). If two fingerprints differ in at
most r bits and the 64 bits are cut into b > r blocks, b-r blocks are equal. So
for every choice of b-r blocks the nodes are sharded by the bits of those blocks,
and each shard gets a BK-tree: children keyed by the integer Hamming distance to
their parent, and a query at distance d follows only edges d-r..d+r. A task holds
the trees of many small shards, built and searched level by level in numpy. A
shard tree reaches its task by the shuffle, not by a broadcast: all trees together
grow with the data, so no size bound could be given for a broadcast.
b grows with the number of nodes, which keeps shards near ``shard_target``
fingerprints; the links found do not depend on it. A shard above ``max_tree``
is split into several trees and every query of the shard visits each.

Links inside a task become spanning links (each node to the smallest of its
group), so a group of n near copies sends n rows, never n^2. The groups are then
merged by alternating large-star/small-star joins, each written to the checkpoint
folder. A star centre, or a component, with more than a thousandth of all rows is joined
by broadcast (there are fewer than a thousand), so one large component is never in
one task.

Cases: null or empty text, or only white space: fingerprint zero, linked like any
other. A null id gets a row too, and is never the component id unless the whole
component has none. Repeated rows stay repeated. Other columns are ignored. A very long
text is read whole, by one task. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verso.llm.common import arrow_map, materialize

SHINGLE = 4
RADIUS = 4
SEED = 42
SHARD_TARGET = 64
MAX_TREE = 20_000
HOT_KEYS = 1000  # a key with more than one part in so many of all rows is joined by broadcast
BROADCAST_KEYS = 500_000  # (id, text hash) pairs of 16 bytes
_ROWS_AT_ONCE = 200_000
_PAIRS_AT_ONCE = 2_000_000


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text: bit i is 1 if set in over half the shingle hashes."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(itertools.accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(h), 1 << 16):
        part = np.ascontiguousarray(h[lo : lo + (1 << 16)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", kept: str | None = None) -> DataFrame:
    """(doc_id, fp): fp is the unsigned fingerprint stored in a signed long.
    ``kept``: a column of longs that is handed through."""
    names = ["doc_id", "fp", *([kept] if kept else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names=names)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *names[2:])
    return arrow_map(narrow, run, ", ".join(f"{n} long" for n in names))


# --- BK-trees, built and searched level by level -------------------------------


class Forest:
    """One BK-tree for each group of fingerprints (``group``: dense ids 0..g-1)."""

    def __init__(self, fp: np.ndarray, group: np.ndarray, groups: int):
        n = len(fp)
        self.fp = np.empty(n, dtype=np.uint64)
        self.root = np.full(groups, -1, dtype=np.int64)
        parents, edges = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
        slot, made, key, at = group.astype(np.int64), 0, group.astype(np.int64), np.arange(n)
        first_level = True
        while len(at):
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            head = np.ones(len(at), dtype=bool)
            head[1:] = key[1:] != key[:-1]
            node = made + np.cumsum(head) - 1  # the node that each row belongs to or hangs below
            new = np.flatnonzero(head)
            ids = made + np.arange(len(new))
            self.fp[ids] = fp[at[new]]
            if first_level:
                self.root[slot[at[new]]] = ids
                first_level = False
            else:
                parents[ids], edges[ids] = key[new] // 65, key[new] % 65
            made += len(new)
            rest = ~head
            at, node = at[rest], node[rest]
            key = node * 65 + np.bitwise_count(fp[at] ^ self.fp[node]).astype(np.int64)
        child = parents * 65 + edges
        self.order = np.argsort(child, kind="stable")
        self.child = child[self.order]

    def within(self, fp: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, fingerprint found) for every pair at 1..radius bits."""
        for lo in range(0, len(fp), 4096):
            q = np.arange(lo, min(lo + 4096, len(fp)))
            node = self.root[group[q]]
            q, node = q[node >= 0], node[node >= 0]
            todo = [(q, node)]
            while todo:
                q, node = todo.pop()
                d = np.bitwise_count(fp[q] ^ self.fp[node]).astype(np.int64)
                hit = (d <= radius) & (d > 0)
                if hit.any():
                    yield q[hit], self.fp[node[hit]]
                first = np.searchsorted(self.child, node * 65 + np.maximum(d - radius, 0))
                n = np.searchsorted(self.child, node * 65 + np.minimum(d + radius, 64), side="right") - first
                total = int(n.sum())
                if total:
                    q2 = np.repeat(q, n)
                    pos = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
                    node2 = self.order[pos]
                    for cut in range(0, total, _PAIRS_AT_ONCE):
                        todo.append((q2[cut : cut + _PAIRS_AT_ONCE], node2[cut : cut + _PAIRS_AT_ONCE]))


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a-b as (node, smallest node of its group), without the smallest itself."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = inv[: len(a)], inv[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        was = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == was).all():
            break
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _link_groups(fp: np.ndarray, group: np.ndarray, groups: int, member: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    forest = Forest(fp[member], group[member], groups)
    a, b, held = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], 0
    for q, found in forest.within(fp, group, radius):
        a.append(fp[q])
        b.append(found)
        held += len(q)
        if held > _PAIRS_AT_ONCE:
            x, y = spanning(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], 0
    return spanning(np.concatenate(a), np.concatenate(b))


def _masks(blocks: int, radius: int) -> list[int]:
    """For each choice of blocks-radius blocks, the mask of their bits."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(blocks)]
    return [sum(block[i] for i in pick) for pick in itertools.combinations(range(blocks), blocks - radius)]


def blocks_for(nodes: int, radius: int = RADIUS, shard_target: int = SHARD_TARGET) -> int:
    """Smallest number of blocks whose shards hold about ``shard_target`` nodes."""
    for blocks in range(radius + 1, radius + 5):
        if nodes / 2.0 ** (64 * (blocks - radius) / blocks) <= shard_target:
            break
    return blocks


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int | None = None, max_tree: int = MAX_TREE) -> DataFrame:
    """(a, b): spanning links between distinct fingerprints (column fp) at most
    ``radius`` bits apart: a and b are in one group exactly if a chain of such
    pairs inside the data connects them."""
    blocks = blocks or blocks_for(nodes.count(), radius)
    masks = _masks(blocks, radius)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for table, mask in enumerate(masks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), table, np.int32)), pa.array((fp & np.uint64(mask)).view(np.int64)), batch.column(0)],
                    names=["tab", "shard", "fp"],
                )

    rows = arrow_map(nodes.select("fp"), shards, "tab int, shard long, fp long")
    large = (
        rows.groupBy("tab", "shard").count().filter(F.col("count") > max_tree)
        .select("tab", "shard", F.ceil(F.col("count") / max_tree).cast("int").alias("trees"))
    )
    dealt = (
        rows.join(large, ["tab", "shard"], "left")
        .withColumn("trees", F.coalesce("trees", F.lit(1)))
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
        .select("tab", "shard", "tree", "fp", (F.pmod(F.xxhash64("fp"), F.col("trees")) == F.col("tree")).alias("member"))
        .repartition("tab", "shard", "tree")
        .sortWithinPartitions("tab", "shard", "tree")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(t: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
            group = np.cumsum(new) - 1
            fp = t.column("fp").to_numpy().view(np.uint64)
            member = t.column("member").to_numpy(zero_copy_only=False).astype(bool)
            a, b = _link_groups(fp, group, int(group[-1]) + 1, member, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        def starts(t: pa.Table) -> np.ndarray:
            new = np.ones(t.num_rows, dtype=bool)
            cols = [t.column(c).to_numpy() for c in ("tab", "shard", "tree")]
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
            return new

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= _ROWS_AT_ONCE:
                t = pa.Table.from_batches(held)
                new = starts(t)
                cut = int(np.flatnonzero(new)[-1])  # the last shard may go on in the next batch
                if cut:
                    yield from solve(t.slice(0, cut), new[:cut])
                    held, size = t.slice(cut).to_batches(), t.num_rows - cut
        if size:
            t = pa.Table.from_batches(held)
            yield from solve(t, starts(t))

    return arrow_map(dealt, search, "a long, b long")


def _with_value(rows: DataFrame, values: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``values`` (key, a value, n: how many of the ``total`` rows have
    the key). Fewer than ``HOT_KEYS`` keys can have more than one part in ``HOT_KEYS`` of all
    rows: their values are broadcast and their rows stay where they are. The other rows
    are shuffled by key."""
    is_hot = F.col("n") > total // HOT_KEYS
    hot = F.broadcast(values.filter(is_hot))
    cold = rows.join(hot, key, "left_anti").join(values.filter(~is_hot), key)
    return rows.join(hot, key).unionByName(cold).drop("n")


def _stars(edges: DataFrame, large: bool, total: int) -> DataFrame:
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"), F.count("*").alias("n"))
    out = _with_value(near, low, "a", 2 * total if large else total)
    if large:
        out = out.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
    return out.filter("a != b").distinct()


def merged(edges: DataFrame) -> DataFrame:
    """(a, b): every linked node with the smallest node it can reach, by
    alternating large-star and small-star steps until nothing changes."""
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    was = state(edges)
    while was[0]:
        # a large star has at most two rows a link, a small star no more rows than links
        edges = materialize(_stars(_stars(edges, True, was[0]), False, was[0]))
        now = state(edges)
        if now == was:
            break
        was = now
    return edges


def _rooted(fps: DataFrame, radius: int, **search) -> DataFrame:
    """(fp, low, root): every distinct fingerprint with its smallest id and the
    smallest fingerprint (as stored) of its component."""
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    reach = merged(links(nodes, radius, **search))
    return nodes.join(reach.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def components(fps: DataFrame, radius: int = RADIUS, **search) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``fps`` (doc_id, fp)."""
    fps = materialize(fps)
    rooted = _rooted(fps, radius, **search)
    smallest = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n"))
    of = _with_value(rooted, smallest, "root", rooted.count()).select("fp", "component_id")
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, **search) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id), one row per input row."""
    found = components(fingerprints(docs, shingle), radius, **search)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _keys(keys: DataFrame) -> tuple[DataFrame, int]:
    """``keys`` as a written table and its rows; to be broadcast if they are few."""
    keys = materialize(keys)
    n = keys.count()
    return (F.broadcast(keys) if n <= BROADCAST_KEYS else keys), n


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the smallest by (id, fingerprint, text
    hash), then by the whole row. An id may stand on several texts: rows are told apart
    by (id, text hash), components by their root, as two can share their smallest id.
    Rows without an id all stay. Only narrow tables are shuffled; whole rows are only if
    more than ``BROADCAST_KEYS`` keys lose, and then Spark can split a hot key, as both
    sides of the join are plain exchanges."""
    hashed = docs.withColumn("_text_hash", F.xxhash64(F.col("text").cast("string")))
    fps = materialize(fingerprints(hashed, shingle, kept="_text_hash"))
    texts = materialize(fps.filter("doc_id IS NOT NULL").groupBy("doc_id", "_text_hash", "fp").agg(F.count("*").alias("rows")))
    first = materialize(
        texts.groupBy("fp").agg(F.min(F.struct("doc_id", "_text_hash")).alias("low"))
        .join(_rooted(fps, radius).select("fp", "root"), "fp")
        .groupBy("root").agg(F.min(F.struct("low.doc_id", "fp", "low._text_hash")).alias("low"))
        .select("low.doc_id", "low._text_hash")
    )
    key = ["doc_id", "_text_hash"]
    losing, _ = _keys(texts.select(*key).join(first, key, "left_anti"))
    kept = hashed.join(losing, key, "left_anti").select(*docs.columns, "_text_hash")
    again, n = _keys(texts.filter("rows > 1").select(*key).join(first, key, "left_semi"))
    if not n:  # no row to be thinned: no second pass over the rows
        return kept.select(*docs.columns)
    row = F.struct(*docs.columns)  # the smallest by all columns, so that a retried task chooses the same
    once = kept.join(again, key, "left_semi").groupBy(*key).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return kept.join(again, key, "left_anti").select(*docs.columns).unionByName(once)
