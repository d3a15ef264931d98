"""SpotSigs fingerprints, with DataFrame functions only.

A text becomes lower-cased words (letters and digits). Common words are anchors, all
others content words. Every anchor (the last one, where several follow each other) and
the text's beginning start a chain: the next ``CHAIN`` content words. The hashes of
anchor and chain are the text's signature set; its fingerprint is the sorted set, eight
hex digits each. ``likeness`` is the Jaccard similarity of two sets.

``search`` finds, for a query set, all documents of likeness ``threshold`` or more.
Equal sets are one class first. Sets are partitioned by length so that only equal or
neighbouring partitions can hold partners (a set that similar is at most 1/threshold
times as long). In a partition a class is entered under its rarest signatures only:
sets that similar share one of their first n - ceil(threshold * n) + 1 in a common
order (rarest first). Candidates meet on partition and signature, are pruned by
length, then by the exact Jaccard similarity.

``edited_pairs`` compares each document with an edited form of itself and with the
next document.

Cases: null text is empty; a text without words has the empty set, and two empty sets
are alike (1). A text of fewer content words than a chain gives a shorter chain. Rows
that repeat an id with the same text are one document in the order of documents and
keep all their rows. Null ids come last in descending order. Other columns are
ignored; empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verso.llm.common import materialize

CHAIN = 2
THRESHOLD = 0.8

# Common words of English, French, German and Spanish.
ANCHORS = """a and are as at be by for from in is it of on that the this to was were with
au de des du en et la le les par pour que qui sur un une
auf das dem den der des die ein ist mit nicht sich und von zu
con del el las los por se y""".split()


def with_signatures(docs: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """Adds ``out``: sorted distinct signature hashes of a text (array of int)."""
    anchor = "|".join(sorted(set(ANCHORS), key=lambda w: (-len(w), w)))
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    # Glue each run of anchors, as its last one, to the content word that follows:
    # "of the cat" becomes "the^cat". The beginning of the text is an anchor, too.
    # Possessive: the greedy form recurses once for each anchor of a run.
    glued = F.regexp_replace(words, rf"(?<= )(?:({anchor}) )++", "$1^")
    spots = F.split(F.concat(F.lit("^"), F.trim(glued)), " +")
    found = docs.withColumn("_spots", spots).withColumn("_content", F.transform("_spots", lambda w: F.substring_index(w, "^", -1)))
    later = [F.slice("_content", k + 2, F.size("_content")).alias(f"w{k}") for k in range(chain - 1)]
    rows = F.filter(F.arrays_zip(F.col("_spots").alias("spot"), *later), lambda r: r["spot"].contains("^") & ~r["spot"].endswith("^"))
    hashes = F.transform(rows, lambda r: F.shiftright(F.xxhash64(r["spot"], *[r[f"w{k}"] for k in range(chain - 1)]), 32).cast("int"))
    return found.withColumn(out, F.sort_array(F.array_distinct(hashes))).drop("_spots", "_content")


def fingerprint(signatures: str) -> Column:
    """A signature set as text: eight hex digits for each signature."""
    return F.array_join(F.transform(signatures, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two signature sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _ring(keys: DataFrame) -> DataFrame:
    """(k, prev, take): of each document (key k) the one before it in descending
    order (key prev), whose edited text takes that many characters from it (round
    the ring). No single-task window: rows are range-partitioned, and each
    partition's first row looks at the last of the partition before."""
    down = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    parts = materialize(keys.repartitionByRange(*down).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(*down)
    row = F.struct("k", F.floor(F.col("n_chars") / 3).cast("int").alias("take"))
    rows = parts.select("part", "k", F.lag(row).over(inside).alias("prev"))
    # The last row of each partition, carried to the next one.
    lasts = parts.select("part", row.alias("row"), F.lead("k").over(inside).isNull().alias("is_last")).filter("is_last")
    whole = Window.orderBy("part")  # one row a partition
    end = F.last("row").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = lasts.select("part", F.coalesce(F.lag("row").over(whole), end).alias("carried"))
    found = rows.join(ends, "part").withColumn("prev", F.coalesce("prev", "carried"))
    return found.select("k", F.col("prev.k").alias("prev"), F.col("prev.take").alias("take"))


def edited_pairs(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """One row per document: its fingerprint, that of its text with the last third
    replaced by the beginning of the next document (descending id, then round), and
    how alike the fingerprint is to that and to the next document's.

    The text is shuffled once by document, and the beginnings with the next
    document's signatures once more."""
    texts = _documents(docs)
    # A document's key: its id and a hash of its text.
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))
    keys = texts.select("doc_id", F.xxhash64("text").alias("h"), key.alias("k"), F.char_length("text").alias("n_chars")).distinct()
    ring = materialize(_ring(keys))
    wide = texts.select(key.alias("k"), "text")
    sent = with_signatures(wide.join(ring, "k"), "text", "next_signatures", chain)
    sent = sent.select("prev", F.col("text").substr(F.lit(1), F.col("take")).alias("beginning"), "next_signatures").dropDuplicates(["prev"])
    met = wide.join(sent, F.col("k") == F.col("prev")).withColumn("n_chars", F.char_length("text"))
    keep = (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int")
    met = met.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), keep), F.col("beginning")))
    met = with_signatures(with_signatures(met, "text", "own", chain), "edited", "changed", chain)
    return met.select(
        F.substring_index("k", ":", 1).try_cast("long").alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"), fingerprint("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "next_signatures").alias("near_next"),
    )


def search(queries: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, chain: int = CHAIN) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs (query, found, likeness) between classes of equal
    signature sets, and the documents (doc_id, class) of each class. A class is named
    by its fingerprint's hash and size. Only non-empty sets take part."""

    def classes(part: DataFrame) -> DataFrame:
        sets = with_signatures(_documents(part), "text", "s", chain).filter(F.size("s") > 0)
        return sets.select("doc_id", F.sha2(fingerprint("s"), 256).alias("class"), "s")

    members = materialize(classes(docs))
    asked = materialize(classes(queries).select("class", "s").dropDuplicates(["class"]))
    every = materialize(members.select("class", "s").dropDuplicates(["class"]))
    rarity = every.select(F.explode("s").alias("x")).groupBy("x").agg(F.count("*").alias("df"))
    step = math.log(1 / threshold)

    def entries(sets: DataFrame) -> DataFrame:
        n = F.size("s")
        ranked = sets.select("class", n.alias("n"), F.explode("s").alias("x")).join(rarity, "x", "left").groupBy("class", "n").agg(
            F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "x"))).alias("r"))
        prefix = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")
        return ranked.select("class", "n", F.floor(F.log("n") / step + 1e-9).alias("part"), F.explode(F.slice("r", F.lit(1), prefix)).alias("r")).select("class", "n", "part", F.col("r.x").alias("x"))

    q = entries(asked).select(F.col("class").alias("query"), F.col("n").alias("qn"), "x", F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"))
    near = entries(every).withColumnRenamed("class", "found").join(q, ["part", "x"])
    near = near.filter(F.least("n", "qn") >= F.greatest("n", "qn") * threshold - 1e-9).select("query", "found").distinct()
    pairs = near.join(asked.select(F.col("class").alias("query"), F.col("s").alias("a")), "query").join(every.select(F.col("class").alias("found"), F.col("s").alias("b")), "found")
    pairs = pairs.select("query", "found", likeness("a", "b").alias("likeness")).filter(F.col("likeness") >= threshold)
    return pairs, members.select("doc_id", "class")
