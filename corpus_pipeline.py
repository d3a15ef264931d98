"""Documents to training tokens in five stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``:

1. language ID (hyperdimensional profiles): documents whose language cannot be told
   go (no letters, or enough n-grams to see that they are like no language at all);
2. SimHash near-dedup (BK-trees, 4-word shingles, 4 bits): one document of each
   group stays, the one with the smallest id;
3. benchmark decontamination (greedy string tiling): documents that hold a benchmark
   item go;
4. personal data (weak supervision): spans are replaced by their kind;
5. byte-level BPE: token ids, and digests of ids and of the decoded bytes.

All but the last return the columns of ``documents``. Cases (null, empty, repeated
rows, other columns) are those of the operators; an empty table goes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verso.llm import byte_bpe, common, hd_langid, pii_weak, simhash_bk, string_tiling
from verso.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hd_langid.keep_identified(docs, *hd_langid.train_with_totals(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_bk.keep_first(docs, shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return string_tiling.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_weak.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.tokenized(docs, tokenizer_path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: No stage can be stated in SQL; the tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
