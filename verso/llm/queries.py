"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verso.llm import byte_bpe, chat_events, common, exact_dedup, hd_langid, hmm_lm, license_scan, periodic_runs, pii_weak, repair_ids, simhash_bk, spelling_variants, spot_sigs, string_tiling


def tokenizer_path(name: str) -> str:
    """Path of a public vocabulary file; installed on every machine, as Spark is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hd_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    out = hd_langid.identify(docs, ~common.is_held_out("doc_id", 4))
    return out.select("doc_id", common.is_held_out("doc_id", 4).alias("held_out"), "lang_pred", "score")


def op2_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_ids.write_and_read(common.documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op3_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    log = chat_events.events_of_rows(rows.unionByName(chat_events.probe_conversation(spark)))
    output = common.written(chat_events.render(chat_events.reconstruct(log)), "chat")
    return chat_events.digests(chat_events.read_back(output))


def op4_spot_sigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_sigs.edited_pairs(common.documents(spark, sf_dir))


def op5_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_weak.find(common.documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(common.documents(spark, sf_dir), tokenizer_path("byte_bpe_multi_50k.tiktoken"))


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.leaks(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score(common.documents(spark, sf_dir), common.is_held_out("doc_id", 7))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(common.documents(spark, sf_dir))


def op10_simhash_bk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bk.near_dedup(common.documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.find(periodic_runs.with_planted_runs(common.documents(spark, sf_dir))))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(spelling_variants.word_counts(common.documents(spark, sf_dir), planted=True))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digests(common.documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hd_langid": op1_hd_langid,
    "op2_repair_ids": op2_repair_ids,
    "op3_chat_events": op3_chat_events,
    "op4_spot_sigs": op4_spot_sigs,
    "op5_pii_weak": op5_pii_weak,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_string_tiling": op7_string_tiling,
    "op8_hmm_lm": op8_hmm_lm,
    "op9_license_scan": op9_license_scan,
    "op10_simhash_bk": op10_simhash_bk,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_exact_dedup": op13_exact_dedup,
}

#: The other methods cannot be stated in SQL; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op13_exact_dedup": (
        "SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, "
        "row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256 "
        "FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"
    ),
}
