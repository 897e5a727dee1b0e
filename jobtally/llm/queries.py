"""Registered queries of the operators, at production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtally.llm import (
    chat, conversation_repair, gray_index, line_quality, mixing, near_dedup, packing, ppm, prefix_trie, revisits, suffix_dedup, syncmers,
    toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.col("sd_bytes").alias("n_bytes"), F.col("sd_removed").alias("n_removed"),
        F.size("sd_begin").cast("long").alias("n_spans"), F.col("sd_sha256").alias("kept_sha256"),
    )


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revisits.resolve(revisits.captures(_table(spark, sf_dir, "pages")))
    return out.select(
        "record_id", "url", "canonical_url", F.unix_seconds("date").alias("second"), "outcome", "response_id",
        revisits.header_lines(F.col("merged_headers")).alias("merged_headers"), F.col("response_digest").alias("payload_sha256"),
    )


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85).drop("digest")


def op4_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents"), ppm.learned_rows())


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_quality.judge(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.col("lq_words").alias("n_words"), F.col("lq_word_chars").alias("word_chars"),
        F.col("lq_symbols").alias("n_symbols"), F.col("lq_dup_lines").alias("n_dup_lines"),
        F.col("lq_repeat_words").alias("n_repeat_words"), F.col("lq_base_failed").alias("base_failed"),
        F.col("lq_kept").alias("kept"),
    )


def op6_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_passes")).alias("taken"),
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = [(-1, i, role, chat.PROBE_TEXT) for i, role in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.createDataFrame(probe, rows.schema))
    return chat.digests(chat.format_conversations(rows, tokenizer_path()))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(_table(spark, sf_dir, "conversations")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gray_index.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", gray_index.code_text(F.col("code")).alias("fingerprint"), "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline, which lies beside the package and imports this module."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_revisits": op2_revisits,
    "op3_near_dedup": op3_near_dedup,
    "op4_ppm_score": op4_ppm_score,
    "op5_line_quality": op5_line_quality,
    "op6_closed_syncmers": op6_closed_syncmers,
    "op7_toxicity": op7_toxicity,
    "op8_source_mix": op8_source_mix,
    "op9_chat_format": op9_chat_format,
    "op10_packing": op10_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash": op13_simhash,
    "pipeline": pipeline,
}

ORACLE_SQL = {
    "op2_revisits": revisits.ORACLE,
    "op5_line_quality": line_quality.ORACLE,
    "op8_source_mix": mixing.ORACLE,
    "op9_chat_format": chat.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
