"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, chat_sql, jaccard_join, licenses, line_dedup, line_dedup_sql, media, mixing, mixing_sql, packing, periodic, quality, token_counts, token_files, toxicity, vector_codes, vector_codes_sql
from tidemark.llm.common import table
from tidemark.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets lie far from the sources' own shares: proportions to the square roots of their tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0, seq_len=1024, temper=0.5)


def op2_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE, limit=1024)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lit(r"\### Assistant: </turn> ok")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.format_chats(turns))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op6_bitpacked_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), out, WORD_BPE, end_id=2)
    return token_files.read_tokens(spark, out, ids="crc32")


def op7_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"), target_entropy=0.9, most_repeats=2.0)


def op9_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.page_digests(media.tiff_pages(media.store_bytes(table(spark, sf_dir, "documents")), keep=["n_bytes"]))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"), least=40, copies=5)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.periodic_runs(periodic.made_periodic(table(spark, sf_dir, "documents"))))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixture_packing": op1_mixture_packing,
        "op2_prefix_token_counts": op2_prefix_token_counts,
        "op3_chat_format": op3_chat_format,
        "op4_license_scan": op4_license_scan,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_bitpacked_tokens": op6_bitpacked_tokens,
        "op7_ngram_toxicity": op7_ngram_toxicity,
        "op8_temperature_mixing": op8_temperature_mixing,
        "op9_tiff_media": op9_tiff_media,
        "op10_quality_rules": op10_quality_rules,
        "op11_line_dedup": op11_line_dedup,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_format": chat_sql.ORACLE,
        "op8_temperature_mixing": mixing_sql.ORACLE,
        "op11_line_dedup": line_dedup_sql.ORACLE,
        "op13_vector_codes": vector_codes_sql.ORACLE,
    }
