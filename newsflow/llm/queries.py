"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from newsflow.llm import (alignment, lm_score, mixing, near_dedup, packing, pii, quality, repair, secret_scan, suffix_dedup,
                          token_output, topk, vector_packing)
from newsflow.llm.common import read_table


def tokenizer_file(name: str) -> str:
    """A public vocabulary file; ``NEWSFLOW_TOKENIZERS`` names another folder of them."""
    folder = os.environ.get("NEWSFLOW_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op3_masked_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(read_table(spark, sf_dir, "documents"))


def op4_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(read_table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op7_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_output.scratch_path(spark)
    token_output.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), path)
    return token_output.token_digest(spark, path)


def op8_forest_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def op9_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(read_table(spark, sf_dir, "documents"))


def op10_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                                      tokenizer_file("piece_bpe_32k.model"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digest(repair.damaged(read_table(spark, sf_dir, "conversations")),
                                read_table(spark, sf_dir, "conversations"))


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack_vectors(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (
    op1_segment_topk, op2_curve_packing, op3_masked_lm_scores, op4_run_length_dedup, op5_minhash_near_dedup,
    op6_curriculum_mix, op7_huffman_tokens, op8_forest_secrets, op9_mcd_quality, op10_crf_personal_data,
    op11_token_alignment, op12_conversation_repair, op13_vector_packing)}

ORACLE: dict[str, str] = {}
