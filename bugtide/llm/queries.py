"""The registered queries of this folder, over whole tables with production settings."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugtide.llm import (
    alignment,
    chat,
    decontamination,
    divergence,
    language,
    licenses,
    packing,
    pitmanyor,
    sharding,
    simhash,
    substrings,
    topk,
    urlrules,
)
from bugtide.llm.tools import table

SHARDS = 16


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The tokenizer's file; the environment may name another."""
    return vocabulary_path("BUGTIDE_TOKENIZER", name)


def vocabulary_path(variable: str, name: str) -> str:
    """A vocabulary's file: the one that the environment names, or the public one."""
    if path := os.environ.get(variable):
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pitman_yor_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score_documents(table(spark, sf_dir, "documents"))


def op2_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"), SHARDS)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.leak_digest(found)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op5_branch_and_bound_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(
        table(spark, sf_dir, "documents"),
        vocabulary_path("BUGTIDE_BYTE_LEVEL", "byte_bpe_50k.json"),
        vocabulary_path("BUGTIDE_PIECES", "piece_bpe_32k.model"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


#: A conversation that speaks in control strings is formatted with the others.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    own = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    hostile = spark.createDataFrame(own, "conv_id bigint, turn bigint, role string, text string")
    return chat.chat_digest(chat.format_conversations(rows.select("conv_id", "turn", "role", "text").unionByName(hostile)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pitman_yor_scoring,
        op2_jump_sharding,
        op3_benchmark_decontamination,
        op4_language_id,
        op5_branch_and_bound_topk,
        op6_suffix_array_dedup,
        op7_url_rules,
        op8_simhash_near_dedup,
        op9_mixture_packing,
        op10_license_scan,
        op11_cross_tokenizer_alignment,
        op12_source_divergence,
        op13_chat_formatting,
    )
}
