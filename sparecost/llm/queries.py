"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparecost.llm.chat import link_quotes, render_quotes
from sparecost.llm.common import Scratch, table
from sparecost.llm.conversation_repair import repair_damaged
from sparecost.llm.exact_dedup import exact_dedup
from sparecost.llm.jaccard_join import jaccard_components
from sparecost.llm.lattice import sentencepiece_check
from sparecost.llm.oracle import SQL
from sparecost.llm.packing import pack_documents
from sparecost.llm.phrase_dedup import phrase_dedup
from sparecost.llm.positional_index import contamination
from sparecost.llm.quality_cnn import quality_scores
from sparecost.llm.quality_rules import quality_rules
from sparecost.llm.resampling import resample
from sparecost.llm.sharding import shard_documents
from sparecost.llm.suffix_dedup import suffix_dedup


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_check(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), 100)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn rendered as a mail that quotes the turns before it; replies and own words are found again from the mails alone."""
    mails = Scratch(spark, "mails").keep(render_quotes(table(spark, sf_dir, "conversations")), "mails")
    found = link_quotes(mails)
    own = mails.select("conv_id", "turn", F.trim("own").alias("own")).dropDuplicates(["conv_id", "turn"])
    known = found["conv_id"].eqNullSafe(own["conv_id"]) & found["turn"].eqNullSafe(own["turn"])
    return found.join(own, known, "left").select(found["*"], F.trim("body").eqNullSafe(F.col("own")).alias("body_right"))


def op9_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup(table(spark, sf_dir, "documents"), 13)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items, "contaminated")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), buckets=10_000, seed=7, percent=25, min_words=20)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_jaccard_join, op2_sharding, op3_sentencepiece, op4_suffix_dedup, op5_exact_dedup, op6_quality_rules,
        op7_best_fit_packing, op8_chat_formatting, op9_phrase_dedup, op10_quality_classifier, op11_decontamination,
        op12_importance_resampling, op13_conversation_repair)
}

__all__ = ["QUERIES", "SQL"]
