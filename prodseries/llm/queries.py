"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseries.llm import (
    conversation_repair,
    decontamination,
    language_id,
    line_chunks,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    recompression,
    sharding,
    substring_dedup,
    token_files,
    vector_codes,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The tokenizer file is a parameter; it is not part of the repository.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"), TOKENIZER, width=2048)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.token_folder(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_files.read_token_files(spark, path).drop("ids")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its source; its path, one level below, the source's language."""
    path = F.concat_ws("/", "source", "lang")
    return quality_classifier.posteriors(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), path)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(table(spark, sf_dir, "documents"), 24, with_text=False)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_chunks.without_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256")
    )


def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repairs = conversation_repair.repaired(conversation_repair.damaged(conversations))
    return conversation_repair.for_every_conversation(conversations, repairs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_arrays": op1_suffix_arrays,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_token_files": op4_token_files,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_sharding": op9_sharding,
    "op10_line_chunks": op10_line_chunks,
    "op11_vector_codes": op11_vector_codes,
    "op12_recompression": op12_recompression,
    "op13_conversation_repair": op13_conversation_repair,
}
