"""The contract queries of the training-data operators, by name, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import fingerprint, hostrules, langid, mixing, neardup, packing, pii, quality, substring, toxicity
from .common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, remainder = table(spark, sf_dir, "documents"), langid.fold(4)
    return langid.identify(docs.withColumn("held_out", remainder == 2), langid.fit(docs, remainder != 2))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, remainder = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), langid.fold(5)
    model = quality.fit(docs, labels, remainder != 0)
    scored = quality.score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", (remainder == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_examples(packing.prompted(table(spark, sf_dir, "documents")), loss=packing.LOSS, prompt_share="prompt_share")
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hostrules.host_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"), mixing.TARGETS)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_personal_data": op2_personal_data,
    "op3_language_id": op3_language_id,
    "op4_fingerprints": op4_fingerprints,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_host_rules": op8_host_rules,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
}

ORACLE: dict[str, str] = {
    "op8_host_rules": hostrules.SQL,
}
