"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm import (
    conversation_repair,
    decontamination,
    language_id,
    line_dedup,
    near_dedup,
    packing,
    quality,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    token_counts,
    toxicity,
    warc,
)

#: A text counts as toxic from this probability of a grade above 0.
TOXIC_FROM = 0.25


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: A text of more tokens is over the limit of the counting query.
TOKEN_LIMIT = 4096


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Learn from a bounded sample of the labelled documents, score all: doc_id, expected_severity, p_toxic, toxic."""
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    labels = _read(spark, folder, "labels").select("doc_id", F.col("toxic").alias("grade"))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).withColumn("toxic", F.col("p_toxic") >= TOXIC_FROM)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = decontamination.contaminated(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = _read(spark, folder, "labels").where("quality = 1")
    return quality.judge(_read(spark, folder, "documents"), trusted).drop("version")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.repeated_lines(_read(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op5_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.write(_read(spark, folder, "pages"))
    return warc.read(archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_read(spark, folder, "documents"))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, folder, "documents"))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_read(spark, folder, "documents"), tokenizer_path())


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup.repeated_words(_read(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix_dedup.repeated_bytes(_read(spark, folder, "documents"))
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    out = token_counts.token_counts(_read(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    out = token_alignment.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversation_repair.damaged(_read(spark, folder, "conversations"))
    return conversation_repair.repair(rows, turns=False, absent="absent").select("conv_id", "verdict.*")


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_decontamination, op3_quality_rules, op4_line_dedup, op5_warc_archive, op6_language_id, op7_near_dedup, op8_best_fit_packing, op9_substring_dedup,
        op10_suffix_dedup, op11_token_counts, op12_token_alignment, op13_conversation_repair,
    )
}
