"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm import decontamination, line_dedup, near_dedup, packing, quality
from oreline.llm.queries import tokenizer_path
from oreline.llm.shared import store


def _of_verdict(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows whose doc_id and text are among (doc_id, version); nulls equal nulls."""
    verdict = kept.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).distinct()
    same = docs["doc_id"].eqNullSafe(verdict["_id"]) & (F.xxhash64(docs["text"]) == verdict["_version"])
    return docs.join(verdict, same, "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go.

    A null or empty text has no words and goes; a null id is never trusted; rows that share id and text stay or go together. Other columns
    follow unchanged. An empty table stays empty.
    """
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return _of_verdict(docs, quality.judge(docs, trusted).where("kept"))


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars follows the text. A document keeps its row also when no line is left.

    A null text stays null. Rows without an id are one document after all others, rows that share an id are one document. Other columns follow
    unchanged, whatever their names. An empty table stays empty.
    """
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    out = line_dedup.repeated_lines(rows, carry=("row",))
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return out.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays.

    Texts without words are linked with nothing and stay. Rows that share an id stay or go together; those without an id come after all others. Other
    columns follow unchanged. An empty table stays empty.
    """
    kept = near_dedup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]), "left_semi")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null and empty texts hold none and stay, null items have no window; a single window is enough. Other columns follow unchanged. An empty table
    stays empty.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _of_verdict(docs, decontamination.contaminated(docs, items).where("n_hit = 0"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences.

    A null or empty text is one piece, its end; null and repeated ids are documents like others. Other columns go. An empty table gives an empty result.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_repeats),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("packing", pack),
]

#: Likelihood ratios of hashed n-grams and token ids are beyond SQL; tests/llm/test_plain.py compares each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
