"""Quality rules: base counts of each document and a hashed n-gram likelihood ratio, in DataFrame functions only.

Words and pairs of words are hashed to buckets. Two multinomials over the buckets, of the trusted documents and of the whole corpus, give
each bucket the logarithm of their ratio; the score of a document is the mean over its n-grams. Both have PSEUDO more occurrences in every
bucket, of which the target gets its share of the corpus, so a bucket with few occurrences is near 0 whatever the size of the corpus.
Documents are dealt into FOLDS by their text, and the ratios for one fold are of the counts of the others: no document, nor an exact copy
of it, speaks for or against itself. Ratios are kept as whole numbers of 2 ** -20, so sums do not depend on their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.shared import store

#: The buckets bound the table that is broadcast: a long and an int for each fold.
BUCKETS = 1 << 18
FOLDS = 4
#: Occurrences added to each bucket; with 8 some labelled clean documents of sf0.01 fell under the threshold, with 16 none.
PSEUDO = 16
#: Documents with a lower mean ratio (nats per n-gram) are rejected.
THRESHOLD = -0.15
#: Trusted ids up to which they are broadcast (16 MB); beyond that the join is shuffled.
BROADCAST_ROWS = 1_000_000
_UNIT = 2**20
_BLANKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _BLANKS), "")


def base_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, version (a hash of the text), n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    t = F.coalesce(F.col("t"), F.lit(""))
    one = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).cast("string").alias("t")
    )
    two = one.select(
        "doc_id", "version", words(F.col("t")).alias("w"),
        F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0).alias("lines"),
    )
    n = F.size("w")
    # Word triples with their places, sorted, so that equal ones are neighbours.
    triples = F.when(n >= 4, F.sort_array(F.arrays_zip(
        F.slice("w", 1, n - 2).alias("a"), F.slice("w", 2, n - 2).alias("b"), F.slice("w", 3, n - 2).alias("c"),
        F.sequence(F.lit(0), n - 3).alias("p"),
    )))
    three = two.select(
        "doc_id", "version", n.alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), triples.alias("triples"),
    )
    m = F.size("triples") - 1
    neighbours = F.arrays_zip(F.slice("triples", 1, m).alias("x"), F.slice("triples", 2, m).alias("y"))
    equal = F.filter(neighbours, lambda z: (z["x"]["a"] == z["y"]["a"]) & (z["x"]["b"] == z["y"]["b"]) & (z["x"]["c"] == z["y"]["c"]))
    four = three.withColumn("equal", F.when(F.col("triples").isNotNull(), equal))
    places = F.flatten(F.transform("equal", lambda z: F.array(z["x"]["p"], z["y"]["p"])))
    five = four.withColumn("places", F.array_distinct(places))
    repeat = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.array(p, p + 1, p + 2)))))
    return five.select(
        "doc_id", "version", *(F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")),
        F.when(F.size("places") > 0, repeat).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def n_grams(w: Column) -> Column:
    """Each word with the next, null after the last."""
    return F.arrays_zip(w.alias("one"), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))).alias("two"))


def _buckets(df: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """A row per word and per pair with its bucket."""
    pairs = df.select(*keep, F.explode(n_grams(F.col("w"))).alias("g"))
    single = F.pmod(F.xxhash64("g.one"), F.lit(buckets))
    double = F.when(F.col("g.two").isNotNull(), F.pmod(F.xxhash64("g.one", "g.two"), F.lit(buckets)))
    return pairs.select(*keep, F.explode(F.array(single, double)).alias("bucket")).where("bucket is not null")


def _fold(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """bucket and ratios (one for each fold, in units of 2 ** -20) for every bucket of the corpus; at most ``buckets`` rows."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct().withColumn("trusted", F.lit(1))
    ids = store(ids, "trusted")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _fold(F.col(text)).alias("fold"), words(F.col(text)).alias("w"))
    rows = rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "doc_id", "left")
    one = lambda k: F.when(F.col("fold") == k, 1).otherwise(0)
    counts = store(
        _buckets(rows.withColumn("trusted", F.coalesce("trusted", F.lit(0))), buckets, "trusted", "fold").groupBy("bucket").agg(
            *(F.sum(one(k) * F.col("trusted")).alias(f"target{k}") for k in range(FOLDS)),
            *(F.sum(one(k)).alias(f"raw{k}") for k in range(FOLDS)),
        ),
        "ngrams",
    )
    total = counts.agg(*(F.sum(c).alias(c) for c in counts.columns if c != "bucket")).first()

    def ratio(fold: int) -> Column:
        others = [k for k in range(FOLDS) if k != fold]
        target, raw = (sum(total[f"{c}{k}"] or 0 for k in others) for c in ("target", "raw"))
        if not target:
            return F.lit(0)
        share = target / raw
        of_target, of_raw = (reduce(Column.__add__, [F.col(f"{c}{k}") for k in others]) for c in ("target", "raw"))
        return F.round(F.log((of_target + PSEUDO * share) / ((of_raw + PSEUDO) * F.lit(share))) * _UNIT).cast("int")

    return counts.select("bucket", F.array(*(ratio(k) for k in range(FOLDS))).alias("ratios"))


def judge(
    docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document row: doc_id, version (a hash of the text), the base counts, base_failed, score and kept.

    trusted has the doc_id of the target documents. base_failed: fewer than 50 words, or more than half of them in
    repeated triples. kept: not base_failed and score >= threshold. A document without words scores 0; without trusted
    documents in the other folds all of a fold score 0. Null texts have no words; null ids are never trusted; rows that share id and text get the same
    result. Other columns are not read. An empty table gives an empty result.
    """
    # Stored, as a filter on the verdict would else be pushed down and work out the counts again and again.
    base = store(base_counts(docs, doc_id, text), "base")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), _fold(F.col(text)).alias("fold"),
        words(F.col(text)).alias("w"),
    )
    weights = store(ratios(docs, trusted, buckets, doc_id, text), "ratios")
    scores = (
        _buckets(rows, buckets, "doc_id", "version", "fold").join(F.broadcast(weights), "bucket")
        .groupBy("doc_id", "version").agg((F.sum(F.get("ratios", "fold")) / F.count("*") / _UNIT).alias("score"))
        .select(F.col("doc_id").alias("d"), F.col("version").alias("v"), "score")
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        base.join(scores, base.doc_id.eqNullSafe(scores.d) & (base.version == scores.v), "left")
        .withColumn("score", F.coalesce("score", F.lit(0.0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("score") >= threshold))
        .drop("d", "v")
    )
