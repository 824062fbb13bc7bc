"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Every run of ``window`` words of an item is a set whose words must all occur, so its prefix under an order by rarity in
the documents is one word, the rarest. Words of documents are joined with these prefixes alone; the place of
the word in the window fixes where the window would stand, which must lie within the document (positional and length
bounds), and there the words are compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.shared import store

#: Rows of item words and prefixes up to which they are broadcast (some 10 MB); beyond that they are shuffled.
BROADCAST_ROWS = 100_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def tokens(text: Column) -> Column:
    """Runs of a-z, 0-9 and all characters beyond ASCII, after A-Z is lower-cased; null has none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, _SEPARATORS), "")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows of the items: words (an array) and the items that hold it."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), tokens(F.col("text")).alias("w")).where(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1)))
    return (
        words.withColumn("s", start).select("item_id", F.slice("w", F.col("s"), window).alias("words"))
        .groupBy("words").agg(F.collect_set("item_id").alias("items"))
    )


def contaminated(
    docs: DataFrame, items: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text", broadcast_rows: int | None = None
) -> DataFrame:
    """Which documents hold windows of benchmark items.

    items has item_id and text. An item with fewer words than ``window`` is one window, one without words none; null item
    ids name no item but their windows count as hits. One row per document row: doc_id, version (a hash of the text), n_words, n_hit (words
    inside any occurrence), spans (start and length of the occurrences), items (ids as strings, sorted). Null texts have no
    words. Rows that share id and text get the same result. Other columns are not read. Empty tables give
    no hits, or no rows.
    """
    small = (lambda df, n: F.broadcast(df) if n <= broadcast_rows else df) if broadcast_rows is not None else _small
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), tokens(F.col(text)).alias("w")
    )
    windows = store(item_windows(items.select("item_id", "text"), window).withColumn("k", F.size("words")), "windows")
    places = windows.select("words", F.posexplode("words").alias("at", "word"))
    vocabulary = store(places.select("word").distinct(), "vocabulary")
    n_words = vocabulary.count()

    # Rarity in the documents; a window with a word that no document holds cannot occur.
    found = rows.select(F.explode("w").alias("word")).join(small(vocabulary, n_words), "word")
    rarity = found.groupBy("word").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct("n", "word", "at")).alias("rarest")
    missing = F.max(F.col("n").isNull().cast("int")).alias("missing")
    prefixes = store(
        places.join(rarity, "word", "left").groupBy("words").agg(rarest, missing).where("missing = 0")
        .select("words", F.col("rarest.word").alias("word"), F.col("rarest.at").alias("at")).join(windows, "words"),
        "prefixes",
    )
    n_prefixes = prefixes.count()

    start = F.col("pos") - F.col("at")
    bounds = (F.col("pos") >= F.col("at")) & (F.col("pos") - F.col("at") + F.col("k") <= F.col("n_words"))
    if n_prefixes <= (BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        # The document's words stay at hand in the task, and only occurrences leave it.
        near = rows.select("doc_id", "version", "w", F.size("w").alias("n_words"), F.posexplode("w").alias("pos", "word"))
        verified = near.join(F.broadcast(prefixes), "word").where(bounds & (F.slice("w", start + 1, F.col("k")) == F.col("words")))
    else:
        near = rows.select("doc_id", "version", F.size("w").alias("n_words"), F.posexplode("w").alias("pos", "word"))
        placed = near.join(prefixes, "word").where(bounds).select(
            F.col("doc_id").alias("d"), F.col("version").alias("v"), "pos", "at", "k", "words", "items"
        )
        verified = rows.join(placed, rows.doc_id.eqNullSafe(placed.d) & (rows.version == placed.v)).where(
            F.slice("w", start + 1, F.col("k")) == F.col("words")
        )
    hits = (
        verified.select("doc_id", "version", start.alias("start"), "k", "items")
        .groupBy("doc_id", "version")
        .agg(F.collect_set(F.struct("start", F.col("k").alias("length"))).alias("spans"), F.collect_set("items").alias("items"))
        .select(
            F.col("doc_id").alias("d"), F.col("version").alias("v"), F.array_sort("spans").alias("spans"),
            F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        )
    )
    inside = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    sizes = rows.select("doc_id", "version", F.size("w").alias("n_words"))
    return sizes.join(hits, sizes.doc_id.eqNullSafe(hits.d) & (sizes.version == hits.v), "left").select(
        "doc_id", "version", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce(F.size(F.array_distinct(inside)), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
