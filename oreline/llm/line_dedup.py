"""Line dedup with two Bloom filters.

A first pass over the texts sends two bit places per line to the segment of a blocked filter that its hash
selects. A segment's task keeps two filters, places seen once and places seen twice; only the second goes to
all tasks. A second pass lets through only lines whose places were all seen twice, and these alone are shuffled, by their
whole text, to confirm the repeat and to choose the document that keeps it.
The filter has 16 bits per line, at most ``MAX_BITS``. Beyond that more lines are suspected;
the result is the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm import exchange as X
from oreline.llm.shared import ship, store

SEGMENT = 1 << 16
#: 32 MB, the bound of what is broadcast.
MAX_BITS = 1 << 28
OUT = "doc_id long, n_lines long, n_dropped long, dropped array<int>, kept string"


def _key(line: bytes, min_chars: int) -> bytes | None:
    """bytes.strip and bytes.lower know the six ASCII blanks and A-Z only."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _places(keys, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment and the two places in it for each key."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), dtype=np.uint64)
    segment = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    return segment.astype(np.int64), (h & np.uint64(0xFFFF)).astype(np.uint16), (h >> np.uint64(16)).astype(np.uint16)


def _filter(docs: DataFrame, segments: int, min_chars: int) -> np.ndarray:
    """The filter of places seen twice, a row of packed bits per segment."""

    def send(batches):
        for batch in batches:
            keys = []
            for text in batch.column("text").to_pylist():
                own = {_key(x, min_chars) for x in (text or "").encode().split(b"\n")}
                own.discard(None)
                keys.extend(own)
            segment, one, two = _places(keys, segments)
            order = np.argsort(segment, kind="stable")
            segment, pair = segment[order], np.stack([one, two], axis=1)[order]
            names, starts = np.unique(segment, return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array([x.tobytes() for x in np.split(pair, starts[1:])] if len(names) else [], pa.binary())],
                names=["segment", "places"],
            )

    def build(got: pa.Table) -> pa.Table:
        once, twice = np.zeros(SEGMENT, dtype=bool), np.zeros(SEGMENT, dtype=bool)
        for data in got.column("places").to_pylist():
            pair = np.frombuffer(data, np.uint16).reshape(-1, 2)
            # A line with two equal places counts for one, or it would look seen twice by itself.
            places = np.concatenate([pair[:, 0], pair[pair[:, 0] != pair[:, 1], 1]])
            found, number = np.unique(places, return_counts=True)
            twice[found[(number > 1) | once[found]]] = True
            once[found] = True
        return pa.table({
            "segment": got.column("segment")[:1], "bits": pa.array([np.packbits(twice).tobytes()], pa.binary()),
        })

    sent = docs.select("text").mapInArrow(send, "segment int, places binary")
    built = sent.groupBy("segment").applyInArrow(build, "segment int, bits binary")
    out = np.zeros((segments, SEGMENT // 8), dtype=np.uint8)
    for segment, bits in built.toLocalIterator():
        out[segment] = np.frombuffer(bits, np.uint8)
    return out


def repeated_lines(
    docs: DataFrame, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Keep a line that stands in several documents only in the document of the smallest id.

    Lines are split at \\n and compared without blanks at both ends and with A-Z lower-cased; keys of fewer
    than ``min_chars`` code points stay. One row per input row: doc_id, n_lines, n_dropped, dropped (line numbers from 0)
    and kept (the other lines joined by \\n, empty when none is left).
    A null or empty text is one empty line. A null id is one document after all others; rows that share
    an id are one document. Columns named in ``carry`` follow unchanged, others are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    held = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.struct(F.lit(0).alias("none"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(carry))).alias("held"),
    )
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    n = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    segments = max(1, min(max_bits, 1 << (16 * int(n)).bit_length()) // SEGMENT)
    bits = spark.sparkContext.broadcast(_filter(rows, segments, min_chars))

    def suspects(batches):
        for batch in batches:
            ids, keys = [], []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = {_key(x, min_chars) for x in (text or "").encode().split(b"\n")}
                own.discard(None)
                keys.extend(own)
                ids.extend([i] * len(own))
            segment, one, two = _places(keys, segments)
            seen = np.ones(len(keys), dtype=bool)
            for place in (one, two):
                seen &= (bits.value[segment, place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
            chosen = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[k] for k in chosen], pa.int64()), pa.array([keys[k].decode() for k in chosen], pa.string())],
                names=["doc_id", "key"],
            )

    suspected = store(
        rows.mapInArrow(suspects, "doc_id long, key string").select(X.ranked("doc_id").alias("rank"), "key"), "lines"
    )
    repeats = (
        suspected.groupBy("key").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
        .where("first < last").select("key", "first")
    )
    lost = (
        suspected.join(repeats, "key").where("rank > first")
        .groupBy("rank").agg(F.collect_set("key").alias("lost"))
    )

    def remove(batches):
        for batch in batches:
            out = []
            for i, text, lost in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lost"))):
                lines = (text or "").encode().split(b"\n")
                gone = []
                if lost:
                    lost = {x.encode() for x in lost}
                    gone = [k for k, line in enumerate(lines) if _key(line, min_chars) in lost]
                    dropped = set(gone)
                    kept = b"\n".join(x for k, x in enumerate(lines) if k not in dropped).decode()
                else:
                    kept = text or ""
                out.append((i, len(lines), len(gone), gone, kept))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)), batch.column("held")],
                names=["doc_id", "n_lines", "n_dropped", "dropped", "kept", "held"],
            )

    whole = held.withColumn("rank", X.ranked("doc_id")).join(lost, "rank", "left")
    out = whole.select("doc_id", "text", "lost", "held").mapInArrow(remove, f"{OUT}, held {held.schema['held'].dataType.simpleString()}")
    return out.select(
        "doc_id", "n_lines", "n_dropped", "dropped", "kept", *(F.col(f"held.c{k}").alias(c) for k, c in enumerate(carry))
    )
