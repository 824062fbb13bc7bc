"""Documents dealt into chunks, and the exchange of hashes between chunks and ranges of hashes.

An operator that asks "which of these strings occur elsewhere" works in rounds. A chunk (some MB of
whole documents, chosen by a hash of doc_id) sends each distinct hash once, packed with its
neighbours into one row per range of hashes; the task of a range marks the hashes that matter and
answers each row with a bit mask. A string in a third of all documents thus costs one entry per
chunk, and no task gathers its occurrences. Chunks are functions of doc_id, so a task that runs
again after a lost executor sends the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.shared import ship

#: Bytes of text in a chunk, on average; bounds the memory of a Python task together with the longest document.
CHUNK_BYTES = 4 << 20
U = np.uint64
NO_ID = 2**63 - 1
ROWS = "bucket int, chunk long, kind int, a binary, b binary"
ROWS_ARROW = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())]
)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0)


def ranked(doc_id: str | Column) -> Column:
    """The id as a long; a null id comes after all others."""
    return F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(NO_ID)).cast("long")


def chunked(docs: DataFrame, total: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and the chunk, ready to be grouped by chunk."""
    ship(docs.sparkSession)
    n = max(1, -(-total // CHUNK_BYTES))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(doc_id), F.lit(11)), F.lit(n)).alias("chunk"),
    )


def in_order(table: pa.Table) -> pa.Table:
    """The documents of a chunk by id, nulls last, then by text: the same order in every round."""
    return table.take(
        pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])
    )


def pack(keys: np.ndarray) -> bytes:
    """Ascending unsigned numbers, as gaps of four bytes where they fit."""
    gaps = np.diff(keys)
    if len(gaps) and int(gaps.max()) >= 2**32:
        return b"\1" + keys.tobytes()
    return b"\0" + keys[:1].tobytes() + gaps.astype(np.uint32).tobytes()


def unpack(data: bytes) -> np.ndarray:
    if data[0] == 1:
        return np.frombuffer(data, U, offset=1)
    gaps = np.frombuffer(data, np.uint32, offset=9).astype(U)
    return np.cumsum(np.concatenate([np.frombuffer(data, U, count=1, offset=1), gaps]), dtype=U)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(data: bytes, n: int, at: int = 0) -> np.ndarray:
    """The n flags of one mask; ``at`` counts masks of the same length stored one after the other."""
    size = -(-n // 8)
    return np.unpackbits(np.frombuffer(data, np.uint8, count=size, offset=at * size), count=n).astype(bool)


def cuts(keys: np.ndarray, buckets: int, width: int) -> np.ndarray:
    """Where the ranges of hashes begin in ascending keys of ``width`` bits."""
    edges = np.array([(i << width) // buckets for i in range(buckets)], dtype=U)
    return np.append(np.searchsorted(keys, edges), len(keys))


def table(rows: list[tuple]) -> pa.Table:
    """Rows of ROWS."""
    return pa.Table.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, ROWS_ARROW)], schema=ROWS_ARROW
    )


def rows_of(got: pa.Table) -> list[tuple]:
    return list(zip(*(got.column(f.name).to_pylist() for f in ROWS_ARROW)))
