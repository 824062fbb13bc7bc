"""Substring dedup by fixed-block anchors.

Each document is cut into non-overlapping blocks of ``block`` words, the index. Every rolling window
of ``block`` words probes it. With 2 * block - 1 <= window, each repeated window holds a whole block of
the document it is compared with, so a window without a probe that hits needs no more work. Hits
are extended: all windows around them are compared in full (by 96 bits of hash after the 48 of
the probe), and the windows that hold make up the maximal repeats.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from oreline.llm import exchange as X
from oreline.llm import textops as T

U = np.uint64
OUT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,length:long>>, kept string"


class _Chunk:
    """The words of a chunk, their probes and windows."""

    def __init__(self, got: pa.Table, window: int, block: int):
        self.docs = X.in_order(got)
        self.data, self.offsets = T.flat(self.docs.column("text"))
        self.starts, self.ends, self.doc = T.words(self.data, self.offsets)
        self.hash = T.span_hashes(self.data, self.starts, self.ends)
        self.ids = self.docs.column("doc_id").fill_null(X.NO_ID).to_numpy()
        self.counts = np.bincount(self.doc, minlength=len(self.ids))
        self.first = np.cumsum(self.counts) - self.counts
        self.window, self.block = window, block
        n = max(0, len(self.doc) - block + 1)
        inside = self.doc[:n] == self.doc[block - 1 :][:n]
        self.at = np.flatnonzero(inside & (self.counts[self.doc[:n]] >= window))
        self.n = n

    def probes(self):
        """Distinct hashes of all rolling blocks, and the one of each place in ``at``."""
        keys = T.windows(self.hash, self.block, 1)[self.at] >> U(16)
        return np.unique(keys, return_index=True, return_inverse=True)

    def suspects(self, hit: np.ndarray):
        """Windows that hold a place of ``at`` whose probe hit: distinct hashes by ascending order, each
        with the first document that holds it; the places and the hash that each place has."""
        n = max(0, len(self.doc) - self.window + 1)
        flags = np.zeros(self.n + 1, dtype=np.int64)
        flags[self.at[hit]] = 1
        sums = np.concatenate([[0], np.cumsum(flags)])
        reach = self.window - self.block + 1
        places = np.flatnonzero(
            (self.doc[:n] == self.doc[self.window - 1 :][:n]) & (sums[reach : reach + n] > sums[:n])
        )
        a = T.windows(self.hash, self.window, 2)[places]
        b = (T.windows(self.hash, self.window, 3)[places] >> U(32)).astype(np.uint32)
        order = np.lexsort((places, b, a))
        a, b, places = a[order], b[order], places[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        return a[first], b[first], self.ids[self.doc[places[first]]], places, np.cumsum(new) - 1


def repeated_words(
    docs: DataFrame, window: int = 13, block: int = 7, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Remove every word that lies in ``window`` consecutive words which also stand in a document of smaller id.

    Words are runs of characters other than the six ASCII blanks. One row per input row: doc_id,
    n_words, n_removed, spans (runs of removed words, by word number) and kept (the other words joined
    by one space). A null text has no words. A null id counts as larger than all others; rows
    that share an id are documents of which none comes before the other, so they lose words to smaller
    ids only. Other columns are not read. An empty table gives an empty result.
    """
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole block at any alignment: 2 * block - 1 <= window")
    total = X.text_bytes(docs, text)
    buckets = max(8, total // (6 << 20))
    parts = X.chunked(docs, total, doc_id, text)

    def probe(got: pa.Table) -> pa.Table:
        c = _Chunk(got, window, block)
        keys, index, inverse = c.probes()
        aligned = np.zeros(len(keys), dtype=bool)
        aligned[inverse[(c.at - c.first[c.doc[c.at]]) % block == 0]] = True
        shared = np.zeros(len(keys), dtype=bool)
        of = c.doc[c.at]
        shared[inverse[of != of[index][inverse]]] = True
        cut = X.cuts(keys, buckets, 48)
        chunk = got.column("chunk")[0].as_py()
        return X.table([
            (i, chunk, 0, X.pack(keys[s:e]), X.bits(aligned[s:e]) + X.bits(shared[s:e]))
            for i, (s, e) in enumerate(zip(cut[:-1], cut[1:])) if e > s
        ])

    def mark(got: pa.Table) -> pa.Table:
        """Probes that meet a block of the index and occur in two documents."""
        rows = X.rows_of(got)
        keys = [X.unpack(r[3]) for r in rows]
        sizes = [len(k) for k in keys]
        aligned = np.concatenate([X.unbits(r[4], n) for r, n in zip(rows, sizes)])
        shared = np.concatenate([X.unbits(r[4], n, 1) for r, n in zip(rows, sizes)])
        distinct, inverse, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        index, multiple = np.zeros(len(distinct), dtype=bool), count > 1
        index[inverse[aligned]] = True
        multiple[inverse[shared]] = True
        hit = np.split((index & multiple)[inverse], np.cumsum(sizes)[:-1])
        return X.table([(r[0], r[1], 0, X.bits(h), b"") for r, h in zip(rows, hit) if h.any()])

    def extend(key, got: pa.Table, marks: pa.Table) -> pa.Table:
        if not marks.num_rows or not got.num_rows:
            return X.table([])
        chunk = key[0].as_py()
        c = _Chunk(got, window, block)
        keys, _, inverse = c.probes()
        cut, hit = X.cuts(keys, buckets, 48), np.zeros(len(keys), dtype=bool)
        for bucket, _, _, mask, _ in X.rows_of(marks):
            s, e = cut[bucket], cut[bucket + 1]
            hit[s:e] = X.unbits(mask, e - s)
        hit = hit[inverse]
        a, b, least, _, _ = c.suspects(hit)
        cut = X.cuts(a, buckets, 64)
        rows = [
            (i, chunk, 0, a[s:e].tobytes() + b[s:e].tobytes(), zlib.compress(least[s:e].tobytes(), 1))
            for i, (s, e) in enumerate(zip(cut[:-1], cut[1:])) if e > s
        ]
        # The hits come back with the answers, so that the last round needs one exchange only.
        return X.table([*rows, (chunk % buckets, chunk, 1, zlib.compress(X.bits(hit), 1), b"")])

    def confirm(got: pa.Table) -> pa.Table:
        """Windows that stand in a document of smaller id than all of the chunk that asks."""
        rows = X.rows_of(got)
        back, rows = [r for r in rows if r[2] == 1], [r for r in rows if r[2] == 0]
        if rows:
            sizes = [len(r[3]) // 12 for r in rows]
            a = np.concatenate([np.frombuffer(r[3], U, count=n) for r, n in zip(rows, sizes)])
            b = np.concatenate([np.frombuffer(r[3], np.uint32, offset=8 * n) for r, n in zip(rows, sizes)])
            least = np.concatenate([np.frombuffer(zlib.decompress(r[4]), np.int64) for r in rows])
            order = np.lexsort((least, b, a))
            x, y = a[order], b[order]
            new = np.ones(len(x), dtype=bool)
            new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            best = least[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            later = np.empty(len(x), dtype=bool)
            later[order] = least[order] > best
            parts = np.split(later, np.cumsum(sizes)[:-1])
            back += [(r[0], r[1], 0, X.bits(f), b"") for r, f in zip(rows, parts) if f.any()]
        return X.table(back)

    def remove(key, got: pa.Table, answers: pa.Table) -> pa.Table:
        c = _Chunk(got, window, block)
        gone = np.zeros(len(c.doc), dtype=bool)
        rows = X.rows_of(answers)
        hits = [r for r in rows if r[2] == 1]
        if hits and len(c.at):
            a, _, least, places, which = c.suspects(X.unbits(zlib.decompress(hits[0][3]), len(c.at)))
            cut, later = X.cuts(a, buckets, 64), np.zeros(len(a), dtype=bool)
            for bucket, _, kind, mask, _ in rows:
                if kind == 0:
                    s, e = cut[bucket], cut[bucket + 1]
                    later[s:e] = X.unbits(mask, e - s)
            out = places[later[which] | (c.ids[c.doc[places]] > least[which])]
            gone = T.covered(len(c.doc), out, out + window)
        kept, spans, lost = [], [], []
        for text, first, n in zip(c.docs.column("text").to_pylist(), c.first, c.counts):
            own = gone[first : first + n]
            every = (text or "").encode().split()
            left = [every[i] for i in np.flatnonzero(~own)] if own.any() else every
            kept.append(b" ".join(left).decode())
            spans.append(T.runs(own))
            lost.append(int(own.sum()))
        return pa.Table.from_arrays(
            [c.docs.column("doc_id"), pa.array(c.counts, pa.int64()), pa.array(lost, pa.int64()),
             T.spans_column(spans), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "spans", "kept"],
        )

    by_chunk = parts.groupBy("chunk")
    marks = by_chunk.applyInArrow(probe, X.ROWS).groupBy("bucket").applyInArrow(mark, X.ROWS)
    wider = by_chunk.cogroup(marks.groupBy("chunk")).applyInArrow(extend, X.ROWS)
    answers = wider.groupBy("bucket").applyInArrow(confirm, X.ROWS)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(remove, OUT)
