"""Repeated byte strings by common-prefix intervals of enhanced suffix arrays.

A suffix array over all texts does not fit one task, so the suffixes are dealt by their first bytes.
To need few of them, each ``length``-byte string is represented by its anchor: the ``PREFIX`` bytes inside
it with the smallest hash, leftmost first. Equal strings have equal anchors at equal places, so
anchors that occur once (counted in a first exchange) need no more work. The suffixes that start
at the others meet by anchor, with the bytes of all strings that the anchor stands for. There each task sorts
them, takes the common prefixes of neighbours, and scans the intervals of the array with a stack.
Within an interval the members are split by what stands to their left, until extending a group to
the left would make its members differ: these are the maximal repeats, with all their occurrences.

An anchor with more than ``HOT`` occurrences is not gathered: its strings are compared by 64-bit hashes, each once
per chunk, in the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from oreline.llm import exchange as X
from oreline.llm import textops as T

U = np.uint64
PREFIX = 64
HOT = 4096
OUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,length:long>>, kept binary"
BLOCK = 1 << 22


class _Chunk:
    """The anchors of a chunk: place, first and last string (by its start) that each stands for."""

    def __init__(self, got: pa.Table, length: int, buckets: int):
        self.docs = X.in_order(got)
        self.data, self.offsets = T.flat(self.docs.column("text"))
        self.length = length
        place, first, last = [], [], []
        w, data = length - PREFIX + 1, self.data
        ends = np.repeat(self.offsets[1:], np.diff(self.offsets))
        for low in range(0, max(0, len(data) - length + 1), BLOCK):
            part = data[low : low + BLOCK + length - 1]
            h = T.rolling(part, PREFIX)
            least = T.sliding_min((h >> U(24) << U(24)) | np.arange(len(h), dtype=U), w)
            q = np.arange(len(least)) + low
            fits = q + length <= ends[low : low + len(q)]
            q, p = q[fits], (least[fits] & U(2**24 - 1)).astype(np.int64) + low
            if len(q):
                new = np.ones(len(q), dtype=bool)
                new[1:] = (p[1:] != p[:-1]) | (q[1:] != q[:-1] + 1)
                begin = np.flatnonzero(new)
                place.append(p[begin])
                first.append(q[begin])
                last.append(q[np.append(begin[1:], len(q)) - 1])
        none = [np.zeros(0, np.int64)]
        self.place, self.first, self.last = (np.concatenate(x or none) for x in (place, first, last))
        keys = np.empty(len(self.place), dtype=U)
        for low in range(0, max(0, len(data) - PREFIX + 1), BLOCK):
            s, e = np.searchsorted(self.place, [low, low + BLOCK])
            if e > s:
                h = T.rolling(data[low : low + BLOCK + PREFIX - 1], PREFIX)
                keys[s:e] = T.mix(h[self.place[s:e] - low]) >> U(16)
        self.keys, self.which, self.count = np.unique(keys, return_inverse=True, return_counts=True)
        self.cut = X.cuts(self.keys, buckets, 48)
        self.buckets = buckets

    def marked(self, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Anchors to compare by their bytes, and by hashes."""
        flags = np.zeros((2, len(self.keys)), dtype=bool)
        for bucket, _, kind, mask, _ in rows:
            if kind == 0:
                s, e = self.cut[bucket], self.cut[bucket + 1]
                flags[0, s:e], flags[1, s:e] = X.unbits(mask, e - s), X.unbits(mask, e - s, 1)
        return flags[0][self.which], flags[1][self.which]

    def contexts(self, chosen: np.ndarray):
        """The distinct (bytes left of the anchor, bytes) by bucket; the entry of each chosen anchor."""
        data, entries, of, twice = self.data.tobytes(), {}, [], []
        bucket = np.searchsorted(self.cut, self.which[chosen], side="right") - 1
        for p, q, r, i in zip(self.place[chosen], self.first[chosen], self.last[chosen], bucket):
            own = (int(i), int(p - q), data[q : r + self.length])
            k = entries.setdefault(own, len(entries))
            if k == len(twice):
                twice.append(False)
            else:
                twice[k] = True
            of.append(k)
        return list(entries), np.array(twice, dtype=bool), np.array(of, dtype=np.int64)

    def strings(self, hot: np.ndarray):
        """Starts of the strings of hot anchors, their distinct hashes, and the hash of each."""
        starts = np.concatenate(
            [np.zeros(0, np.int64), *(np.arange(q, r + 1) for q, r in zip(self.first[hot], self.last[hot]))]
        )
        keys = np.empty(len(starts), dtype=U)
        for low in range(0, max(0, len(self.data) - self.length + 1), BLOCK):
            s, e = np.searchsorted(starts, [low, low + BLOCK])
            if e > s:
                keys[s:e] = T.rolling(self.data[low : low + BLOCK + self.length - 1], self.length)[starts[s:e] - low]
        return starts, *np.unique(keys, return_inverse=True, return_counts=True)


def _common(rows: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the padded rows i and j."""
    out = np.empty(len(i), dtype=np.int64)
    for s in range(0, len(i), 50_000):
        a, b = i[s : s + 50_000], j[s : s + 50_000]
        differ = np.ones((len(a), rows.shape[1] + 1), dtype=bool)
        differ[:, :-1] = rows[a] != rows[b]
        out[s : s + 50_000] = np.minimum(differ.argmax(axis=1), np.minimum(sizes[a], sizes[b]))
    return out


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    width = max(1, int(sizes.max(initial=0)))
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in texts), np.uint8).reshape(len(texts), width), sizes


def maximal_repeats(entries: list[tuple[int, bytes]], length: int):
    """(common bytes left, common bytes right, members) of every maximal repeat of at least ``length`` bytes
    around the anchors of the entries (bytes left of the anchor, bytes); entries are distinct."""
    order = sorted(range(len(entries)), key=lambda k: entries[k][1][entries[k][0] :])
    rights, right_sizes = _padded([entries[k][1][entries[k][0] :] for k in order])
    turned = [entries[k][1][: entries[k][0]][::-1] for k in order]
    lefts, left_sizes = _padded(turned)
    n = len(order)
    common = _common(rights, right_sizes, np.arange(n - 1), np.arange(1, n)).tolist()
    pairs: list[tuple[int, int, int]] = []

    def split(members: list[int], deep: int):
        """Members of an interval, grouped while what stands left of them is equal far enough."""
        members = sorted(members, key=turned.__getitem__)
        m = np.array(members)
        same = _common(lefts, left_sizes, m[:-1], m[1:])
        for s, size in zip(*T.runs(same >= length - deep)):
            group = m[s : s + size + 1]
            side = np.concatenate([[0], same[s : s + size], [0]])
            yield np.maximum(side[:-1], side[1:]), deep, [order[k] for k in group]

    stack: list[tuple[int, int]] = []
    for i in range(1, n + 1):
        now, low = (common[i - 1] if i < n else 0), i - 1
        while stack and stack[-1][0] > now:
            deep, low = stack.pop()
            if i - low == 2:
                pairs.append((low, low + 1, deep))
            else:
                yield from split(list(range(low, i)), deep)
        if now >= PREFIX and (not stack or stack[-1][0] < now):
            stack.append((now, low))
    if pairs:
        i, j, deep = (np.array(x) for x in zip(*pairs))
        same = _common(lefts, left_sizes, i, j)
        for k in np.flatnonzero(same + deep >= length):
            yield np.array([same[k]] * 2), int(deep[k]), [order[i[k]], order[j[k]]]


def repeated_bytes(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every byte that lies in ``length`` bytes of UTF-8 which also start anywhere else, in the same
    document or another; overlapping occurrences count.

    One row per input row: doc_id, n_bytes, n_removed, spans (maximal runs of removed bytes) and kept (the
    other bytes, which may not be UTF-8 any more). A null text is empty. A null id and repeated ids
    are documents like any others. Other columns are not read. An empty table gives an empty result.
    """
    if length < PREFIX + 1:
        raise ValueError(f"length must be more than {PREFIX}")
    total = X.text_bytes(docs, text)
    buckets = max(8, total // (12 << 20))
    parts = X.chunked(docs, total, doc_id, text)

    def count(got: pa.Table) -> pa.Table:
        c, chunk = _Chunk(got, length, buckets), got.column("chunk")[0].as_py()
        number = np.minimum(c.count, 65535).astype(np.uint16)
        return X.table([
            (i, chunk, 0, X.pack(c.keys[s:e]), number[s:e].tobytes())
            for i, (s, e) in enumerate(zip(c.cut[:-1], c.cut[1:])) if e > s
        ])

    def mark(got: pa.Table) -> pa.Table:
        rows = X.rows_of(got)
        keys = [X.unpack(r[3]) for r in rows]
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.bincount(inverse, np.concatenate([np.frombuffer(r[4], np.uint16) for r in rows]))[inverse]
        times = np.split(times, np.cumsum([len(k) for k in keys])[:-1])
        return X.table([
            (r[0], r[1], 0, X.bits((t > 1) & (t <= HOT)) + X.bits(t > HOT), b"")
            for r, t in zip(rows, times) if (t > 1).any()
        ])

    def gather(key, got: pa.Table, marks: pa.Table) -> pa.Table:
        if not marks.num_rows or not got.num_rows:
            return X.table([])
        c, chunk, rows = _Chunk(got, length, buckets), key[0].as_py(), X.rows_of(marks)
        bytewise, hot = c.marked(rows)
        entries, twice, _ = c.contexts(bytewise)
        lists: dict[int, list[int]] = {}
        for k, (bucket, _, _) in enumerate(entries):
            lists.setdefault(bucket, []).append(k)
        out = []
        for bucket, own in lists.items():
            sizes = np.array([[entries[k][1], len(entries[k][2])] for k in own], dtype=np.uint16)
            out.append((bucket, chunk, 1, b"".join(entries[k][2] for k in own), sizes.tobytes() + X.bits(twice[own])))
        _, keys, _, number = c.strings(hot)
        cut = X.cuts(keys, buckets, 64)
        out += [
            (i, chunk, 2, keys[s:e].tobytes(), X.bits(number[s:e] > 1))
            for i, (s, e) in enumerate(zip(cut[:-1], cut[1:])) if e > s
        ]
        # The marks come back with the answers, so that the last round needs one exchange only.
        return X.table(out + rows)

    def compare(got: pa.Table) -> pa.Table:
        rows = X.rows_of(got)
        out = [r for r in rows if r[2] == 0]
        known: dict[tuple[int, bytes], int] = {}
        twice, of = [], []
        asked = [r for r in rows if r[2] == 1]
        for _, _, _, data, rest in asked:
            n = (len(rest) * 8) // 33
            while 4 * n + -(-n // 8) < len(rest):
                n += 1
            sizes, own, at = np.frombuffer(rest, np.uint16, count=2 * n).reshape(n, 2).tolist(), [], 0
            for (left, size), more in zip(sizes, X.unbits(rest[4 * n :], n)):
                k = known.setdefault((left, data[at : at + size]), len(known))
                at += size
                if k == len(twice):
                    twice.append(bool(more))
                else:
                    twice[k] = True
                own.append(k)
            of.append(own)
        if known:
            entries = list(known)
            reach = np.zeros((len(entries), 2), dtype=np.uint16)
            for left, right, members in maximal_repeats(entries, length):
                reach[members, 0] = np.maximum(reach[members, 0], left)
                reach[members, 1] = np.maximum(reach[members, 1], right)
            whole = np.array([(left, len(data) - left) for left, data in entries], dtype=np.uint16)
            reach[twice] = whole[twice]
            out += [(r[0], r[1], 1, reach[own].tobytes(), b"") for r, own in zip(asked, of) if reach[own].any()]
        asked = [r for r in rows if r[2] == 2]
        if asked:
            keys = [np.frombuffer(r[3], U) for r in asked]
            _, inverse, number = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            more = np.concatenate([X.unbits(r[4], len(k)) for r, k in zip(asked, keys)])
            found = np.split((number > 1)[inverse] | more, np.cumsum([len(k) for k in keys])[:-1])
            out += [(r[0], r[1], 2, X.bits(f), b"") for r, f in zip(asked, found) if f.any()]
        return X.table(out)

    def remove(key, got: pa.Table, answers: pa.Table) -> pa.Table:
        c, rows = _Chunk(got, length, buckets), X.rows_of(answers)
        gone = np.zeros(len(c.data), dtype=bool)
        if rows:
            bytewise, hot = c.marked(rows)
            entries, _, of = c.contexts(bytewise)
            at = np.array([e[0] for e in entries], dtype=np.int64)
            reach = np.zeros((len(entries), 2), dtype=np.int64)
            starts, keys, which, _ = c.strings(hot)
            cut, found = X.cuts(keys, buckets, 64), np.zeros(len(keys), dtype=bool)
            for bucket, _, kind, data, _ in rows:
                if kind == 1:
                    reach[np.flatnonzero(at == bucket)] = np.frombuffer(data, np.uint16).reshape(-1, 2)
                elif kind == 2:
                    s, e = cut[bucket], cut[bucket + 1]
                    found[s:e] = X.unbits(data, e - s)
            begin, end = [], []
            if len(of):
                has = reach[of, 1] > 0
                place = c.place[bytewise][has]
                begin.append(place - reach[of, 0][has])
                end.append(place + reach[of, 1][has])
            if len(starts):
                begin.append(starts[found[which]])
                end.append(starts[found[which]] + length)
            if begin:
                gone = T.covered(len(c.data), np.concatenate(begin), np.concatenate(end))
        kept, spans, lost = [], [], []
        for s, e in zip(c.offsets[:-1], c.offsets[1:]):
            own = gone[s:e]
            kept.append(c.data[s:e][~own].tobytes())
            spans.append(T.runs(own))
            lost.append(int(own.sum()))
        return pa.Table.from_arrays(
            [c.docs.column("doc_id"), pa.array(np.diff(c.offsets), pa.int64()), pa.array(lost, pa.int64()),
             T.spans_column(spans), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )

    by_chunk = parts.groupBy("chunk")
    marks = by_chunk.applyInArrow(count, X.ROWS).groupBy("bucket").applyInArrow(mark, X.ROWS)
    wider = by_chunk.cogroup(marks.groupBy("chunk")).applyInArrow(gather, X.ROWS)
    answers = wider.groupBy("bucket").applyInArrow(compare, X.ROWS)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(remove, OUT)
