"""Vectorised work on the bytes of a batch of texts: words, rolling hashes, sliding minima."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RANDOM = np.random.default_rng(20240701)
#: A random number for each byte, the digits of the polynomial hashes.
DIGIT = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 2**64)
U = np.uint64
SLICE = 1 << 20

#: The six ASCII blanks, byte by byte; bytes of longer UTF-8 characters are never blanks.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1024), base, dtype=U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 4 * SLICE:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes without a blank; runs end with their row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~BLANK[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = offsets[offsets < len(data)]
    begin[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[offsets > 0] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are ordered and apart. Works through slices of bounded size."""
    out = np.empty(len(starts), dtype=U)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, side="right")))
        low, high = int(starts[at]), int(ends[to - 1])
        sums = np.zeros(high - low + 1, dtype=U)
        np.cumsum(DIGIT[data[low:high]] * powers(BASE, high - low), out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((sums[e] - sums[s]) * powers(UNBASE, high - low)[s] + (e - s).astype(U))
        at = to
    return out


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes that start at each place."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    out = np.empty(n, dtype=U)
    for low in range(0, n, SLICE):
        part = data[low : min(low + SLICE + k - 1, len(data))]
        sums = np.zeros(len(part) + 1, dtype=U)
        np.cumsum(DIGIT[part] * powers(BASE, len(part)), out=sums[1:])
        m = len(part) - k + 1
        out[low : low + m] = mix((sums[k:] - sums[:-k]) * powers(UNBASE, m))
    return out


def windows(hashes: np.ndarray, k: int, salt: int) -> np.ndarray:
    """A hash of each k consecutive numbers."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, salt, dtype=U)
    for i in range(k):
        out *= U(0xD6E8FEB86659FD93)
        out += hashes[i : i + n]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w consecutive numbers."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1 : w - 1 + n])


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(steps[:n]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    starts = np.flatnonzero(edge == 1)
    return starts, np.flatnonzero(edge == -1) - starts


def spans_column(rows: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """A list of {start, length} for each row."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(s) for s, _ in rows], out=offsets[1:])
    cat = [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0) for i in (0, 1)]
    struct = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in cat], names=["start", "length"])
    return pa.ListArray.from_arrays(pa.array(offsets), struct)
