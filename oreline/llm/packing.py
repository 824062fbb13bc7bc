"""Packing of tokenized documents by configurations over the histogram of lengths.

Only the histogram, at most ``size`` numbers, reaches the driver. The program "as few sequences as possible, each a configuration of
lengths that fits, covering all pieces" is solved in fractions by multiplicative weights: a round prices the configuration of most value by
a knapsack dynamic program, adds an equal share of the sequences to it, and lowers the weight of the lengths that it covers. The sum over
the rounds covers each length in about the same proportion; it is rounded down to whole sequences, and the pieces that are left are packed best
fit, longest first, in bulk over the lengths. Where best fit alone needs fewer sequences, its plan is taken.
Pieces find their place by their rank among the pieces of their length, counted per salted part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.shared import ship, store

#: The id that ends each document (fixed value of the contract).
END = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_encoders: dict[str, object] = {}


def _encoder(path: str):
    """The tokenizer as the file has it, and the texts that it takes for one token wherever they stand."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        _encoders[path] = own, [t.content for t in own.get_added_tokens_decoder().values()]
    return _encoders[path]


def _fast_encoder(path: str):
    """The same vocabulary in the faster library, where the ranks file stands beside it, else None."""
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if ranks_path not in _encoders:
        try:
            import base64

            import tiktoken
            from public_tokenizers import PATTERN

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            _encoders[ranks_path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        except (ImportError, FileNotFoundError):
            _encoders[ranks_path] = None
    return _encoders[ranks_path]


def _ids(text: str, path: str) -> np.ndarray:
    """Token ids and the end. The faster library is used for Latin text, where both agree on what a letter is, without added tokens."""
    fast, (own, added) = _fast_encoder(path), _encoder(path)
    if fast is not None and (text.isascii() or max(text) < "ƀ") and not any(x in text for x in added):
        ids = fast.encode_ordinary(text)
    else:
        ids = own.encode(text, add_special_tokens=False).ids
    return np.array([*ids, END], dtype="<u4")


def pieces(docs: DataFrame, tokenizer: str, size: int = 1024, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Token pieces of at most ``size``: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    Only documents longer than ``size`` are cut; the first piece takes what is over, the others are full. A null text is empty.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches):
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = _ids(text or "", tokenizer)
                edges = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
                for k, (s, e) in enumerate(zip(edges[:-1], edges[1:])):
                    row = (doc, k, s, e - s, zlib.crc32(ids[s:e].tobytes()))
                    out.append((*row, ids[s:e].astype(np.int32)) if with_ids else row)
            columns = zip(*out) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return rows.mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def _price(lengths: np.ndarray, value: np.ndarray, size: int) -> dict[int, int]:
    """The configuration of most value: unbounded knapsack over the capacities up to ``size``."""
    best, choice = np.zeros(size + 1), np.full(size + 1, -1)
    fits = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for room in range(int(lengths[0]), size + 1):
        gain = best[room - lengths[: fits[room]]] + value[: fits[room]]
        k = int(gain.argmax())
        best[room], choice[room] = gain[k], k
    out: dict[int, int] = {}
    room = size
    while room > 0 and choice[room] >= 0:
        out[int(choice[room])] = out.get(int(choice[room]), 0) + 1
        room -= int(lengths[choice[room]])
    return out


Plan = list[tuple[int, dict[int, int]]]


def cover(histogram: dict[int, int], size: int = 1024, rounds: int = 400, rate: float = 4.0) -> dict[tuple, float]:
    """Configurations ((length, pieces) ascending) and how many sequences of each, in fractions; no length is covered beyond its pieces."""
    lengths = np.array(sorted(histogram))
    supply = np.array([histogram[x] for x in lengths.tolist()], dtype=float)
    covered = np.zeros(len(lengths))
    out: dict[tuple, float] = {}
    share = float(lengths @ supply) / size / rounds
    for _ in range(rounds):
        open_ = np.flatnonzero(covered < 1 - 1e-9)
        if not len(open_):
            break
        value = lengths[open_] * np.exp(-rate * (covered[open_] - covered[open_].min()) * lengths[open_] / size)
        found = {int(open_[k]): a for k, a in _price(lengths[open_], value, size).items()}
        step = min(share, *((1 - covered[k]) * supply[k] / a for k, a in found.items()))
        key = tuple((int(lengths[k]), a) for k, a in sorted(found.items()))
        out[key] = out.get(key, 0.0) + step
        for k, a in found.items():
            covered[k] += step * a / supply[k]
    return out


def best_fit(histogram: dict[int, int], size: int = 1024) -> Plan:
    """Best fit, longest first, for all pieces of a length at once: sequences with the same content are one entry.

    A sequence that has taken a piece has the least room of those that can take another, so it is filled up before the next.
    """
    # Room left: contents with that room, as (sequences, content).
    rooms: dict[int, list[tuple[int, dict[int, int]]]] = {}
    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        for room in sorted(r for r in rooms if r >= length):
            most, stays = room // length, []
            for times, content in rooms.pop(room):
                full, over = min(times, left // most), 0
                if full < times:
                    over = left - full * most if left < times * most else 0
                for number, pieces in ((full, most), (1 if over else 0, over)):
                    if number:
                        rooms.setdefault(room - pieces * length, []).append((number, content | {length: pieces}))
                left -= full * most + over
                rest = times - full - (1 if over else 0)
                if rest:
                    stays.append((rest, content))
            if stays:
                rooms[room] = stays
            if not left:
                break
        most = size // length
        for number, pieces in ((left // most, most), (1 if left % most else 0, left % most)):
            if number:
                rooms.setdefault(size - pieces * length, []).append((number, {length: pieces}))
    return [one for contents in rooms.values() for one in contents]


def sequences(plan: Plan) -> int:
    return sum(times for times, _ in plan)


def configurations(histogram: dict[int, int], size: int = 1024, rounds: int = 400) -> Plan:
    """(sequences, {length: pieces in each}) for all pieces of the histogram."""
    whole: Plan = [(int(times), dict(key)) for key, times in cover(histogram, size, rounds).items() if times >= 1]
    left = dict(histogram)
    for times, content in whole:
        for length, pieces in content.items():
            left[length] -= times * pieces
    solved = whole + best_fit(left, size)
    plain = best_fit(histogram, size)
    return solved if sequences(solved) <= sequences(plain) else plain


def _places(plan, size: int) -> dict[int, np.ndarray]:
    """For each length the ranges of ranks, ascending: first rank, first sequence, pieces in each, offset."""
    taken: dict[int, int] = {}
    out: dict[int, list[tuple]] = {}
    sequence = 0
    for times, content in plan:
        offset = 0
        for length, number in sorted(content.items(), reverse=True):
            first = taken.get(length, 0)
            out.setdefault(length, []).append((first, sequence, number, offset))
            taken[length] = first + number * times
            offset += number * length
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in out.items()}


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents with sequence_id and offset; sequences are filled from 0 without gaps.

    Null texts are empty documents (the end alone). Null and repeated ids are documents like others. Other columns are
    not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = store(pieces(docs, tokenizer, size, doc_id, text), "pieces")
    counted = cut.groupBy("length").count().collect()
    total = sum(r["count"] for r in counted)
    places = spark.sparkContext.broadcast(_places(configurations({r["length"]: r["count"] for r in counted}, size), size))
    parts = max(1, total // 100_000)
    salted = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    sizes = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("own", F.row_number().over(inside) - 1)
        .join(firsts, ["length", "part"])
        .withColumn("rank", F.col("first") + F.col("own"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    )

    def put(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                own = length == x
                rows = places.value[int(x)]
                first, base, number, at = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1].T
                sequence[own] = base + (rank[own] - first) // number
                offset[own] = at + (rank[own] - first) % number * x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(put, PIECES + ", sequence_id long, offset long")
