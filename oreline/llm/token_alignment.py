"""Alignment of two tokenizers by the byte spans of their tokens.

The character offsets of the first library and the spans that the second gives in its proto are coarse cuts: a token is placed by
them where its span has as many bytes as the token. Tokens inside a character of several bytes, and byte-fallback tokens, have the
span of the whole character or none; they are placed from the last cut by the bytes they decode to.

Both vocabularies begin a new token at a single space between two characters that are none, so a text is cut into parts there, and each distinct
part is tokenized and aligned once: groups and links of a text are those of its parts. Vocabularies for which that does not hold take texts whole.

Documents are worked on in chunks. A chunk lists each pair of ids that overlap in it once, with the number of its documents that hold it; a
document refers to that list by number, with the times it holds each. So only lists meet to be counted over the corpus, and the counts go back
to the chunk as answers by number: a pair in every document costs one row per chunk.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.shared import ship, store

#: Bytes of text in a chunk, or one longer document.
CHUNK_BYTES = 4 << 20
#: Distinct parts that a worker keeps before it starts afresh, and how many characters of new ones are tokenized at once.
PARTS, BATCH = 250_000, 1 << 14
SPACE = "▁"
#: A single space between characters that are no white space.
_BORDER = re.compile(r"(?<=\S) (?=\S)")
_NO_CODES = np.zeros(0, dtype=np.int64)
_LOCAL = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, pairs array<long>, docs array<long>"
)
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"


class Encoders:
    """Both tokenizers with the bytes of each id, and the parts of texts that were aligned before."""

    def __init__(self, path_a: str, path_b: str):
        # Spark runs a task on each core already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        # The strings of special tokens are plain text.
        self.a.encode_special_tokens = True
        byte_of = _byte_characters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, k in self.a.get_vocab().items():
            self.bytes_a[k] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in y], dtype=np.int64) for y in (self.bytes_a, self.bytes_b))
        # Each id as text before another id of its side, before the other side, and before the next group.
        self.most = max(len(self.bytes_a), len(self.bytes_b))
        self.names = [f"{k}{mark}" for mark in ",|;" for k in range(self.most)]
        how = json.loads(self.a.to_str())
        before = how["pre_tokenizer"] or {}
        words = how["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        # No piece of the second vocabulary goes on over a space.
        self.cut = _BORDER if words and not any(SPACE in p.lstrip(SPACE) for p in pieces) else None
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.parts: list[Part | None] = []

    def parts_of(self, texts: list[str]) -> list[list[int]]:
        """The numbers of the parts of each text; parts that are new are aligned."""
        if len(self.parts) > PARTS:
            self.forget()
        new: dict[str, int] = {}
        out = []
        for text in texts:
            own = []
            for part in self.cut.split(text) if self.cut else [text]:
                k = self.place.get(part)
                if k is None:
                    k = self.place[part] = len(self.place)
                    new[part] = k
                own.append(k)
            out.append(own)
        self.parts.extend([None] * len(new))
        for group in self._groups(list(new)):
            for part, found in zip(group, self._align(group)):
                self.parts[new[part]] = found
        return out

    def _groups(self, parts: list[str]):
        """Parts that can stand side by side, some at once; one with white space at an end, as the first or last of a text, alone."""
        together, size = [], 0
        for part in parts:
            if self.cut is None or not part or part[0].isspace() or part[-1].isspace():
                yield [part]
                continue
            together.append(part)
            size += len(part)
            if size >= BATCH:
                yield together
                together, size = [], 0
        if together:
            yield together

    def _align(self, parts: list[str]) -> list[Part | None]:
        """The alignment of space + part for each part, None where the tokens do not spell it. The parts are tokenized as one text."""
        text = " ".join(parts)
        whole = " " + text
        data = whole.encode()
        one, proto = self.a.encode(whole, add_special_tokens=False), self.b.encode(text, return_type="proto")
        ids_a, spans = one.ids, [(p.id, p.end) for p in proto.pieces]
        spelled = b"".join([self.bytes_a[k] for k in ids_a]) == data == b"".join([self.bytes_b[k] for k, _ in spans])
        if not spelled:
            return [None] if len(parts) == 1 else [self._align([p])[0] for p in parts]
        ids_a, ids_b = np.array(ids_a, dtype=np.int64), np.array([k for k, _ in spans], dtype=np.int64)
        cuts_a = np.array([e for _, e in one.offsets], dtype=np.int64)
        starts = [0, *itertools.accumulate(len(p) + 1 for p in parts)]
        if len(data) > len(whole):
            points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
            bytes_to = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
            cuts_a, starts = bytes_to[cuts_a], bytes_to[starts]
        ends_a = refined(cuts_a, self.size_a[ids_a])
        # The second library has not seen the space in front.
        ends_b = refined(np.array([e for _, e in spans], dtype=np.int64) + 1, self.size_b[ids_b])
        group_a, group_b, common, link_a, link_b, ends = aligned(ends_a, ends_b)
        codes = ids_a[link_a] << 32 | ids_b[link_b]
        names = group_names(self, ids_a, group_a, ids_b, group_b)
        edges = [np.searchsorted(x, starts, "right").tolist() for x in (ends_a, ends_b, common, ends)]
        out = []
        for (a, a_to), (b, b_to), (g, g_to), (k, k_to) in zip(*map(itertools.pairwise, edges)):
            out.append(Part(a_to - a, b_to - b, g_to - g, codes[k:k_to].copy(), "".join(names[a + b : a_to + b_to])[:-1]))
        return out


class Part(NamedTuple):
    """Tokens of both sides, groups, the pair of ids of each link in one number, and the ids of each group as text."""

    n_a: int
    n_b: int
    n_groups: int
    codes: np.ndarray
    groups: str


def _byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


def refined(cuts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens: the coarse cut where the span has the size of the token, else the last such cut and the sizes since."""
    sums = np.cumsum(sizes)
    good = np.diff(cuts, prepend=0) == sizes
    last = np.maximum.accumulate(np.where(good, np.arange(len(cuts)), -1))
    return np.where(last >= 0, cuts[last] + sums - sums[last], sums)


def aligned(ends_a: np.ndarray, ends_b: np.ndarray):
    """Group number of each token of both sides, the ends of the groups, for each link its token of A and of B, and the ends of the links.

    Between two ends that follow each other lies one token of each side, so every end of either side is one link.
    """
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    ends = np.union1d(ends_a, ends_b)
    return (
        np.searchsorted(common, ends_a), np.searchsorted(common, ends_b), common, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), ends,
    )


def group_names(encoders: Encoders, ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray) -> list[str]:
    """The ids in the order of ``a1,a2|b1;a3|b2,b3``, each with the mark behind it."""
    place = np.concatenate([2 * group_a, 2 * group_b + 1])
    order = np.argsort(place, kind="stable")
    place = np.append(place[order], -1)
    # 0: the same side goes on, 1: the other side of the group follows, 2: the next group.
    mark = np.where(place[1:] == place[:-1], 0, np.where(place[:-1] % 2 == 0, 1, 2))
    names = encoders.names
    return [names[k] for k in (np.concatenate([ids_a, ids_b])[order] + encoders.most * mark).tolist()]


def pack(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers as gaps, and how often each; their bytes by place, compressed."""
    both = np.concatenate([np.diff(numbers, prepend=0), times]).astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


_encoders: dict[tuple[str, str], Encoders] = {}


def encoders_of(path_a: str, path_b: str) -> Encoders:
    if (path_a, path_b) not in _encoders:
        _encoders[path_a, path_b] = Encoders(path_a, path_b)
    return _encoders[path_a, path_b]


_NAMES = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "pairs", "docs"]
_TYPES = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _chunk(number: int, ids: list, texts: list, encoders: Encoders, digest: bool) -> pa.RecordBatch:
    """The rows of one chunk: its documents, then its list of pairs."""
    parts, rows, codes, known = encoders.parts_of([t or "" for t in texts]), [], [], {}
    for i, text, own in zip(ids, texts, parts):
        # A repeated text of the chunk is put together once.
        if text not in known:
            held = [encoders.parts[k] for k in own]
            if not text or None in held:
                known[text] = (0, 0, 0, 0, ""), _NO_CODES
            else:
                code = np.concatenate([p.codes for p in held])
                groups = ";".join([p.groups for p in held])
                groups = hashlib.sha256(groups.encode()).hexdigest() if digest else groups
                known[text] = (sum(p.n_a for p in held), sum(p.n_b for p in held), sum(p.n_groups for p in held), len(code), groups), code
        row, code = known[text]
        rows.append((number, i, *row))
        codes.append(code)
    pairs, place = np.unique(np.concatenate(codes), return_inverse=True)
    # Document and pair in one number, so that one pass counts all documents.
    owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    held, times = np.unique(owner * len(pairs) + place, return_counts=True)
    owner, held = held // max(1, len(pairs)), held % max(1, len(pairs))
    edges = np.searchsorted(owner, np.arange(len(codes) + 1))
    out = [(*row, pack(held[s:e], times[s:e]), None, None) for row, s, e in zip(rows, edges[:-1], edges[1:])]
    out.append((number, *[None] * 7, pairs, np.bincount(held, minlength=len(pairs))))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)


def align(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Align the tokens of a byte-level vocabulary (A) on space + text with those of a sentencepiece model (B) on the text.

    One row per input row: doc_id, n_a, n_b (tokens), n_groups (cut where both have a token's end), n_links (pairs of tokens that
    overlap), n_best (links whose pair of ids stands in as many documents as any pair with its A id), count_sum (over the links, in how many
    documents their pair is linked), groups (the ids of each group as text; with ``digest`` its SHA-256, empty without tokens).

    A text that is null, empty or not spelled by either's tokens has none: zeros and an empty text. Null and repeated ids are rows like others; ties all
    count as best. Other columns are not read. An empty table gives an empty result. The paths are those of the vocabulary files on every worker.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def cut(batches):
        encoders, number = encoders_of(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                own = t.as_py()
                ids.append(i)
                texts.append(own)
                size += len(own or "")
                if size >= CHUNK_BYTES:
                    yield _chunk(number, ids, texts, encoders, digest)
                    ids, texts, size, number = [], [], 0, number + 1
            if ids:
                yield _chunk(number, ids, texts, encoders, digest)
                number += 1

    local = store(rows.mapInArrow(cut, _LOCAL), "alignment")
    lists = local.where("pairs is not null").select("chunk", "pairs", "docs")
    counts = (
        lists.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n"))
        .withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.shiftright("pair", 32))))
    )
    answers = lists.select(F.col("chunk").alias("asker"), F.posexplode("pairs").alias("place", "pair")).join(counts, "pair").drop("pair")

    def sum_up(own: pa.Table, found: pa.Table) -> pa.Table:
        place = found.column("place").to_numpy()
        n, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
        n[place], best[place] = found.column("n").to_numpy(), found.column("best").to_numpy()
        sums = []
        for data in own.column("links").to_pylist():
            held, times = unpack(data)
            sums.append((int(times @ best[held]), int(times @ n[held])))
        columns = list(zip(*sums)) if sums else [(), ()]
        out = own.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array(columns[0], pa.int64())).append_column("count_sum", pa.array(columns[1], pa.int64()))
        return out.append_column("groups", own.column("groups"))

    own = local.where("pairs is null").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links")
    return own.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(sum_up, f"{OUT}, groups string")
