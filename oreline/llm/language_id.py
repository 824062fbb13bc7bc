"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point. A trigram binds three letter vectors, the first
rotated by two places and the second by one; a text bundles its trigrams. The prototype of a language bundles its texts, scaled
to equal norms, and a text is given the language whose prototype has the largest cosine with it. Both are linear in the trigrams, so a
trigram is bound once for a group of texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.shared import ship

WIDTH = 1024
_SPACE = 32
_letters: dict[int, np.ndarray] = {}
_GROUP, _TRIGRAMS = 512, 4096
#: A text weighs UNIT over its norm in a prototype, as a whole number, so that sums do not depend on their order.
_UNIT = 2**20
_alphabet: list[np.ndarray] = []


def _letter(code: int) -> np.ndarray:
    if len(_letters) > 20_000:
        _letters.clear()
    if code not in _letters:
        _letters[code] = np.random.default_rng([7, code]).integers(0, 2, WIDTH).astype(np.float32) * 2 - 1
    return _letters[code]


class _Group:
    """The trigrams of some texts: letters in lower case, words apart by one space."""

    def __init__(self, texts: list[str | None]):
        if not _alphabet:
            _alphabet.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
        parts = [np.frombuffer(f" {(x or '').lower()} ".encode("utf-32-le", "replace"), np.uint32) for x in texts]
        codes = np.concatenate(parts)
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
        codes = np.where(_alphabet[0][codes], codes, _SPACE)
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE) | (doc[1:] != doc[:-1])
        codes, doc = codes[keep], doc[keep]
        kinds = np.flatnonzero(np.bincount(codes))
        index = np.zeros(int(kinds[-1]) + 1, dtype=np.int64)
        index[kinds] = np.arange(len(kinds))
        x, n = index[codes], len(kinds)
        inside = doc[2:] == doc[:-2]
        grams, self.doc = ((x[:-2] * n + x[1:-1]) * n + x[2:])[inside], doc[:-2][inside]
        if n**3 <= 1 << 22:
            every = np.flatnonzero(np.bincount(grams, minlength=1))
            place = np.zeros(n**3, dtype=np.int64)
            place[every] = np.arange(len(every))
            self.gram = place[grams]
        else:
            every, self.gram = np.unique(grams, return_inverse=True)
        self.letters = kinds[np.stack([every // (n * n), every // n % n, every % n])]
        self.size = len(texts)
        #: Texts with a letter.
        self.letter = np.bincount(doc, codes != _SPACE, minlength=len(texts)) > 0
        self.edges = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        # Bound vectors of different trigrams are all but orthogonal: the norm of a bundle is that of its counts.
        self.norm = np.array([
            np.sqrt((np.bincount(self.gram[s:e]).astype(np.float64) ** 2).sum()) if e > s else 0
            for s, e in zip(self.edges[:-1], self.edges[1:])
        ])

    def bound(self):
        """Slices of the distinct trigrams with their vectors."""
        for s in range(0, self.letters.shape[1], _TRIGRAMS):
            part = self.letters[:, s : s + _TRIGRAMS]
            out = np.ones((part.shape[1], WIDTH), dtype=np.float32)
            for codes, turn in zip(part, (2, 1, 0)):
                kinds, of = np.unique(codes, return_inverse=True)
                out *= np.stack([np.roll(_letter(int(k)), turn) for k in kinds])[of]
            yield slice(s, s + part.shape[1]), out

    def bundle(self, chosen: np.ndarray) -> np.ndarray:
        """The sum of the chosen texts, each by its weight."""
        weight = np.where(chosen & (self.norm > 0), np.rint(_UNIT / np.where(self.norm > 0, self.norm, 1)), 0)
        amount = np.bincount(self.gram, weight[self.doc], minlength=self.letters.shape[1])
        out = np.zeros(WIDTH)
        for part, vectors in self.bound():
            out += amount[part] @ vectors.astype(np.float64)
        return out.astype(np.int64)

    def cosines(self, prototypes: np.ndarray) -> np.ndarray:
        """Texts by languages; 0 for a text without a letter."""
        likeness = np.zeros((self.letters.shape[1], len(prototypes)))
        for part, vectors in self.bound():
            likeness[part] = vectors @ prototypes.T.astype(np.float32)
        out = np.zeros((self.size, len(prototypes)))
        for k in range(len(prototypes)):
            sums = np.concatenate([[0], np.cumsum(likeness[self.gram, k])])
            out[:, k] = sums[self.edges[1:]] - sums[self.edges[:-1]]
        return out / np.where(self.norm > 0, self.norm * np.sqrt(WIDTH), 1)[:, None]


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes: a row of WIDTH numbers for each label, which is all that is collected.

    Rows with a null label or without a letter teach nothing.
    """
    ship(labelled.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("place", pa.int32()), ("amount", pa.int64())])

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names, texts = np.array(batch.column("lang").to_pylist(), dtype=object), batch.column("text").to_pylist()
            for low in range(0, len(texts), _GROUP):
                group = _Group(texts[low : low + _GROUP])
                for name in set(names[low : low + _GROUP]):
                    sums[name] = sums.get(name, 0) + group.bundle(names[low : low + _GROUP] == name)
        for name, x in sums.items():
            if x.any():
                yield pa.RecordBatch.from_arrays([pa.array([name] * WIDTH), pa.array(range(WIDTH), pa.int32()), pa.array(x)], schema=schema)

    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang is not null and text is not null")
    sums = (
        rows.mapInArrow(bundle, "lang string, place int, amount long")
        .groupBy("lang", "place").agg(F.sum("amount").alias("amount"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "amount"))).alias("profile"))
    )
    found = sorted((r.lang, [p.amount for p in r.profile]) for r in sums.collect())
    return [x for x, _ in found], _unit(np.array([p for _, p in found], dtype=np.float64).reshape(-1, WIDTH))


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (the cosine, 0 if it is negative).

    ``und`` and 0 for a null text, one without a letter, or when no language was learned. Of equal cosines the first
    language by name wins. Null and repeated ids are kept as they are. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast((list(languages), np.asarray(prototypes)))

    def apply(batches):
        names, profile = model.value
        for batch in batches:
            texts, langs, scores = batch.column("text").to_pylist(), [], []
            for low in range(0, len(texts), _GROUP):
                group = _Group(texts[low : low + _GROUP])
                if names:
                    cosine = group.cosines(profile)
                    best = cosine.argmax(axis=1)
                    has = group.letter
                    langs += [names[k] if ok else "und" for k, ok in zip(best, has)]
                    scores += np.where(has, np.clip(cosine.max(axis=1), 0, 1), 0).tolist()
                else:
                    langs += ["und"] * group.size
                    scores += [0.0] * group.size
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(apply, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """The fold that is never learned from; documents without an id are in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the texts outside the held-out fold that have a language and predict all: doc_id, held_out, lang_pred, score."""
    names, prototypes = learn(docs.where(~held_out()))
    return predict(docs, names, prototypes).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
