"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all ordered thresholds. Features are the
words and beginnings of words that separate graded texts best, weighted by 1 + log(count).

The model learns from at most ``SAMPLE`` labelled documents. Their ids are chosen from the labels alone, by the smallest hash; only their
texts are read. How many documents hold a word is counted by Spark; one task fits the weights on the sparse rows of the chosen words. All documents
are scored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.shared import ship, store

#: Bounds of what the model learns from and of its size.
SAMPLE = 20_000
FEATURES = 2048
#: Texts that a task works on at once.
ROWS = 256
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    words: list[str]
    weights: np.ndarray
    #: Ascending, one less than there are grades.
    thresholds: np.ndarray


def _counts(text: str | None) -> Counter:
    """Words, and the first four and five letters of longer words."""
    own = Counter(_WORD.findall((text or "").lower()))
    for word, n in list(own.items()):
        for size in (4, 5):
            if len(word) > size:
                own[f"{word[:size]}-"] += n
    return own


def _matrix(texts: list[str | None], index: dict[str, int]):
    """Sparse rows: row, column and value of each entry. The words of one text are held at a time."""
    row, column, value = [], [], []
    for k, text in enumerate(texts):
        found = sorted((index[word], n) for word, n in _counts(text).items() if word in index)
        row.extend([k] * len(found))
        column.extend(c for c, _ in found)
        value.extend(n for _, n in found)
    return np.array(row, dtype=np.int64), np.array(column, dtype=np.int64), 1 + np.log(np.array(value, dtype=float))


def _slices(batches):
    """Batches of at most ``ROWS`` rows, which bounds what is made of their texts at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(x / 2))


def loss(parameters: np.ndarray, row, column, value, y: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Weighted negative log likelihood with a penalty on the squared weights, and its gradient.

    ``parameters`` are the weights, the first threshold and the logarithms of the gaps to the next ones, which stay ordered so.
    """
    top = int(y.max(initial=0))
    n = len(parameters) - top
    w, free = parameters[:n], parameters[n:]
    cut = _ordered(free)
    z = np.bincount(row, value * w[column], minlength=len(y))
    edges = np.concatenate([np.full((len(y), 1), -np.inf), cut[None, :] - z[:, None], np.full((len(y), 1), np.inf)], axis=1)
    above, below = edges[np.arange(len(y)), y + 1], edges[np.arange(len(y)), y]
    fa, fb = _sigmoid(above), _sigmoid(below)
    p = np.maximum(fa - fb, 1e-12)
    da, db = fa * (1 - fa) / p * weight, fb * (1 - fb) / p * weight
    g_cut = np.zeros(top)
    np.add.at(g_cut, y[y < top], -da[y < top])
    np.add.at(g_cut, y[y > 0] - 1, db[y > 0])
    g_w = np.bincount(column, (da - db)[row] * value, minlength=n) + penalty * w
    g_free = np.concatenate([[g_cut.sum()], np.exp(free[1:]) * np.cumsum(g_cut[::-1])[::-1][1:]])
    return float(-(weight * np.log(p)).sum() + penalty / 2 * (w @ w)), np.concatenate([g_w, g_free])


def fit_rows(n: int, row, column, value, y: np.ndarray, penalty: float = 1e-5, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Weights of n features and the thresholds, by gradient steps with momentum from the shares of the grades."""
    top = int(y.max(initial=0))
    if not top:
        return np.zeros(n), np.zeros(0)
    share = np.array([(np.sum(y <= k) + 1) / (len(y) + 2) for k in range(top)])
    start = np.log(share / (1 - share))
    parameters = np.concatenate([np.zeros(n), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    # Graded texts are few; they weigh as the root of their rarity.
    weight = np.where(y > 0, (np.sum(y == 0) / np.sum(y > 0)) ** 0.5 if np.any(y == 0) else 1.0, 1.0)
    weight = weight / weight.sum()
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, (steps if n else 0) + 1):
        _, g = loss(parameters, row, column, value, y, weight, penalty)
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        parameters = parameters - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return parameters[:n], _ordered(parameters[n:])


def _ordered(free: np.ndarray) -> np.ndarray:
    return np.concatenate([free[:1], free[:1] + np.cumsum(np.exp(free[1:]))]) if len(free) else free


def severity(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and the probability of any grade above 0."""
    row, column, value = _matrix(texts, {w: k for k, w in enumerate(model.words)})
    z = np.bincount(row, value * model.weights[column], minlength=len(texts))
    if not len(model.thresholds):
        return np.zeros(len(texts)), np.zeros(len(texts))
    over = 1 - _sigmoid(model.thresholds[None, :] - z[:, None])
    return over.sum(axis=1), over[:, 0]


def chosen(labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", grade: str = "grade") -> DataFrame:
    """The at most ``sample`` labelled ids of the smallest hash: key, grade, h. An id with several grades has the highest."""
    graded = labels.where(F.col(grade).isNotNull() & F.col(key).isNotNull())
    one = graded.groupBy(F.col(key).alias("key")).agg(F.max(F.col(grade).cast("int")).alias("grade"))
    return one.withColumn("h", F.xxhash64("key", F.lit(5))).orderBy("h", "key").limit(sample)


def _sign(text: str) -> int:
    """The least hash of the word triples of a text; near copies share it."""
    run = _WORD.findall(text.lower())
    least = min(xxhash.xxh3_64_intdigest(" ".join(run[k : k + 3])) for k in range(max(1, len(run) - 2)))
    return least - (1 << 63)


def _telling(texts: DataFrame, features: int) -> list[str]:
    """The words whose share of graded texts is not chance, the clearest first.

    Near copies count once, or the odd words of a copied text would seem to tell. The bound is Chernoff's, for all words together below one in a hundred.
    """

    def read(batches):
        for batch in _slices(batches):
            held = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("h"), pa.array([g > 0 for g in batch.column("grade").to_pylist()]), pa.array([_sign(t) for t in held], pa.int64()),
                    pa.array([sorted(_counts(t)) for t in held], pa.list_(pa.string())),
                ],
                names=["h", "graded", "sign", "words"],
            )

    read_rows = store(texts.select("h", "grade", "text").mapInArrow(read, "h long, graded boolean, sign long, words array<string>"), "toxicity-words")
    first = read_rows.groupBy("sign").agg(F.min("h").alias("h")).select("h")
    once = read_rows.join(first, "h", "left_semi")
    n1, n0 = (int(x or 0) for x in once.agg(F.count_if("graded"), F.count_if(~F.col("graded"))).first())
    if not n1 or not n0:
        return []
    per_word = once.select("graded", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if("graded").cast("double").alias("a"), F.count_if(~F.col("graded")).cast("double").alias("b")
    )
    per_word = store(per_word, "toxicity-counts")
    share = n1 / (n1 + n0)
    part = lambda c, s: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / ((F.col("a") + F.col("b")) * F.lit(s)))).otherwise(F.lit(0.0))
    scored = per_word.withColumn("score", part("a", share) + part("b", 1 - share))
    enough = float(np.log(100 * max(1, per_word.count())))
    best = scored.where(F.col("score") >= enough).orderBy(F.desc("score"), "word").limit(features)
    return [r.word for r in best.select("word").collect()]


def fit(docs: DataFrame, labels: DataFrame | None = None, text: str = "text", grade: str = "grade", key: str = "doc_id", sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """Fit on the documents of at most ``sample`` labelled ids, chosen by a hash of the id.

    ``labels`` holds key and grade; without it ``docs`` does. Rows whose key or grade is null teach nothing. Of an id with several texts the least
    is taken, of one with several grades the highest. At most ``features`` words reach the driver. Other columns are not read. Without labels of both
    kinds there are no words, and without rows no thresholds.
    """
    spark = docs.sparkSession
    ship(spark)
    ids = chosen(docs if labels is None else labels, sample, key, grade)
    # At most ``sample`` rows of three numbers.
    held = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), "key")
    texts = store(held.groupBy("key", "grade", "h").agg(F.min("text").alias("text")), "toxicity-texts")
    words = _telling(texts, features)
    index = spark.sparkContext.broadcast({w: k for k, w in enumerate(words)})

    def sparse(batches):
        for batch in _slices(batches):
            rows = []
            for own in (_counts(t) for t in batch.column("text").to_pylist()):
                found = sorted((index.value[w], n) for w, n in own.items() if w in index.value)
                rows.append(([k for k, _ in found], [n for _, n in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("grade"), *(pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in (0, 1))],
                names=["h", "grade", "places", "counts"],
            )

    def train(got: pa.Table) -> pa.Table:
        got = got.sort_by("h")
        y = got.column("grade").to_numpy().astype(np.int64)
        places, counts = (got.column(c).combine_chunks() for c in ("places", "counts"))
        row = np.repeat(np.arange(len(y)), np.diff(places.offsets.to_numpy()))
        value = 1 + np.log(counts.flatten().to_numpy())
        weights, thresholds = fit_rows(len(words), row, places.flatten().to_numpy(), value, y)
        return pa.table({"weights": pa.array([weights.tolist()], pa.list_(pa.float64())), "thresholds": pa.array([thresholds.tolist()], pa.list_(pa.float64()))})

    rows = texts.select("h", "grade", "text").mapInArrow(sparse, "h long, grade int, places array<int>, counts array<int>")
    fitted = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, "weights array<double>, thresholds array<double>").first()
    index.unpersist()
    if fitted is None:
        return Model([], np.zeros(0), np.zeros(0))
    return Model(words, np.array(fitted.weights), np.array(fitted.thresholds))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, expected_severity and p_toxic of every row; a null or empty text has no word that counts.

    Null and repeated ids are kept as they are. Other columns are not read. An empty table gives an empty result. A model fitted
    without labels gives 0.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def apply(batches):
        for batch in _slices(batches):
            expected, toxic = severity(batch.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(expected, pa.float64()), pa.array(toxic, pa.float64())],
                names=["doc_id", "expected_severity", "p_toxic"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(apply, "doc_id long, expected_severity double, p_toxic double")
