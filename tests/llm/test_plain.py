"""The pipeline stage by stage, and the registered queries without SQL, against plain Python."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

import corpus_pipeline
from oreline.llm import toxicity
from oreline.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
BLANKS = re.compile("[\x20\x09-\x0d]+")
MASK = 2**64 - 1


def words(text):
    return [w for w in BLANKS.split(text or "") if w]


def hashed(*parts):
    """The chained 64-bit hash of texts; a null text leaves the seed."""
    seed = 42
    for part in parts:
        seed = seed if part is None else xxhash.xxh64_intdigest(part.encode(), seed)
    return seed


def quality(docs, trusted):
    """(score, kept) of each (id, text): the mean logarithm of the ratio of shares, of words and pairs in 2 ** 18 buckets, by the other three folds."""
    grams, folds = [], []
    for _, text in docs:
        w = words(text)
        grams.append([hashed(x) % 2**18 for x in w] + [hashed(x, y) % 2**18 for x, y in zip(w, w[1:])])
        folds.append(hashed(text) % 4)
    out = []
    tables = []
    for fold in range(4):
        target, raw = Counter(), Counter()
        for (i, _), own, f in zip(docs, grams, folds):
            if f != fold:
                raw.update(own)
                if i in trusted:
                    target.update(own)
        t, r = sum(target.values()), sum(raw.values())
        tables.append({b: round(math.log((target[b] + 16 * t / r) / ((raw[b] + 16) * t / r)) * 2**20) for g in grams for b in g} if t else None)
    for (_, text), own, fold in zip(docs, grams, folds):
        table, w = tables[fold], words(text)
        score = sum(table[b] for b in own) / len(own) / 2**20 if own and table else 0.0
        at = defaultdict(list)
        for k in range(len(w) - 2):
            at[tuple(w[k : k + 3])].append(k)
        repeat = {p for ks in at.values() if len(ks) > 1 for k in ks for p in (k, k + 1, k + 2)}
        out.append((score, len(w) >= 50 and 100 * len(repeat) <= 50 * len(w) and score >= -0.15))
    return out


def without_lines(docs):
    key = lambda x: x.encode().strip().lower().decode()
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    return [
        (i, "\n".join(x for x in (text or "").split("\n") if len(key(x)) < 10 or i == min(holders[key(x)]))) for i, text in docs
    ]


def one_of_each(docs):
    sets = []
    for _, text in docs:
        w = words((text or "").encode().lower().decode())
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = [i for i, _ in docs]
    changed = True
    links = [(a, b) for a, b in itertools.combinations(range(len(docs)), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return [(i, text) for (i, text), own in zip(docs, label) if own == i]


def clean_of(docs, items):
    word = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    windows = set()
    for text in items:
        w = word.findall(lower(text))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    out = []
    for i, text in docs:
        w = word.findall(lower(text))
        if not any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1)):
            out.append((i, text))
    return out


def of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def check_pieces(got, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    want = {}
    for i, text in docs:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids), 1024), len(ids)] if len(ids) > 1024 else [0, len(ids)]
        for k, (s, e) in enumerate(itertools.pairwise(edges)):
            want[i, k] = (s, e - s, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[s:e])))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    rooms = defaultdict(list)
    for r in got:
        rooms[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in rooms.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    # Never more sequences than best fit, longest first, piece by piece.
    plain = []
    for length in sorted((r["length"] for r in got), reverse=True):
        fits = [x for x in plain if x >= length]
        if fits:
            plain.remove(min(fits))
        plain.append((min(fits) if fits else 1024) - length)
    assert len(rooms) <= len(plain)


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    plain = of(docs)
    steps = [
        lambda d: [x for x, (_, kept) in zip(d, quality(d, trusted)) if kept], without_lines, one_of_each, lambda d: clean_of(d, items),
    ]
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        docs, after = stage(spark, docs, FOLDER), step(plain)
        assert of(docs) == sorted(after), name
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert len(after) < len(plain) or name in ("line_dedup", "near_dedup")
        plain = sorted(after)
    check_pieces(corpus_pipeline.run(spark, FOLDER).collect(), plain)


def test_quality_query(spark):
    docs = of(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op3_quality_rules"](spark, FOLDER).collect()}
    for (i, _), (score, kept) in zip(docs, quality(docs, trusted)):
        assert abs(got[i]["score"] - score) < 1e-6 and got[i]["kept"] == kept
    assert len(got) == len(docs)


def test_packing_query(spark):
    check_pieces(QUERIES["op8_best_fit_packing"](spark, FOLDER).collect(), of(spark.read.parquet(f"{FOLDER}/documents.parquet")))


def test_suffix_query(spark):
    docs = [(i, (t or "").encode()) for i, t in of(spark.read.parquet(f"{FOLDER}/documents.parquet"))]
    seen = Counter(t[k : k + 200] for _, t in docs for k in range(len(t) - 199))
    got = {r["doc_id"]: r for r in QUERIES["op10_suffix_dedup"](spark, FOLDER).collect()}
    for i, t in docs:
        gone = bytearray(len(t))
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        spans = len(re.findall(b"\1+", bytes(gone)))
        import hashlib

        kept = hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest()
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (len(t), sum(gone), spans, kept)


def test_language_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op6_language_id"](spark, FOLDER).collect()}
    assert got.keys() == docs.keys()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    tried = [i for i, r in got.items() if r["held_out"] and docs[i]["lang"] and docs[i]["text"]]
    assert sum(got[i]["lang_pred"] == docs[i]["lang"] for i in tried) >= 0.95 * len(tried)


# ---- toxicity ----------------------------------------------------------------------------------


@pytest.mark.parametrize("top", [1, 3])
def test_likelihood_and_gradient(top):
    import numpy as np

    pick = np.random.default_rng(top)
    n, rows = 5, 40
    y = np.concatenate([np.arange(top + 1), pick.integers(0, top + 1, rows - top - 1)])
    row, column = np.repeat(np.arange(rows), 2), pick.integers(0, n, 2 * rows)
    value, weight = pick.random(2 * rows) + 0.5, pick.random(rows)
    x = pick.normal(size=n + top) * 0.5
    found, slope = toxicity.loss(x, row, column, value, y, weight, 0.01)
    # Row by row: the grade is the number of thresholds below it.
    cut = [x[n]]
    for gap in x[n + 1 :]:
        cut.append(cut[-1] + math.exp(gap))
    below = lambda k, z: 0.0 if k < 0 else 1.0 if k >= top else 1 / (1 + math.exp(z - cut[k]))
    want = 0.01 / 2 * sum(v * v for v in x[:n])
    for i in range(rows):
        z = sum(value[k] * x[column[k]] for k in range(2 * rows) if row[k] == i)
        want -= weight[i] * math.log(below(y[i], z) - below(y[i] - 1, z))
    assert abs(found - want) < 1e-9
    for k in range(n + top):
        step = np.zeros(n + top)
        step[k] = 1e-6
        up, down = (toxicity.loss(x + s, row, column, value, y, weight, 0.01)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - slope[k]) < 1e-5


def test_ordered_grades(spark):
    """Three grades share the weights: more of the telling word is a higher expected grade."""
    pick = random.Random(6)
    neutral = ["".join(pick.choices("abcdefgh", k=5)) for _ in range(80)]
    rows = [(k, " ".join([*pick.choices(neutral, k=25), *["vile"] * (2 * (k % 3))]), k % 3) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = toxicity.fit(docs.drop("grade"), docs.select("doc_id", "grade"))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = {r["doc_id"]: r["expected_severity"] for r in toxicity.score(docs, model).collect()}
    mean = [sum(got[k] for k, _, g in rows if g == grade) / 100 for grade in range(3)]
    assert mean[0] < mean[1] < mean[2]


def test_the_sample_is_chosen_from_the_labels(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)] + [(None, 1), (7, None), (3, 0)], "doc_id long, grade int")
    rows = toxicity.chosen(labels, 20).collect()
    assert len(rows) == 20 == len({r["key"] for r in rows})
    every = {r["key"]: (r["h"], r["grade"]) for r in toxicity.chosen(labels, 1000).collect()}
    assert len(every) == 50 and every[3][1] == 1
    assert {r["key"] for r in rows} == set(sorted(every, key=lambda k: every[k][0])[:20])


def test_toxicity_query(spark):
    """Odd rows of texts: null, empty, long, repeated; every row is scored."""
    docs = spark.createDataFrame(
        [(k, t, "x") for k, t in enumerate([None, "", "word " * 30000, "a b c", "a b c", "\n\t", "日本語"])] + [(None, "vile", "x"), (3, "a b c", "x")],
        "doc_id long, text string, words string",
    )
    model = toxicity.fit(docs, spark.createDataFrame([(3, 1), (0, 0), (2, 0), (99, 1)], "doc_id long, grade int"))
    assert toxicity.score(docs, model).count() == 9
    got = QUERIES["op1_toxicity"](spark, FOLDER)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r["p_toxic"] <= 1 for r in rows) and any(labels.values())


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, and columns named like those of the operators; empty tables."""
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_dropped int, row string, version string, rank long"
    extra = ("en", "s", 1, "k", 2, "r", "v", 3)
    shared = "a line that several documents hold"
    rows = [(1, " ".join(f"w{k}" for k in range(80)) + "\n" + shared), (2, " ".join(f"x{k}" for k in range(80)) + "\n" + shared), (None, None), (3, ""), (3, ""),
            (4, "see one two three"), (None, "no id"), (5, None)]
    docs = spark.createDataFrame([(*r, *extra) for r in rows], schema)
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns and got.collect() is not None, name
        assert all(tuple(r)[5:] == extra[3:] for r in got.collect())
        assert stage(spark, none, folder).collect() == []
    lines = {(r["doc_id"], r["text"]) for r in corpus_pipeline.line_repeats(spark, docs, folder).collect()}
    assert (1, rows[0][1]) in lines and (2, rows[1][1].split("\n")[0]) in lines and (5, None) in lines and (None, None) in lines
    clean = [r["doc_id"] for r in corpus_pipeline.benchmark_leaks(spark, docs, folder).collect()]
    assert 4 not in clean and len(clean) == 7
    assert corpus_pipeline.pack(spark, docs, folder).count() == len(rows) and corpus_pipeline.pack(spark, none, folder).count() == 0
