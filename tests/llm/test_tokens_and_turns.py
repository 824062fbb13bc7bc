"""Token counts, alignment of two tokenizers and repair of conversations, against the libraries and brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from oreline.llm import conversation_repair, token_alignment, token_counts
from oreline.llm.queries import QUERIES, tokenizer_path

BYTES, PIECES = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  \n\t", "a", "<s>x</s><unk><0x0A> <|endoftext|>", "日本語 中文", "\U0001f9ff\U0001f9ff á ß", "x▁y", "\x00\x01", "é" * 300,
    "word " * 4000, "aaaa" * 500, "▁", " lead", "trail ", "Ünïcödé\n\nlines\r\n",
]


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(4)
    made = ["".join(pick.choices("abcdeé it the\n 12日\U0001f9ff́", k=pick.randint(0, 120))) for _ in range(150)]
    return [*ODD, *made, *made[:20], made[3]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(None if k % 50 == 49 else k % 170, t, "x", 1, "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, chunk string, n_tokens int, pairs string")


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_counts_of_the_library(docs, texts, library, chunk):
    want = Counter((None if k % 50 == 49 else k % 170, len((t or "").encode()), len(library.encode(t or ""))) for k, t in enumerate(texts))
    got = token_counts.token_counts(docs, PIECES, chunk).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all((r.prefix[-1] if r.prefix else 0) == r.n_tokens for r in got)


def test_states_and_pairs_of_the_vocabulary(library):
    """Any order of pieces, also such that no text has; little memory changes nothing."""
    pick, own = random.Random(7), token_counts.machine(PIECES)
    pieces = sorted(own.score)
    for k in range(2000):
        text = "".join(pick.choices(pieces, k=pick.randint(1, 9))).replace("▁", " ")
        assert own.counts(text)[-1] == len(library.encode(text)), text


def test_little_memory(monkeypatch, library, texts):
    monkeypatch.setattr(token_counts, "STATES", 5)
    monkeypatch.setattr(token_counts, "PAIRS", 3)
    with open(PIECES, "rb") as file:
        own = token_counts.Machine(file.read())
    for t in texts[:60]:
        assert (own.counts(t or "", 9) or [0])[-1] == len(library.encode(t or ""))


def test_maps_compose(library):
    """Any bracketing of the chunks gives the same map, and each prefix the count of that beginning."""
    own = token_counts.machine(PIECES)
    text = "▁" + "internationalisation 日本語 of the thing".replace(" ", "▁")
    maps = [own.chunk_map(text[k : k + 3], text[k - 1] if k else "") for k in range(0, len(text), 3)]
    left = maps[0]
    for m in maps[1:]:
        left = left.then(m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = m.then(right)
    assert left.after(own.start) == right.after(own.start)
    for k, m in enumerate(token_counts.scan(maps)):
        start = text[1 : 3 * k + 3].replace("▁", " ")
        assert m.after(own.start)[1] == len(library.encode(start))


def test_other_models_are_refused():
    with open(PIECES, "rb") as file:
        data = file.read()
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto.FromString(data)
    model.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError, match="byte-pair"):
        token_counts.Machine(model.SerializeToString())


def spelled(text, library, tokenizer):
    """Tokens of both sides as (id, bytes), or None."""
    if not text:
        return None
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    one = tokenizer.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(one.ids, one.tokens)]
    b = [
        (i, bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode())
        for i, p in zip(library.encode(text), library.encode(text, return_type=str))
    ]
    data = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == data == b"".join(x for _, x in b) else None


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 200])
def test_alignment_byte_by_byte(docs, texts, library, chunk_bytes, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", chunk_bytes)
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    held, found = Counter(), []
    for text in texts:
        sides = spelled(text, library, tokenizer)
        if sides is None:
            found.append(None)
            continue
        own_a, own_b = ([k for k, (_, x) in enumerate(side) for _ in x] for side in sides)
        links = sorted(set(zip(own_a, own_b)))
        groups, ga, gb = [], [], []
        for k, (x, y) in enumerate(zip(own_a, own_b)):
            ga += [x] if x not in ga else []
            gb += [y] if y not in gb else []
            if k + 1 == len(own_a) or (own_a[k + 1] != x and own_b[k + 1] != y):
                groups.append("|".join(",".join(str(side[n][0]) for n in g) for side, g in zip(sides, (ga, gb))))
                ga, gb = [], []
        pairs = [(sides[0][x][0], sides[1][y][0]) for x, y in links]
        held.update(set(pairs))
        found.append((len(sides[0]), len(sides[1]), groups, pairs))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    want = Counter()
    for k, own in enumerate(found):
        i = None if k % 50 == 49 else k % 170
        if own is None:
            want[i, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            a, b, groups, pairs = own
            want[i, a, b, len(groups), len(pairs), sum(held[p] == best[p[0]] for p in pairs), sum(held[p] for p in pairs), ";".join(groups)] += 1
    got = token_alignment.align(docs, BYTES, PIECES).collect()
    assert Counter(tuple(r) for r in got) == want
    assert sum(x is None for x in found) >= 4
    hashed = token_alignment.align(docs, BYTES, PIECES, digest=True).collect()
    assert Counter(r.groups for r in hashed) == Counter(hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "" for r in got)


# ---- conversations ---------------------------------------------------------------------------

EXPRESSION = re.compile("(s?(ua)+)?")
BEGINNING = re.compile("s?(ua)*u?")


def cheapest(rows):
    """The least (cost, audit, repaired) over all edits of rows (role, text, must go, truncated), at most two inserts at each place."""
    # To delete all rows is one way.
    best = (4 * len(rows), "D" * len(rows), [])

    def go(k, out, cost, audit, run):
        nonlocal best
        initials = "".join(r[:1] for r, _ in out)
        if cost > best[0] or not BEGINNING.fullmatch(initials):
            return
        if k == len(rows) and EXPRESSION.fullmatch(initials):
            best = min(best, (cost, audit, out))
        if run < 2:
            for role in ("user", "assistant"):
                go(k, [*out, (role, "")], cost + 3, audit + "I", run + 1)
        if k < len(rows):
            role, text, must, cut = rows[k]
            # A row with an empty role has no initial to keep.
            if not must and role:
                go(k + 1, [*out, (role, text)], cost + 3 * cut, audit + "K", 0)
            go(k + 1, out, cost + 4, audit + "D", 0)
            if not must:
                for other in ("user", "assistant"):
                    go(k + 1, [*out, (other, text)], cost + 3 + 3 * cut, audit + "R", 0)

    go(0, [], 0, "", 0)
    return best


def judged(rows):
    """blank, duplicate, truncated of rows (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        again = (role, text) in seen
        seen.add((role, text))
        out.append((not said, bool(said) and again, bool(said) and not again and said[-1] not in ".!?"))
    return out


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), text.encode())


def expected(rows):
    rows = sorted(rows, key=order)
    faults = judged(rows)
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, out = cheapest([(r, t, b or d, c) for (_, r, t), (b, d, c) in zip(rows, faults)])
    odd = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _), (_, b, _) in zip(rows, rows[1:]))
    repaired = "\n".join(f"{r}:{t}" for r, t in out)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(f[k] for f in faults) for k in range(3)), odd, cost, audit,
        hashlib.sha256(repaired.encode()).hexdigest(),
    ), out


@pytest.fixture(scope="module")
def conversations():
    pick = random.Random(11)
    out = []
    for conv in [*range(60), None]:
        for k in range(pick.randint(1, 5)):
            turn = pick.choice([k, k, k, k + 2, None])
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            out.append((conv, turn, role, pick.choice(["Yes.", "No!", "what", "", None, " \t\n", "Why? ", "Yes.", "ß", "a" * 5000 + "."])))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, copy string, verdict string"


def test_repair_is_cheapest(spark, conversations):
    by = defaultdict(list)
    for conv, turn, role, text in conversations:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    df = spark.createDataFrame([(*r, "c", "v") for r in conversations], SCHEMA)
    got = conversation_repair.repair(df).collect()
    verdicts = {r.conv_id: tuple(r.verdict) for r in got if r.verdict}
    assert len(verdicts) == len(by) == sum(r.verdict is not None for r in got)
    for conv, rows in by.items():
        want, out = expected(rows)
        assert verdicts[conv] == want, rows
        turns = sorted((r.place, r.role, r.text) for r in got if r.verdict is None and r.conv_id == conv)
        assert turns == [(k, *x) for k, x in enumerate(out)]


def test_damage_and_query(spark, conversations, tmp_path):
    """The registered query over damaged rows, with conversations that lose all of theirs."""
    rows = [*conversations, *((1000 + k, 0, "user", "Gone or not.") for k in range(60))]
    by = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if fault == 4 else role
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        by.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1))
    assert any(not x for x in by.values())
    folder = str(tmp_path)
    spark.createDataFrame([(*r, "c", "v") for r in rows], SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, folder).collect()}
    assert got == {conv: expected(own)[0] for conv, own in by.items()}


def test_long_conversation_is_settled_as_it_goes(spark):
    pick = random.Random(5)
    rows = [(1, k, pick.choice(["user", "assistant", "system"]), pick.choice(["a.", "b.", "c", ""]) + (str(k) + "." if k % 3 else "")) for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = [tuple(r) for r in conversation_repair.repair(df, held=10**9).orderBy("place").collect()]
    parts = [tuple(r) for r in conversation_repair.repair(df, held=16).orderBy("place").collect()]
    assert whole == parts
    one = conversation_repair.Repair(1, held=16)
    for _, k, role, text in rows:
        one.add(k, role, text, False)
    assert len(one.held) < 64 and one.paths.width < 4096


def test_weights_against_all_edits():
    pick = random.Random(3)
    for _ in range(120):
        rows = [(pick.choice("suaux"), "t", pick.random() < 0.25, pick.random() < 0.3) for _ in range(pick.randint(0, 4))]
        rows = [(r, t, must, cut and not must) for r, t, must, cut in rows]
        paths, settled = conversation_repair.Paths(2), ""
        for role, _, must, cut in rows:
            paths.row(role, must, cut)
            if pick.random() < 0.5:
                settled += paths.settle()
        cost, letters = paths.end()
        assert (cost, settled + letters) == cheapest(rows)[:2]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(none, PIECES).collect() == []
    assert token_alignment.align(none, BYTES, PIECES).collect() == []
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair(rows).collect() == [] and conversation_repair.damaged(rows).collect() == []


def test_registered_queries(spark, tmp_path, texts, library):
    """Whole tables, all columns of the contract."""
    folder = str(tmp_path)
    long = "many words " * 2500
    rows = [(k, t) for k, t in enumerate([*texts, long])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    counts = {r.doc_id: r for r in QUERIES["op11_token_counts"](spark, folder).collect()}
    assert counts.keys() == {k for k, _ in rows}
    for k, t in rows:
        n = len(library.encode(t or ""))
        assert (counts[k].n_bytes, counts[k].n_tokens, counts[k].over_limit) == (len((t or "").encode()), n, n > 4096)
    assert any(r.over_limit for r in counts.values())
    got = QUERIES["op12_token_alignment"](spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert all((r.groups_sha256 == "") == (r.n_a == 0) for r in got.collect())
    assert all(a <= b for a, b in itertools.pairwise(sorted(counts)))
