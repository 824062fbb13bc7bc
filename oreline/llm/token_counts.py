"""Token counts by a finite-state machine compiled from a byte-pair vocabulary.

The last token of every beginning of a text is unique: of the pieces that end there it is the one that stays apart from the
last token before it. So a deterministic transducer needs to know only the starts from which a piece may still grow: for each
its place in the trie of pieces, the last token before it and how many tokens fewer that beginning has. A transition on a
character is annotated with the number of tokens by which the count grows (it may shrink when pieces join). States are made when a
text first reaches them and kept up to a bound.

Two neighbours that stand in no piece are a hard boundary: whatever came before, the machine goes on as from the start. A chunk
of a text therefore maps a state to (state, tokens) by its head, the characters before its first boundary, alone; what
follows is known without the state. Such maps compose associatively, and a prefix scan over the chunks of a text gives the count at
the end of each.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.shared import ship

#: What stands for a space in the pieces (fixed value of the model format).
SPACE = "▁"
#: Characters in a chunk.
CHUNK = 1 << 16
#: Bounds of what a worker remembers; beyond them it starts afresh.
STATES, PAIRS = 250_000, 500_000
_NORMAL, _BPE = 1, 2
INF = float("inf")
#: A part of a token and the lowest score joined while it stands, until it grows.
Trace = tuple[tuple[str | None, float], ...]
#: A start: place in the trie, the last token before it (the token itself where nothing has grown yet), tokens fewer than now.
Entry = tuple[int, Trace | str, int]


class State(dict):
    """Transitions by character: (next state, tokens more)."""

    __slots__ = ("key", "machine")

    def __init__(self, key: tuple[Entry, ...], machine: "Machine"):
        self.key, self.machine = key, machine

    def __missing__(self, char: str):
        self[char] = step = self.machine.step(self.key, char)
        return step


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to a state: run ``head`` from it; if there is a boundary, then add ``tokens`` and be in ``state``."""

    head: str
    tokens: int = 0
    state: State | None = None  # None: no boundary, the head is all

    def after(self, state: State) -> tuple[State, int]:
        state, tokens = run(state, self.head)
        return (state, tokens) if self.state is None else (self.state, tokens + self.tokens)

    def then(self, other: "ChunkMap") -> "ChunkMap":
        if self.state is None:
            return ChunkMap(self.head + other.head, other.tokens, other.state)
        state, tokens = other.after(self.state)
        return ChunkMap(self.head, self.tokens + tokens, state)


def run(state: State, text: str) -> tuple[State, int]:
    total = 0
    for char in text:
        state, more = state[char]
        total += more
    return state, total


class Machine:
    """The transducer of one sentencepiece model of byte-pair type with byte fallback and plain normalisation."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto.FromString(model)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        plain = spec.escape_whitespaces and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap and not trainer.treat_whitespace_as_suffix
        # User-defined and unused pieces (types 4 and 5) follow other rules.
        if trainer.model_type != _BPE or not trainer.byte_fallback or not plain or any(p.type in (4, 5) for p in proto.pieces):
            raise ValueError("not a byte-pair model with byte fallback and plain normalisation")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.score = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.neighbours = {p[k : k + 2] for p in self.score for k in range(len(p) - 1)}
        self.children: list[dict[str, int]] = [{}]
        self.piece_at: list[str | None] = [None]
        for piece in [*{c for p in self.score for c in p}, *self.score]:
            at = 0
            for char in piece:
                if char not in self.children[at]:
                    self.children[at][char] = len(self.children)
                    self.children.append({})
                    self.piece_at.append(None)
                at = self.children[at][char]
            self.piece_at[at] = piece
        self.begins = {p[: k + 1] for p in self.score for k in range(len(p))}
        self.joins: dict[str, tuple[bool, Trace, Trace]] = {}
        self.seen: dict[tuple[str, str], Trace] = {}
        self.traces: dict[Trace, Trace] = {}
        self.pairs: dict[tuple[Trace, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple[Entry, ...], State] = {}
        self.start = self._state(((0, "", 0),))

    def _state(self, key: tuple[Entry, ...]) -> State:
        if key not in self.states:
            self.states[key] = State(key, self)
        return self.states[key]

    def _joins(self, piece: str) -> tuple[bool, Trace, Trace]:
        """Whether the tokens of a piece are itself; its last and its first part over time, each with the lowest score joined until it grows."""
        if piece not in self.joins:
            parts = list(piece)
            last, first = [[parts[-1], INF]], [[parts[0], INF]]
            while True:
                # The highest score joins next, the leftmost of equals.
                best = max(
                    ((self.score[x + y], -k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in self.score), default=None
                )
                if best is None:
                    break
                k = -best[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                for trace, part in ((last, parts[-1]), (first, parts[0])):
                    trace[-1][1] = min(trace[-1][1], best[0])
                    if part != trace[-1][0]:
                        trace.append([part, INF])
            last[-1][1], first[-1][1] = -INF, -INF
            self.joins[piece] = len(parts) == 1, tuple(map(tuple, last)), tuple(map(tuple, first))
        return self.joins[piece]

    def _towards(self, piece: str, char: str) -> Trace:
        """The last part of a token over time, as far as it can join with something that begins with a character.

        Tokens that look alike from there are one to the states.
        """
        if (piece, char) not in self.seen:
            out: list[tuple[str | None, float]] = []
            for part, low in self._joins(piece)[1]:
                joins = part + char in self.begins
                if not joins and out and out[-1][0] is None:
                    out[-1] = None, min(low, out[-1][1])
                else:
                    out.append((part if joins else None, low))
            while out and out[-1][0] is None:
                out.pop()
            self.seen[piece, char] = self.traces.setdefault(tuple(out), tuple(out))
        return self.seen[piece, char]

    def _apart(self, before: Trace, piece: str) -> bool:
        """Whether two tokens side by side stay as they are.

        Each goes through its own joins, the higher score first and the left token first of equals; they come together when a join across the
        border scores higher than what either does next.
        """
        if (before, piece) not in self.pairs:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            after, i, k, apart = self._joins(piece)[2], 0, 0, True
            while apart and i < len(before):
                (x, a), (y, b) = before[i], after[k]
                across = self.score.get(x + y, -INF) if x else -INF
                apart = not (across > a and across >= b)
                if a >= b and a > -INF:
                    i += 1
                elif b > -INF:
                    k += 1
                else:
                    break
            self.pairs[before, piece] = apart
        return self.pairs[before, piece]

    def step(self, key: tuple[Entry, ...], char: str) -> tuple[State, int]:
        if char not in self.children[0]:
            # In no piece: one token a byte, and a boundary on both sides.
            return self.start, len(char.encode())
        grown = [(to, before, fewer) for at, before, fewer in key[:-1] if (to := self.children[at].get(char))]
        last = key[-1][1]
        grown.append((self.children[0][char], self._towards(last, char) if last else (), key[-1][2]))
        last, more = next(
            (piece, fewer + (1 if piece in self.score else len(piece.encode())))
            for at, before, fewer in grown if (piece := self.piece_at[at]) and self._joins(piece)[0] and self._apart(before, piece)
        )
        # A start from which no piece goes on is forgotten.
        new = [(at, before, fewer - more) for at, before, fewer in grown if self.children[at]]
        return self._state((*new, (0, last, 0))), more

    def chunk_map(self, chunk: str, before: str = "") -> ChunkMap:
        """``before`` is the character in front of the chunk."""
        if len(self.states) >= STATES:
            self.reset()
        first, last = 0, before
        for char in chunk:
            if not last or last + char not in self.neighbours:
                break
            first, last = first + 1, char
        else:
            return ChunkMap(chunk)
        state, tokens = run(self.start, chunk[first:])
        return ChunkMap(chunk[:first], tokens, state)

    def counts(self, text: str, chunk: int = CHUNK) -> list[int]:
        """Tokens up to the end of each chunk of a text, an empty list for an empty text."""
        if not text:
            return []
        text = self.prefix + text.replace(" ", SPACE)
        maps = [self.chunk_map(text[k : k + chunk], text[k - 1] if k else "") for k in range(0, len(text), chunk)]
        return [m.after(self.start)[1] for m in scan(maps)]


def scan(maps: list[ChunkMap]) -> list[ChunkMap]:
    """Inclusive prefixes under composition, by halving: pairs compose independently, so do the elements of each level."""
    if len(maps) < 2:
        return maps
    pairs = scan([maps[k].then(maps[k + 1]) for k in range(0, len(maps) - 1, 2)])
    return [maps[0] if k == 0 else pairs[k // 2] if k % 2 else pairs[k // 2 - 1].then(maps[k]) for k in range(len(maps))]


_machines: dict[str, Machine] = {}


def machine(path: str) -> Machine:
    if path not in _machines:
        with open(path, "rb") as file:
            _machines[path] = Machine(file.read())
    return _machines[path]


def token_counts(docs: DataFrame, model: str, chunk: int = CHUNK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and prefix (tokens up to the end of each chunk of the text) of every row.

    ``model`` is the path of the model file on every worker. A null text is empty: no bytes, no tokens, an empty prefix. Null and repeated ids are
    rows like others. Other columns are not read. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def count(batches):
        own = machine(model)
        for batch in batches:
            prefix = [own.counts(t.as_py(), chunk) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("n_bytes"), pa.array([p[-1] if p else 0 for p in prefix], pa.int64()),
                    pa.array(prefix, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "prefix"],
            )

    sized = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return sized.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, prefix array<long>")
