"""Cheapest repair of the order of roles in conversations.

A conversation is repaired by keeping, reroling or deleting its rows and inserting empty ones, so that the initials of its
roles read (s?(ua)+)?. Each path through the graph (row, state of that expression) has one integer as its weight: the high digits
hold the cost, the low digits the letters of its edits at fixed places from the left, zero where the path has ended. An edge
adds its cost and its letter at the next place, so the ordinary minimum of integers finds the cheapest edits and, among equal
costs, those least in ASCII. Paths that meet in a node have used the same rows, so none is the beginning of another.

Rows reach a task sorted by conversation and turn and are streamed. In a long conversation the letters that the paths to all
states share are settled from time to time and their rows let go, so a task holds some thousand rows, whatever the length.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.shared import ship

BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, KEEP, REROLE = 4, 3, 0, 3
#: What a row costs that ends without a mark and is not deleted.
TRUNCATED = 3
_DIGIT = 3  # bits
_CODE = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = " DIKR"
#: States: nothing yet, after s, after u, after a. The next role that may be made, and the state behind it.
_MADE = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_ENDS = (0, 3)
#: Rows of one conversation that are held before settled ones are let go.
HELD = 4096
OUT = (
    "conv_id long, place long, edit string, role string, text string, verdict struct<gaps: long, blank: long, duplicate: long, "
    "truncated: long, illegal: long, cost: long, audit: string, repaired_sha256: string>"
)


class Paths:
    """The least path to each state, for the rows since the last settled letter."""

    def __init__(self, width: int = 32):
        self.width = width
        self.base = 0  # cost of what is settled
        self.least: dict[int, tuple[int, int]] = {0: (0, 0)}  # state: (weight, letters)
        self._insert()

    def _edge(self, at: tuple[int, int], cost: int, letter: str) -> tuple[int, int]:
        weight, used = at
        return weight + (cost << _DIGIT * self.width) + (_CODE[letter] << _DIGIT * (self.width - 1 - used)), used + 1

    def _insert(self) -> None:
        # Two inserts lead from any state to any that inserts can reach; more would only come back.
        for _ in range(2):
            for state, at in list(self.least.items()):
                to, found = _MADE[state][1], self._edge(at, INSERT, "I")
                if to not in self.least or found < self.least[to]:
                    self.least[to] = found

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        if max(used for _, used in self.least.values()) + 3 > self.width:
            low = (1 << _DIGIT * self.width) - 1
            self.least = {
                s: ((w >> _DIGIT * self.width << 2 * _DIGIT * self.width) + ((w & low) << _DIGIT * self.width), n)
                for s, (w, n) in self.least.items()
            }
            self.width *= 2
        found: dict[int, tuple[int, int]] = {}
        for state, at in self.least.items():
            edges = [(state, DELETE, "D")]
            if not must_go:
                more = TRUNCATED * truncated
                edges.append((_MADE[state][1], REROLE + more, "R"))
                if (state, initial) in _KEPT:
                    edges.append((_KEPT[state, initial], KEEP + more, "K"))
            for to, cost, letter in edges:
                new = self._edge(at, cost, letter)
                if to not in found or new < found[to]:
                    found[to] = new
        self.least = found
        self._insert()

    def _letters(self, weight: int, used: int) -> str:
        return "".join(_LETTER[weight >> _DIGIT * (self.width - 1 - k) & 7] for k in range(used))

    def settle(self) -> str:
        """The letters that all paths share from the start; they leave the weights.

        A path from which nothing or s was kept so far is dropped when one behind a later state is cheaper by more than that state could
        lose: two inserts, and the delete of an s that it may not keep.
        """
        cost = {s: w >> _DIGIT * self.width for s, (w, _) in self.least.items()}
        later = min(c for s, c in cost.items() if s > 1)
        live = {s: at for s, at in self.least.items() if s > 1 or cost[s] <= later + 2 * INSERT + DELETE}
        words = [self._letters(*at) for at in live.values()]
        shared = 0
        while all(len(x) > shared and x[shared] == words[0][shared] for x in words):
            shared += 1
        low = min(cost[s] for s in live)
        keep = (1 << _DIGIT * (self.width - shared)) - 1
        self.base += low
        self.least = {s: ((cost[s] - low << _DIGIT * self.width) + ((w & keep) << _DIGIT * shared), n - shared) for s, (w, n) in live.items()}
        return words[0][:shared]

    def end(self) -> tuple[int, str]:
        """Cost of all and the letters that are not settled yet."""
        weight, used = min(at for s, at in self.least.items() if s in _ENDS)
        return self.base + (weight >> _DIGIT * self.width), self._letters(weight, used)


class Repair:
    """One conversation, row after row."""

    def __init__(self, conv_id, held: int = HELD):
        self.conv_id, self.limit = conv_id, held
        self.held: list[tuple[str, str]] = []
        self.paths, self.audit, self.hash = Paths(), [], hashlib.sha256()
        self.rows = self.place = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.before = ""
        self.state = 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> list[tuple]:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        initial, said = role[:1], text.strip(BLANKS)
        blank, cut = not said, bool(said) and said[-1] not in ".!?"
        self.blank += blank
        self.duplicate += repeated and not blank
        cut = cut and not repeated
        self.truncated += cut
        self.illegal += self.rows > 0 and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.rows += 1
        self.held.append((role, text))
        self.paths.row(initial, blank or repeated, cut)
        return self._apply(self.paths.settle()) if len(self.held) >= self.limit else []

    def _apply(self, letters: str) -> list[tuple]:
        """Let go of the rows that the letters use: (place, edit, role, text) of what stays of them."""
        out, used = [], 0
        for letter in letters:
            role, text = self.held[used] if letter != "I" else ("", "")
            used += letter != "I"
            if letter == "D":
                continue
            if letter == "K":
                self.state = _KEPT[self.state, role[:1]]
            else:
                role, self.state = _MADE[self.state]
            self.hash.update(("\n" * (self.place > 0) + f"{role}:{text}").encode())
            out.append((self.place, letter, role, text))
            self.place += 1
        del self.held[:used]
        self.audit.append(letters)
        if used == 0:
            self.limit *= 2
        return out

    def end(self) -> tuple[list[tuple], dict]:
        cost, letters = self.paths.end()
        turns = self._apply(letters)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return turns, {
            "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "cost": cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest(),
        }


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with planted faults, chosen by crc32 of "conv_id:turn" modulo 20: conv_id, turn, role, text, absent.

    0 drops the row (it stays as absent), 1 empties the text, 2 removes its [.!?], 3 repeats the row, 4 makes the role user. A null counts as one
    space in the key, the role and the text; a null turn stays null.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part(conv_id), F.lit(":"), part(turn)).cast("binary")) % 20
    kept = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(part(role)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(part(text), "[.!?]", "")).otherwise(part(text)).alias("text"),
        (fault == 0).alias("absent"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    )
    return kept.drop("copy")


def repair(rows: DataFrame, turns: bool = True, held: int = HELD, absent: str | Column | None = None) -> DataFrame:
    """Cheapest repair of each conversation in (conv_id, turn, role, text).

    Returns one row per conversation with a verdict (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) and, with ``turns``,
    one row without a verdict per turn of the repaired conversation: place (from 0), edit (K, R or I), role, text.

    Rows are taken by turn, nulls first; rows of one turn by role and text. A null role or text is one space; an empty role has
    no initial and cannot be kept. A null conv_id is one conversation. ``absent`` marks rows that only name their conversation: one with no other rows has zeros, an empty audit and the hash of
    the empty string. Repeated rows are duplicates, empty texts blank. Other columns are not read. An empty table gives an empty result.
    """
    ship(rows.sparkSession)
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    gone = F.lit(False) if absent is None else (F.col(absent) if isinstance(absent, str) else absent)
    own = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), part("role"), part("text"),
        F.coalesce(gone, F.lit(False)).alias("absent"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    # One shuffle: the window finds the rows of a conversation where the first step has put them.
    same = Window.partitionBy("conv_id", "absent", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    sorted_rows = (
        own.repartition("conv_id").withColumn("repeated", F.row_number().over(same) > 1).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)
    )

    def walk(batches):
        one: Repair | None = None
        out: list[tuple] = []

        def close():
            stays, verdict = one.end()
            put(stays)
            out.append((one.conv_id, None, None, None, None, verdict))

        def put(stays):
            if turns:
                out.extend((one.conv_id, *x, None) for x in stays)

        for batch in batches:
            for conv, turn, role, text, lost, repeated in zip(*(c.to_pylist() for c in batch.columns)):
                if one is None or conv != one.conv_id:
                    if one is not None:
                        close()
                    one = Repair(conv, held)
                if not lost:
                    put(one.add(turn, role, text, repeated))
            yield _rows(out)
            out = []
        if one is not None:
            close()
            yield _rows(out)

    return sorted_rows.mapInArrow(walk, OUT)


_VERDICT = pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
_TYPES = [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), ("verdict", _VERDICT)]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [()] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _TYPES)], names=[n for n, _ in _TYPES])
