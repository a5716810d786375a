"""Repair of conversations: the cheapest edits that make speakers take turns.

A conversation's rows are brought together by one shuffle, sorted by turn and streamed once, in
Arrow batches, through a dynamic programme over the states of the wanted form
``(system? (user assistant)+)?``. Between rows it carries, for each of the four states, the lowest
cost, the order of the edits among those of the other states, and a running digest of the messages
repaired so far. Which state a state came from goes to a list of four bytes a row, which is moved
to a file of the task once it gets long, as Spark does with rows that it spills. So a conversation
of any length needs no more memory than another, besides its edits themselves, which are one
letter a row.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\v\f\r"
# Costs of edits, and of leaving a message that breaks off.
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 1, 2, 5, 5
# Bytes of backpointers a conversation keeps in memory.
SPILL = 1 << 22

# What stands at the end of the messages so far: none, a system's, a user's, an assistant's.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_DONE = (_NONE, _ASSISTANT)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_LETTERS = "DKR"
_NEVER = float("inf")


def _inserted(state: int) -> Iterator[tuple[int, int]]:
    """``(inserts, state)`` for every state that inserts lead to by the shortest way."""
    seen = set()
    for n in range(3):
        if state not in seen:
            yield n, state
        seen.add(state)
        state = _NEXT[state]


def _moves(initial: str, faulty: bool, broken: bool) -> list[list[tuple]]:
    """For each new state: ``(cost, word, old state, inserts, letter)`` of all ways to it.

    A way is some inserts and then one edit of the row; ``word`` spells it.
    """
    out: list[list[tuple]] = [[], [], [], []]

    def add(old: int, inserts: int, letter: str, new: int, cost: int) -> None:
        word = "I" * inserts + letter
        out[new].append((cost + inserts * INSERT, word, old, inserts, _LETTERS.index(letter)))

    kept = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}.get(initial)
    extra = BROKEN if broken else 0
    for old in range(4):
        for inserts, at in _inserted(old):
            add(old, inserts, "D", at, DELETE)
            if faulty:
                continue
            add(old, inserts, "R", _NEXT[at], REROLE + extra)
            if kept == _NEXT[at] or (kept == _SYSTEM and at == _NONE):
                add(old, inserts, "K", kept, KEEP + extra)
    return out


class Conversation:
    """The rows of one conversation, taken in order."""

    def __init__(self, spill: int):
        self.turns: list[int] = []  # lowest, highest
        self.n_turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last_turn = self.last_initial = None
        self.costs = [0, _NEVER, _NEVER, _NEVER]
        self.ranks = [0, 1, 2, 3]
        self.digests = [hashlib.sha256(), None, None, None]
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        self.back = tempfile.SpooledTemporaryFile(spill, dir=folder)

    def add(self, turn: int | None, role: str, text: str, repeated: bool, moves) -> None:
        if turn is not None:
            self.turns = [self.turns[0] if self.turns else turn, turn]
            self.n_turns += turn != self.last_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in ("su", "ua", "au")
        self.last_initial = initial
        body = text.rstrip(SPACE)
        blank = not body
        duplicate = not blank and repeated
        broken = not blank and not duplicate and body[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += broken
        self._step(moves(initial, blank or duplicate, broken), role, text)

    def _step(self, ways, role: str, text: str) -> None:
        best: list[tuple | None] = []
        for options in ways:
            found = None
            for cost, word, old, inserts, letter in options:
                if self.costs[old] == _NEVER:
                    continue
                way = (self.costs[old] + cost, self.ranks[old], word, old, inserts, letter)
                if found is None or way < found:
                    found = way
            best.append(found)
        raw_text = text.encode()
        digests = [self._digest(w, role, raw_text) for w in best]
        # Edits of two states are never one the beginning of the other, so this order lasts.
        order = sorted((w[1:3], q) for q, w in enumerate(best) if w)
        self.costs = [_NEVER if w is None else w[0] for w in best]
        for rank, (_, q) in enumerate(order):
            self.ranks[q] = rank
        self.digests = digests
        self.back.write(bytes(255 if w is None else w[3] | w[4] << 2 | w[5] << 4 for w in best))

    def _digest(self, way: tuple | None, role: str, text: bytes):
        if way is None:
            return None
        _, _, _, old, inserts, letter = way
        digest = self.digests[old].copy()
        state = self._insert(digest, old, inserts)
        if letter:
            name = role if letter == 1 else _NAMES[_NEXT[state]]
            digest.update(f"\n{name}:".encode() if state != _NONE else f"{name}:".encode())
            digest.update(text)
        return digest

    @staticmethod
    def _insert(digest, state: int, inserts: int) -> int:
        for _ in range(inserts):
            name = _NAMES[_NEXT[state]]
            digest.update(f"\n{name}:".encode() if state != _NONE else f"{name}:".encode())
            state = _NEXT[state]
        return state

    def result(self) -> tuple:
        """``gaps, blank, duplicate, truncated, illegal, cost, audit, sha256``."""
        ends = [
            (self.costs[q] + n * INSERT, self.ranks[q], n, q)
            for q in range(4)
            for n, at in _inserted(q)
            if at in _DONE
        ]
        cost, _, inserts, state = min(ends)
        digest = self.digests[state].copy()
        self._insert(digest, state, inserts)
        gaps = self.turns[1] - self.turns[0] + 1 - self.n_turns if self.turns else 0
        audit = self._audit(state) + "I" * inserts
        counts = (self.blank, self.duplicate, self.truncated, self.illegal)
        return (gaps, *counts, cost, audit, digest.hexdigest())

    def _audit(self, state: int) -> str:
        """The edits that lead to ``state``, read backwards block by block."""
        words = bytearray()
        end, block = self.back.tell(), 1 << 16
        while end:
            start = max(0, end - 4 * block)
            self.back.seek(start)
            part = self.back.read(end - start)
            for at in range(len(part) - 4, -1, -4):
                move = part[at + state]
                words += _LETTERS[move >> 4].encode() + b"I" * (move >> 2 & 3)
                state = move & 3
            end = start
        words.reverse()
        return words.decode()


def ordered(
    rows: DataFrame, conversation: str, turn: str, role: str, text: str, dropped: Column | None = None
) -> DataFrame:
    """``c, t, role, text, dropped, repeated``, all rows of a conversation in one task and in order.

    The order is by turn, nulls first, then role and text. ``repeated`` marks rows whose role and
    text an earlier one has; it comes from the same partitioning, so that the stream need not
    remember texts. Null roles and texts are one space. ``dropped`` rows have neither.
    """
    gone = F.lit(False) if dropped is None else dropped
    spoken = [
        F.when(~gone, F.coalesce(F.col(f"`{c}`"), F.lit(" "))).alias(n)
        for c, n in ((role, "role"), (text, "text"))
    ]
    narrow = rows.select(
        F.col(f"`{conversation}`").alias("c"),
        F.col(f"`{turn}`").cast("long").alias("t"),
        *spoken,
        gone.alias("dropped"),
    ).repartition("c")
    same = Window.partitionBy("c", "role", "text").orderBy(F.col("t").asc_nulls_first())
    marked = narrow.withColumn("repeated", F.row_number().over(same) > 1)
    # Of equal rows the first one is not repeated.
    return marked.sortWithinPartitions("c", F.col("t").asc_nulls_first(), "role", "text", "repeated")


def repairs(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    dropped: Column | None = None,
    spill: int = SPILL,
) -> DataFrame:
    """The cheapest edits of each conversation, one row each.

    Columns: ``conversation``; ``gaps`` (turns missing between the lowest and the highest);
    ``blank``, ``duplicate`` and ``truncated`` rows, each counted under its first fault;
    ``illegal`` (neighbours that do not follow each other); ``cost``; ``audit``, the edits in
    order as letters (Keep, Rerole, Delete, Insert), the lowest text among the cheapest; and
    ``repaired_sha256`` of the repaired ``role:text`` lines.

    Null roles and texts are one space, rows of a null conversation are one conversation, null
    turns come first, rows equal in turn go by role and text, and repeated rows are duplicates.
    Rows where ``dropped`` holds don't count, but their conversation is returned: one without any
    others has no edits and the digest of an empty text. Extra columns are ignored; no rows give
    no rows.
    """
    kind = rows.schema[conversation].dataType.simpleString()
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    names = ["c", *(x.split()[0] for x in counts.split(", ")), "audit", "repaired_sha256"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, list] = {}

        def moves(*kind):
            if kind[0] not in ("s", "u", "a"):
                kind = ("", *kind[1:])
            if kind not in known:
                known[kind] = _moves(*kind)
            return known[kind]

        def row(key, conv: Conversation) -> tuple:
            out = (key, *conv.result())
            conv.back.close()
            return out

        key, conv = None, None
        for frame in frames:
            done = []
            for c, t, r, x, gone, repeated in zip(*(frame[n] for n in frame.columns), strict=True):
                if conv is None or c != key:
                    if conv is not None:
                        done.append(row(key, conv))
                    key, conv = c, Conversation(spill)
                if not gone:
                    conv.add(None if t is None else int(t), r, x, repeated, moves)
            if done:
                yield pd.DataFrame(done, columns=names)
        if conv is not None:
            yield pd.DataFrame([row(key, conv)], columns=names)

    # As text, since pandas has no long column with nulls.
    stream = ordered(rows, conversation, turn, role, text, dropped).select(
        F.col("c").cast("string").alias("c"), F.col("t").cast("string").alias("t"),
        "role", "text", "dropped", "repeated",
    )
    found = stream.mapInPandas(run, f"c string, {counts}, audit string, repaired_sha256 string")
    own = F.col("c").cast(kind).alias(conversation)
    return found.select(own, *[F.col(n) for n in names[1:]])


def messages(
    rows: DataFrame,
    found: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    dropped: Column | None = None,
) -> DataFrame:
    """The repaired conversations: ``conversation, position, role, text, edit``, from 0 in each.

    ``found`` is what ``repairs`` gave for the same rows. Deleted rows are not there; inserted
    ones have an empty text. The edits are cut into one word per row and joined by the row's
    number, so texts are moved as often as for ``repairs``.
    """
    w = Window.partitionBy("c").orderBy(F.col("t").asc_nulls_first(), "role", "text", "repeated")
    given = ordered(rows, conversation, turn, role, text, dropped).where("NOT dropped")
    numbered = given.select("c", (F.row_number().over(w) - 1).alias("n"), "role", "text")
    words = found.select(
        F.col(f"`{conversation}`").alias("_c"),
        F.posexplode(F.regexp_extract_all("audit", F.lit("(I*[DKR]|I+$)"), F.lit(1))).alias("_n", "word"),
    )
    both = words.join(
        numbered, F.col("c").eqNullSafe(F.col("_c")) & (F.col("n") == F.col("_n")), "left"
    )
    letters = both.select(
        "_c", "_n", "role", "text", F.posexplode(F.split("word", "")).alias("_k", "edit")
    ).where("edit IN ('I', 'K', 'R')")
    along = Window.partitionBy("_c").orderBy("_n", "_k")
    first = (F.col("edit") == "K") & F.col("role").startswith("s")
    placed = letters.withColumns(
        {
            "position": F.row_number().over(along) - 1,
            "_led": F.max(first.cast("int")).over(along),
        }
    )
    of_turn = F.when((F.col("position") - F.col("_led")) % 2 == 0, "user").otherwise("assistant")
    return placed.select(
        F.col("_c").alias(conversation),
        "position",
        F.when(F.col("edit") == "K", F.col("role")).otherwise(of_turn).alias("role"),
        F.when(F.col("edit") == "I", F.lit("")).otherwise(F.col("text")).alias("text"),
        "edit",
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with repeatable faults, and ``dropped`` where a row is gone.

    ``crc32(conv_id:turn) % 20`` chooses: 0 drops the row, 1 empties its text, 2 takes its
    ``[.!?]`` away, 3 repeats it, 4 makes its role user. Nulls are one space.
    """

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = (F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20).cast("int")
    marked = rows.select(
        "conv_id", "turn", known("role").alias("role"), known("text").alias("text"),
        fault.alias("fault"),
    )
    f = F.col("fault")
    copies = F.when(f == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    body = (
        F.when(f == 1, F.lit(""))
        .when(f == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    return marked.withColumn("copy", F.explode(copies)).select(
        "conv_id",
        "turn",
        F.when(f == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        body.alias("text"),
        (f == 0).alias("dropped"),
    )
