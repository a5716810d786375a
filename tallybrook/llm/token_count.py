"""Token counts by a compiled finite-state transducer.

A BPE encoding is settled from left to right by one rule: of all tokens that end at a place,
exactly one continues the encoding of what stands before it, namely the one whose first place
has a last token that it may follow (two tokens may follow each other if BPE keeps them apart
when it encodes both together). What decides the next step is therefore bounded: the longest
stretch of text that can still grow into a token, and for each place in it the last token and
how many tokens fewer had been emitted by then. These are the states. They are compiled when
first met; each transition carries the number of tokens it emits, which is negative where a
longer token takes the place of several.

White space brings the transducer back to its start whatever came before. A chunk of text thus
maps any state to another in a simple way: what stands before its first white space runs from
the state in which the chunk is entered, and the rest does not depend on it. Such maps compose
associatively, so a text's chunks are mapped apart and joined by a prefix scan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybrook.llm.common import per_worker, slices, texts_of

CHUNK = 1 << 16
LIMIT = 2048
# How a word-level BPE of this kind cuts lower-case text; white space is dropped.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"
_START = 0
# What is remembered starts anew beyond these; results don't depend on it.
_STATES = 150_000
_PIECES = 300_000
_LONGEST_REMEMBERED = 64


def _characters() -> list[str]:
    """The character that each byte is written as in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [chr(b) for b in range(256)]
    for i, b in enumerate(b for b in range(256) if b not in shown):
        out[b] = chr(256 + i)
    return out


class ChunkMap(NamedTuple):
    """What a chunk does to any state: run ``head`` from it, and if ``reset`` add ``count`` and
    go on with ``tail`` as the pending piece; without ``reset`` the pending piece grows by ``head``."""

    head: str
    reset: bool
    count: int
    tail: str


class Transducer:
    """Counts the tokens of texts for a BPE file with word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.cut = re.compile(PRE_TOKEN)
        self.rank = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.tokens: set[tuple[str, ...]] = set()
        self.prefixes: set[tuple[str, ...]] = set()
        for token in model["vocab"]:
            if token not in special:
                symbols = self._symbols(token)
                if self._merged(symbols) == [token]:
                    self.tokens.add(symbols)
                    self.prefixes.update(symbols[:i] for i in range(1, len(symbols)))
        self.character = _characters()
        self.may_follow: dict[tuple, bool] = {}
        self.known: dict[str, int] = {}
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.inner: list[dict[str, tuple[int, int]]] = []
        self.last: list[dict[str, int]] = []
        self._restart()

    def _symbols(self, token: str) -> tuple[str, ...]:
        """A token's characters, the last one with the mark of a word's end if it has it."""
        if token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return (*body[:-1], body[-1] + self.end)
        return tuple(token)

    def _merged(self, symbols: tuple[str, ...]) -> list[str]:
        """The symbols after all merges, lowest rank first, leftmost first."""
        parts = list(symbols)
        while len(parts) > 1:
            pairs = [(self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(pairs)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _restart(self) -> None:
        """Forget all states but the start: nothing can grow, and no token is before it."""
        start = ((), (None,), (0,))
        self.states[:], self.inner[:], self.last[:] = [start], [{}], [{}]
        self.number.clear()
        self.number[start] = _START

    def _add(self, state: tuple) -> int:
        to = self.number[state] = len(self.states)
        self.states.append(state)
        self.inner.append({})
        self.last.append({})
        return to

    def _follows(self, before: tuple | None, token: tuple) -> bool:
        if before is None:
            return True
        found = self.may_follow.get((before, token))
        if found is None:
            if len(self.may_follow) > 4 * _STATES:
                self.may_follow.clear()
            found = self._merged(before + token) == ["".join(before), "".join(token)]
            self.may_follow[before, token] = found
        return found

    def _step(self, state: int, symbol: str) -> tuple[tuple, tuple, int]:
        """The token that ends with ``symbol`` after ``state``, the text it may grow in, tokens emitted."""
        text, lasts, fewer = self.states[state]
        text = (*text, symbol)
        for size in range(len(text), 0, -1):
            token = text[-size:]
            if token in self.tokens and self._follows(lasts[size - 1], token):
                return token, text, 1 - fewer[size - 1]
        raise ValueError(f"the vocabulary cannot write {symbol!r}")

    def _compile(self, state: int, symbol: str) -> tuple[int, int]:
        token, text, emitted = self._step(state, symbol)
        _, lasts, fewer = self.states[state]
        keep = next(n for n in range(len(text), -1, -1) if n == 0 or text[-n:] in self.prefixes)
        new = (
            text[len(text) - keep :],
            (token, *lasts)[: keep + 1],
            (0, *(f + emitted for f in fewer))[: keep + 1],
        )
        to = self.number.get(new)
        if to is None and len(self.states) > _STATES:
            self._restart()
            return self._add(new), emitted
        if to is None:
            to = self._add(new)
        self.inner[state][symbol] = to, emitted
        return to, emitted

    def _word(self, symbols: list[str]) -> int:
        """Tokens emitted along one pre-token, from the start back to it."""
        state, count, inner = _START, 0, self.inner
        for symbol in symbols[:-1]:
            to = inner[state].get(symbol) or self._compile(state, symbol)
            state = to[0]
            count += to[1]
        symbol = symbols[-1] + self.end
        emitted = self.last[state].get(symbol)
        if emitted is None:
            emitted = self.last[state][symbol] = self._step(state, symbol)[2]
        return count + emitted

    def _plain(self, piece: str) -> int:
        """Tokens of a piece without special strings."""
        if piece.isascii() and piece.isprintable():
            words = self.cut.findall(piece.lower())
        else:
            text = self.library.normalizer.normalize_str(piece)
            words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return sum(map(self._word, words))

    def piece(self, piece: str) -> int:
        """Tokens emitted along a piece from the start, and back to it."""
        found = self.known.get(piece)
        if found is None:
            special = self.special.findall(piece) if self.special and "<" in piece else []
            parts = self.special.split(piece) if special else [piece]
            found = len(special) + sum(map(self._plain, parts))
            if len(piece) <= _LONGEST_REMEMBERED and len(self.known) < _PIECES:
                self.known[piece] = found
        return found

    def chunk(self, text: str) -> ChunkMap:
        """The map of a chunk: one pass over its pieces, none of which depends on its entry."""
        pieces = text.replace("\n", " ").split(" ")
        if len(pieces) == 1:
            return ChunkMap(text, False, 0, "")
        counts = list(map(self.known.get, pieces[1:-1]))
        at = -1
        for _ in range(counts.count(None)):
            at = counts.index(None, at + 1)
            counts[at] = self.piece(pieces[at + 1])
        return ChunkMap(pieces[0], True, sum(counts), pieces[-1])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of ``a`` followed by ``b``."""
        if not a.reset:
            return b._replace(head=a.head + b.head)
        if not b.reset:
            return a._replace(tail=a.tail + b.head)
        return ChunkMap(a.head, True, a.count + self.piece(a.tail + b.head) + b.count, b.tail)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text: the maps of its chunks, composed pairwise, from the start."""
        maps = [self.chunk(text[i : i + chunk]) for i in range(0, len(text), chunk)] or [_NOTHING]
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = pairs + maps[len(maps) - len(maps) % 2 :]
        found = maps[0]
        return self.piece(found.head) + (found.count + self.piece(found.tail) if found.reset else 0)


_NOTHING = ChunkMap("", False, 0, "")


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """``id_column, n_bytes, n_tokens, over_limit``, one row per input row.

    ``tokenizer`` is the path of a tokenizers file that every executor has: a byte-level BPE with
    word ends that lower-cases and drops white space. Null texts are empty ones and have no
    tokens; null ids and repeated rows stay, extra columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = per_worker(Transducer, tokenizer)
        for batch in slices(batches):
            texts = texts_of(batch, text)
            counts = np.array([transducer.count(t) for t in texts], np.int64)
            sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts),
                    pa.array(counts > limit),
                ],
                [id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select(id_column, text).mapInArrow(run, schema)
