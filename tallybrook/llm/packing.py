"""Sum-of-squares packing of tokenized documents into fixed-length sequences."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import per_worker, slices, stored, texts_of, unused

SEQUENCE = 1024
END_ID = 2
# How a byte-level BPE cuts texts into pre-tokens.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Pieces placed by one task: enough that the bins left open are few beside those filled.
PIECES_PER_TASK = 50_000
_REMEMBERED = 300_000
_LONGEST_REMEMBERED = 48


# A space between two characters that are not white space: pre-tokens begin here.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_SPACE = re.compile(r"[^\S\n]|\s$")


def _sure(text: str) -> bool:
    """Whether every space of the text stands between two characters that are not white space."""
    return (
        text.replace("\n", "").isprintable()
        and "  " not in text
        and " \n" not in text
        and "\n " not in text
        and text[-1:] != " "
    )


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Bytes that print stand for themselves; the others follow from code point 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of whole texts, as the tokenizers library gives them for a byte-level BPE file.

    The file's vocabulary is handed to tiktoken, whose merges by id are the same and several
    times faster. A byte-level pre-token begins at every space that stands between two other
    characters, so what lies between two such spaces has the same ids alone as in its text and
    is remembered, up to a number of runs; frequent ones are seen early.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_of()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(map(byte_of.__getitem__, token)): i
            for token, i in spec["model"]["vocab"].items()
            if token not in special
        }
        self.after_space = np.zeros(max([*ranks.values(), *special.values()]) + 1, bool)
        self.after_space[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.library = tiktoken.Encoding(
            "own", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens=special
        )
        self.known: dict[str, bytes] = {}

    def _alone(self, text: str) -> bytes:
        return np.array(self.library.encode(text, allowed_special="all"), "<u4").tobytes()

    def _learn(self, runs: list[str]) -> list[bytes]:
        """The ids of each run after a space; one call encodes them all in a row."""
        ids = self.library.encode_to_numpy(" " + " ".join(runs), allowed_special="all")
        starts = (4 * np.flatnonzero(self.after_space[ids])).tolist()
        whole = ids.astype("<u4").tobytes()
        return [whole[a:b] for a, b in zip(starts, [*starts[1:], len(whole)], strict=True)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        firsts, rests, parts = [], [], []
        new: dict[str, bytes] = {}
        get = self.known.get
        for text in texts:
            if _sure(text):
                first, *rest = text.split(" ")
            else:
                first, *rest = _CUT.split(text)
                rest = [run[1:] for run in rest]
                for run in rest:  # it may hold spaces, or end in one and run into the next
                    if _SPACE.search(run):
                        new[run] = self._alone(" " + run)
            part = list(map(get, rest))
            at = -1
            for _ in range(part.count(None)):
                at = part.index(None, at + 1)
                new.setdefault(rest[at], b"")
            firsts.append(first)
            rests.append(rest)
            parts.append(part)
        unseen = [run for run, ids in new.items() if not ids]
        if unseen:
            new.update(zip(unseen, self._learn(unseen), strict=True))
        out = []
        for first, rest, part in zip(firsts, rests, parts, strict=True):
            at = -1
            for _ in range(part.count(None)):
                at = part.index(None, at + 1)
                part[at] = new[rest[at]]
            out.append(self._alone(first) + b"".join(part))
        for run, ids in new.items():
            if len(self.known) < _REMEMBERED and len(run) <= _LONGEST_REMEMBERED:
                self.known[run] = ids
        return out


def tokenized(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    carried: list[str] | None = None,
) -> DataFrame:
    """The pieces of every document: ``id_column, piece, start, length, ids``.

    ``ids`` are little-endian unsigned 32-bit token ids; every document ends with ``end_id``,
    and a null text is an empty one. A document of more than ``sequence`` ids is cut into
    pieces of that many, the first one taking the remainder. ``tokenizer`` is the path of a
    tokenizers file that every executor has. Repeated rows give repeated pieces, no rows none.
    Columns ``carried`` stand beside each piece as they were; others are ignored.
    """
    carried = carried or []
    kept = {c: docs.schema[c].dataType.simpleString() for c in [id_column, *carried]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = per_worker(Encoder, tokenizer).ids, np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            at, piece, start, ids = [], [], [], []
            for i, found in enumerate(encode(texts_of(batch, text))):
                whole = found + end
                n = len(whole) // 4
                first = n if n <= sequence else n % sequence or sequence
                cuts = [0, *range(first, n + 1, sequence)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at.append(i)
                    piece.append(k)
                    start.append(a)
                    ids.append(whole[4 * a : 4 * b])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(at, pa.int64())) for c in kept),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                [*kept, "piece", "start", "length", "ids"],
            )

    columns = ", ".join(f"`{c}` {kind}" for c, kind in kept.items())
    schema = f"{columns}, piece int, start long, length long, ids binary"
    return docs.select(*(f"`{c}`" for c in kept), F.col(f"`{text}`").alias(text)).mapInArrow(run, schema)


def place(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each item, placed in the order given.

    An item goes to the open bin for which the sum, over residual gaps, of the squared number
    of open bins with that gap becomes smallest; among equals to the one it fills most. A bin
    is opened only if the item fits none.
    """
    n_open = np.zeros(sequence + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(sequence + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    never = np.iinfo(np.int64).max
    for i, size in enumerate(lengths.tolist()):
        # The change for gaps size .. sequence - 1: one bin fewer of that gap, one more of
        # what is left of it; a bin that gets full is no longer counted.
        change = 2 * (n_open[: sequence - size] - n_open[size:sequence]) + 2
        change[n_open[size:sequence] == 0] = never
        if len(change) and n_open[size]:
            change[0] -= 1
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] < never:
            gap = size + best
            bins[i] = open_bins[gap].pop()
            n_open[gap] -= 1
        else:
            gap = sequence
            bins[i] = made
            made += 1
        offsets[i] = sequence - gap
        if gap > size:
            open_bins[gap - size].append(int(bins[i]))
            n_open[gap - size] += 1
    return bins, offsets


def pack(
    pieces: DataFrame, sequence: int = SEQUENCE, pieces_per_task: int = PIECES_PER_TASK
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: where each one of ``length`` goes.

    Pieces that fill a sequence have it to themselves and are not moved. The others are dealt
    at random into groups of about ``pieces_per_task`` and each group is packed by itself,
    longest pieces first. Columns of ``pieces`` are carried along, so it should be narrow; it
    is stored first, since group numbers must stay as they are when a task runs again.
    """
    row = unused(pieces, "row")
    rows = stored(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    short = rows.where(F.col("length") < sequence)
    groups = max(1, round(short.count() / pieces_per_task))
    given = [f"`{c}`" for c in pieces.columns]
    names = list(pieces.columns)

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", row], ascending=[False, True])
        bins, offsets = place(part["length"].to_numpy(), sequence)
        return part[names].assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    schema = pieces.select(*given, F.lit(0).cast("long").alias("sequence_id")).schema
    packed = (
        short.groupBy(F.pmod(F.xxhash64(row), F.lit(groups)).alias("_group"))
        .applyInPandas(run, schema.add("offset", "long"))
    )
    alone = rows.where(F.col("length") >= sequence).select(
        *given, (-F.col(row) - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(alone)


def pack_in_order(
    pieces: DataFrame, order: list[str], sequence: int = SEQUENCE, pieces_per_task: int = PIECES_PER_TASK
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, packed stretch by stretch of ``order``.

    Pieces are sorted by ``order`` into ranges of about ``pieces_per_task`` and each is packed by
    itself, longest pieces first; the sequences of a range have smaller ids than those of later
    ones. ``order`` should tell all rows apart, so that ranges can be cut anywhere. Pieces are
    stored first, since ranges must stay as they are when a task runs again. No rows give no rows.
    """
    rows = stored(pieces, "pieces")
    ranges = max(1, round(rows.count() / pieces_per_task))
    names, at = list(pieces.columns), unused(pieces, "range")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(b.num_rows for b in parts):
            return
        part = pa.Table.from_batches(parts)
        part = part.take(pc.sort_indices(part, [("length", "descending"), *((c, "ascending") for c in order)]))
        bins, offsets = place(part["length"].to_numpy(), sequence)
        first = part[at][0].as_py() << 32
        out = part.select(names).append_column("sequence_id", pa.array(first + bins, pa.int64()))
        yield from out.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

    placed = pieces.select(*[f"`{c}`" for c in names]).schema.add("sequence_id", "long").add("offset", "long")
    ranged = rows.repartitionByRange(ranges, *[F.col(f"`{c}`") for c in order])
    return ranged.withColumn(at, F.spark_partition_id().cast("long")).mapInArrow(run, placed)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token ids of every sequence, from placed pieces with ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
