"""Which tokens of one tokenizer stand where those of another do, and how often pairs meet.

Two tokenizers cut the same bytes. Where both end a token, a text falls into groups; inside one
the tokens overlap as they may. Texts are handled many at a time as Arrow columns: token lists are
flattened with their parent indices, lengths are summed up within each text to the bytes at which
tokens end, a hash join on text and end finds the common ends, and sums over those number the
groups. Pairs are grouped by text and counted in Arrow, in blocks of texts; Spark adds up what the
blocks counted, and a join by block brings the sums back to the texts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import per_worker, stored
from tallybrook.llm.packing import PRE_TOKEN, Encoder

# Bytes of text whose pairs are numbered together, and that are aligned at once.
BLOCK = 8 << 20
SLICE_BYTES = 1 << 19
# Characters after which a long text may be cut, at a space where both tokenizers begin anew.
SEGMENT = 1 << 17
# Entries (text and pair) of a block after which those of the same text are added up.
_ENTRIES = 1 << 22
_REMEMBERED = 300_000
_LONGEST_REMEMBERED = 48
_SPACE_MARK = "▁"
_CUT = re.compile(r"(?<=\S)(?= \S)")
_B_CUT = re.compile(r"(?<=[^ ])(?= )")
_SEPARATORS = ("", ",", ";", "|")


class PlainEncoder(Encoder):
    """Ids of a byte-level BPE in which special strings are ordinary text."""

    def __init__(self, path: str):
        import tiktoken

        super().__init__(path)
        ranks = {self.library.decode_single_token_bytes(i): i for i in _plain_ids(path)}
        self.vocabulary = [b""] * len(self.after_space)
        for token, i in ranks.items():
            self.vocabulary[i] = token
        self.library = tiktoken.Encoding(
            "plain", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}
        )


def _plain_ids(path: str) -> list[int]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["id"] for t in spec["added_tokens"]}
    return [i for i in spec["model"]["vocab"].values() if i not in special]


class PieceEncoder:
    """Ids of whole texts, as the sentencepiece library gives them for a BPE model.

    No piece goes on over a space, so the pieces of what stands between two spaces, with the
    spaces before it, are the same alone as in its text; they are remembered, up to a number of
    runs. Models for which that does not hold, or that change texts, are refused.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        if any(_SPACE_MARK in p.lstrip(_SPACE_MARK) for p in pieces):
            raise ValueError(f"{path} has pieces that go on over a space")
        probe = " a  \n "
        if "".join(self.library.encode(probe, out_type=str)) != "▁▁a▁▁<0x0A>▁":
            raise ValueError(f"{path} changes white space")
        self.vocabulary = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(_SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        lone = np.array([self.library.piece_to_id(_SPACE_MARK)], "<u4").tobytes()
        self.known: dict[str, bytes] = {"": lone}

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, the space that the model adds included."""
        lists, parts = [], []
        new: dict[str, bytes] = {}
        get = self.known.get
        for text in texts:
            if "  " in text or text[:1] == " ":
                runs = [run[1:] for run in _B_CUT.split(" " + text)]
            else:
                runs = text.split(" ")
            part = list(map(get, runs))
            new.update((run, b"") for run, ids in zip(runs, part, strict=True) if ids is None)
            lists.append(runs)
            parts.append(part)
        unseen = list(new)
        for run, ids in zip(unseen, self.library.encode(unseen, num_threads=1), strict=True):
            new[run] = np.array(ids, "<u4").tobytes()
        out = []
        for runs, part in zip(lists, parts, strict=True):
            out.append(b"".join([new[r] if ids is None else ids for r, ids in zip(runs, part, strict=True)]))
        for run, ids in new.items():
            if len(self.known) < _REMEMBERED and len(run) <= _LONGEST_REMEMBERED:
                self.known[run] = ids
        return out


class Aligner:
    """Two tokenizers, their tokens' bytes, and their ids as text after each separator."""

    def __init__(self, byte_level: str, pieces: str):
        self.encoders = (PlainEncoder(byte_level), PieceEncoder(pieces))
        self.tokens = [pa.array(e.vocabulary, pa.large_binary()) for e in self.encoders]
        self.sizes = [np.array([len(t) for t in e.vocabulary]) for e in self.encoders]
        self.n = max(len(s) for s in self.sizes)
        numbers = [str(i) for i in range(self.n)]
        self.shown = pa.array([s + i for s in _SEPARATORS for i in numbers], pa.large_string())


def segments(text: str, most: int = SEGMENT) -> Iterator[str]:
    """``text`` in parts, each after the first beginning at a space where tokens begin in any case.

    That space is left out. Parts hold about ``most`` characters, more where no such space comes.
    """
    start = 0
    while len(text) - start > most:
        cut = _CUT.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start() + 1
    yield text[start:]


class Slice:
    """Texts (or parts of them) aligned at once; ``parents`` says which text a part is of."""

    def __init__(self, aligner: Aligner, texts: list[str], parents: list[int]):
        self.aligner, self.parents = aligner, np.array(parents)
        given = (" " + t for t in texts)
        lists = [self._lists(e.ids(x)) for e, x in zip(aligner.encoders, ([*given], texts), strict=True)]
        self.good = self._checked(lists, texts)
        if not self.good.all():
            lists = [self._kept(x) for x in lists]
        self.a, self.b = (self._ends(x, k) for k, x in enumerate(lists))

    @staticmethod
    def _lists(ids: list[bytes]) -> pa.LargeListArray:
        sizes = np.array([0, *map(len, ids)]) // 4
        values = pa.array(np.frombuffer(b"".join(ids), "<u4"))
        return pa.LargeListArray.from_arrays(pa.array(np.cumsum(sizes)), values)

    def _checked(self, lists: list[pa.LargeListArray], texts: list[str]) -> np.ndarray:
        """Which parts have the same bytes as their tokens, by either tokenizer."""
        whole = [b" " + t.encode() for t in texts]
        joined = b"".join(whole)
        good = np.ones(len(texts), bool)
        for tokens, x in zip(self.aligner.tokens, lists, strict=True):
            taken = tokens.take(pc.list_flatten(x))
            if _data(taken) != joined:
                starts = np.frombuffer(taken.buffers()[1], np.int64)[x.offsets.to_numpy()]
                data = _data(taken)
                good &= [data[a:b] == w for a, b, w in zip(starts, starts[1:], whole, strict=False)]
        return good

    def _kept(self, x: pa.LargeListArray) -> pa.LargeListArray:
        sizes = np.where(self.good, pc.list_value_length(x).to_numpy(), 0)
        values = pc.list_flatten(x).filter(pa.array(self.good[pc.list_parent_indices(x).to_numpy()]))
        return pa.LargeListArray.from_arrays(pa.array(np.cumsum([0, *sizes])), values)

    def _ends(self, x: pa.LargeListArray, k: int) -> pa.Table:
        """One row per token: its part, its id, and the byte at which it ends in its part."""
        part, ids = pc.list_parent_indices(x), pc.list_flatten(x)
        total = np.cumsum(self.aligner.sizes[k][ids.to_numpy()])
        before = np.concatenate([[0], total])[x.offsets.to_numpy()]
        end = total - before[part.to_numpy()]
        return pa.table({"part": part, "end": end, "id": ids, "at": np.arange(len(ids))})

    def _cuts(self) -> tuple[np.ndarray, np.ndarray]:
        """Flags on the tokens of either side that end where one of the other side does."""
        a, b = (
            pa.table({"key": pc.add(pc.shift_left(t["part"], 40), t["end"]), "at": t["at"]})
            for t in (self.a, self.b)
        )
        common = a.join(b, "key", join_type="inner", right_suffix="_b", use_threads=False)
        flags = np.zeros(self.a.num_rows, bool), np.zeros(self.b.num_rows, bool)
        flags[0][common["at"].to_numpy()] = True
        flags[1][common["at_b"].to_numpy()] = True
        return flags

    def aligned(self) -> tuple[dict[str, np.ndarray], pa.Table, list[memoryview]]:
        """Counts per part; how often each text has each pair; the groups of each part as text."""
        n = len(self.parents)
        part_a, part_b = (t["part"].to_numpy() for t in (self.a, self.b))
        id_a, id_b = (t["id"].to_numpy().astype(np.int64) for t in (self.a, self.b))
        cut_a, cut_b = self._cuts()
        group_a, group_b = (np.cumsum(c) - c for c in (cut_a, cut_b))
        # Ends counted through all parts: between two of them lies one pair.
        far = np.concatenate([[0], np.cumsum(np.bincount(part_a, self._sizes(self.a), n))])
        ends_a, ends_b = (
            (t["end"].to_numpy() + far[p]).astype(np.int64)
            for t, p in ((self.a, part_a), (self.b, part_b))
        )
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # two sorted runs
        ends = ends[np.diff(ends, prepend=-1) != 0]
        of_a, of_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        links = pa.table({"text": self.parents[part_a[of_a]], "pair": id_a[of_a] << 32 | id_b[of_b]})
        counted = links.group_by(["text", "pair"], use_threads=False).aggregate([([], "count_all")])
        counts = {
            "n_a": np.bincount(part_a, minlength=n),
            "n_b": np.bincount(part_b, minlength=n),
            "n_groups": np.bincount(part_a[cut_a], minlength=n),
            "n_links": np.bincount(part_a[of_a], minlength=n),
        }
        return counts, counted, self._shown(id_a, id_b, part_a, group_a, group_b, counts)

    @staticmethod
    def _sizes(tokens: pa.Table) -> np.ndarray:
        """Bytes of each token: its end less the one before it in its part."""
        end, part = tokens["end"].to_numpy(), tokens["part"].to_numpy()
        size = np.diff(end, prepend=0)
        new = np.diff(part, prepend=-1) != 0
        size[new] = end[new]
        return size

    def _shown(self, id_a, id_b, part_a, group_a, group_b, counts) -> list[memoryview]:
        """``a1,a2|b1;a3|b2,b3`` of each part: every group's tokens of one side, then of the other."""
        groups = int(group_a[-1]) + 1 if len(group_a) else 0
        in_a, in_b = (np.bincount(g, minlength=groups) for g in (group_a, group_b))
        after_a, after_b = np.cumsum(in_a), np.cumsum(in_b)
        at_a = np.arange(len(id_a)) + (after_b - in_b)[group_a]
        at_b = np.arange(len(id_b)) + after_a[group_b]
        kind_a = np.where(np.diff(group_a, prepend=-1) != 0, 2, 1)
        kind_a[np.diff(part_a, prepend=-1) != 0] = 0
        kind_b = np.where(np.diff(group_b, prepend=-1) != 0, 3, 1)
        codes = np.empty(len(id_a) + len(id_b), np.int64)
        codes[at_a] = kind_a * self.aligner.n + id_a
        codes[at_b] = kind_b * self.aligner.n + id_b
        shown = self.aligner.shown.take(pa.array(codes))
        starts = np.frombuffer(shown.buffers()[1], np.int64, len(codes) + 1)
        ends = starts[np.cumsum([0, *(counts["n_a"] + counts["n_b"])])]
        data = memoryview(_data(shown))
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _data(values: pa.Array) -> bytes:
    """All values of a text or binary array, one after another."""
    buffer = values.buffers()[2]
    return b"" if buffer is None else buffer.to_pybytes()


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up in bytes; 255 says that more of the number follows."""
    more = values // 255
    out = np.full(int(more.sum()) + len(values), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = values % 255
    return out.tobytes()


def spread(data: bytes) -> np.ndarray:
    """The numbers that ``squeezed`` made ``data`` of."""
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    return np.diff(np.cumsum(raw)[raw != 255], prepend=0)


class Block:
    """Texts whose pairs are numbered together."""

    def __init__(self, keep_groups: bool):
        self.ids: list[pa.Array] = []
        self.size = self.n = 0
        self.counts: dict[str, list[int]] = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links")}
        self.digests: list = []
        self.groups: list[list[bytes]] | None = [] if keep_groups else None
        self.good: list[bool] = []
        self.entries: list[pa.Table] = []

    def new_text(self) -> int:
        for c in self.counts.values():
            c.append(0)
        self.digests.append(None)
        self.good.append(True)
        if self.groups is not None:
            self.groups.append([])
        self.n += 1
        return self.n - 1

    def add(self, part: Slice) -> None:
        counts, counted, shown = part.aligned()
        for c, values in counts.items():
            own = self.counts[c]
            for text, value in zip(part.parents.tolist(), values.tolist(), strict=True):
                own[text] += value
        for text, good, groups in zip(part.parents.tolist(), part.good.tolist(), shown, strict=True):
            self.good[text] &= good
            if len(groups):
                if self.digests[text] is None:
                    self.digests[text] = hashlib.sha256()
                else:
                    self.digests[text].update(b";")
                    groups = bytes(groups)
                self.digests[text].update(groups)
                if self.groups is not None:
                    self.groups[text].append(bytes(groups))
        self.entries.append(counted)
        if sum(t.num_rows for t in self.entries) > _ENTRIES:
            self.entries = [self._merged()]

    def _merged(self) -> pa.Table:
        every = pa.concat_tables(self.entries)
        if len(self.entries) == 1:
            return every
        added = every.group_by(["text", "pair"], use_threads=False).aggregate([("count_all", "sum")])
        return added.rename_columns(["text", "pair", "count_all"])

    def rows(self, number: int, types: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The pairs of the block with the number of texts that hold each, then its texts."""
        entries = self._merged() if self.entries else None
        good = np.array(self.good)
        if entries is not None and not good.all():
            entries = entries.filter(pa.array(good[entries["text"].to_numpy()]))
        numbers = times = [b""] * self.n
        if entries is not None and entries.num_rows:
            held = entries.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            held = held.sort_by([("count_all", "descending"), ("pair", "ascending")])
            yield _batch(types, held.num_rows, kind="pair", block=number, number=np.arange(held.num_rows),
                         pair=held["pair"], n=held["count_all"])
            of = pc.index_in(entries["pair"], held["pair"].combine_chunks()).to_numpy().astype(np.int64)
            order = np.argsort(entries["text"].to_numpy() * held.num_rows + of)
            of, m = of[order], entries["count_all"].to_numpy()[order]
            ends = np.cumsum(np.bincount(entries["text"].to_numpy(), minlength=self.n))[:-1]
            numbers = [squeezed(np.diff(x, prepend=0)) for x in np.split(of, ends)]
            times = [squeezed(x) for x in np.split(m, ends)]
        digests = [d.hexdigest() if g and d else "" for d, g in zip(self.digests, self.good, strict=True)]
        columns = {c: np.where(good, v, 0) for c, v in self.counts.items()}
        if self.groups is not None:
            columns["groups"] = [
                b";".join(x).decode() if g else "" for x, g in zip(self.groups, self.good, strict=True)
            ]
        yield _batch(types, self.n, kind="text", block=number, id=pa.concat_arrays(self.ids),
                     digest=digests, numbers=numbers, times=times, **columns)


def _batch(types: pa.Schema, rows: int, /, **columns) -> pa.RecordBatch:
    """Columns by name; single values are repeated, absent ones null."""
    out = []
    for f in types:
        value = columns.get(f.name)
        if value is None:
            out.append(pa.nulls(rows, f.type))
        elif isinstance(value, str | int):
            out.append(pa.repeat(pa.scalar(value, f.type), rows))
        elif isinstance(value, pa.ChunkedArray):
            out.append(value.combine_chunks().cast(f.type))
        else:
            out.append(value.cast(f.type) if isinstance(value, pa.Array) else pa.array(value, f.type))
    return pa.RecordBatch.from_arrays(out, schema=types)


def blocks(
    docs: DataFrame, byte_level: str, pieces: str, id_column: str, text: str, keep_groups: bool, block_bytes: int
) -> DataFrame:
    """Texts and pairs of every block, by ``kind``."""
    id_kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"kind string, block long, number int, pair long, n long, id {id_kind}, n_a long, n_b long, "
        "n_groups long, n_links long, digest string, groups string, numbers binary, times binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(Aligner, byte_level, pieces)
        order = count(TaskContext.get().partitionId() << 32)
        block, types = Block(keep_groups), None
        waiting: tuple[list[str], list[int]] = ([], [])
        size = 0

        def flush() -> None:
            if waiting[0]:
                block.add(Slice(aligner, *waiting))
                waiting[0].clear()
                waiting[1].clear()

        for batch in batches:
            ids = batch.column(0)
            if types is None:
                types = pa.schema(
                    [("kind", pa.string()), ("block", pa.int64()), ("number", pa.int32()), ("pair", pa.int64()),
                     ("n", pa.int64()), ("id", ids.type), *((c, pa.int64()) for c in block.counts),
                     ("digest", pa.string()), ("groups", pa.string()), ("numbers", pa.binary()),
                     ("times", pa.binary())]
                )
            begin = 0
            for i, value in enumerate(batch.column(1)):
                whole = value.as_py()
                at = block.new_text()
                if not whole:
                    continue
                for part in segments(whole):
                    waiting[0].append(part)
                    waiting[1].append(at)
                    size += len(part)
                    block.size += len(part)
                    if size >= SLICE_BYTES:
                        flush()
                        size = 0
                if block.size >= block_bytes:
                    flush()
                    block.ids.append(ids.slice(begin, i + 1 - begin))
                    yield from block.rows(next(order), types)
                    block, begin, size = Block(keep_groups), i + 1, 0
            if begin < batch.num_rows:
                block.ids.append(ids.slice(begin))
        flush()
        if block.n:
            yield from block.rows(next(order), types)

    return docs.select(F.col(f"`{id_column}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, n, best``: how many texts hold each pair, and whether none of its first id has more.

    Blocks have counted their own texts, sums are taken in each map task first, and an id has no
    more pairs than the other vocabulary has tokens.
    """
    summed = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(F.shiftright("pair", 32))
    return summed.withColumn("best", F.max("n").over(own) == F.col("n"))


def aligned(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    id_column: str = "doc_id",
    text: str = "text",
    keep_groups: bool = False,
    block_bytes: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """How the tokens of every text line up, and the counts of all pairs.

    ``byte_level`` is a tokenizers file and ``pieces`` a sentencepiece model, as paths that every
    executor has. The first result has, per row of ``docs``: ``id_column, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256`` and, if ``keep_groups``, ``groups``, the text that
    was hashed. The second has ``a, b, n, best``: an id of either vocabulary, the number of texts
    in which they are linked, and whether that is the most for ``a``.

    Texts that are null or empty, or that tokens don't give back byte for byte, have zeros and an
    empty digest. Repeated rows count as often as they are there, extra columns are ignored, no
    rows give no rows. A long text is aligned in parts, so memory follows its distinct pairs.
    """
    id_kind = docs.schema[id_column].dataType.simpleString()
    table = stored(
        blocks(docs, byte_level, pieces, id_column, text, keep_groups, block_bytes), "aligned", ["kind"]
    )
    pairs = table.where("kind = 'pair'").select("block", "number", "pair", "n")
    counts = stored(pair_counts(pairs), "pairs")
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    texts = table.where("kind = 'text'").select(
        "block", "id", *numbers, "digest", "numbers", "times", *(["groups"] if keep_groups else [])
    )
    # A pair that many blocks hold is split by adaptive execution: its rows need no common task.
    held = pairs.select(F.col("block").alias("in_block"), "number", "pair")
    known = held.join(counts, "pair").select("in_block", "number", "n", "best")
    names = [id_column, *numbers, "n_best", "count_sum", "groups_sha256", *(["groups"] if keep_groups else [])]

    def run(block: pa.Table, counts: pa.Table) -> pa.Table:
        n = np.zeros(counts.num_rows, np.int64)
        best = np.zeros(counts.num_rows, np.int64)
        at = counts["number"].to_numpy()
        n[at], best[at] = counts["n"].to_numpy(), counts["best"].to_numpy()
        sums = []
        for own, often in zip(block["numbers"].to_pylist(), block["times"].to_pylist(), strict=True):
            own, often = np.cumsum(spread(own)), spread(often)
            sums.append((int(best[own] @ often), int(n[own] @ often)))
        columns = [block["id"], *(block[c] for c in numbers)]
        columns += [pa.array([s[k] for s in sums], pa.int64()) for k in range(2)]
        columns += [block["digest"], *([block["groups"]] if keep_groups else [])]
        return pa.Table.from_arrays(columns, names)

    schema = f"`{id_column}` {id_kind}, " + ", ".join(f"{c} long" for c in names[1:7]) + ", groups_sha256 string"
    schema += ", groups string" if keep_groups else ""
    found = texts.groupBy("block").cogroup(known.groupBy("in_block")).applyInArrow(run, schema)
    table_of_pairs = counts.select(
        F.shiftright("pair", 32).cast("int").alias("a"),
        F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"),
        "n",
        "best",
    )
    return found, table_of_pairs
