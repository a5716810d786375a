"""A hidden Markov language model: Baum-Welch over partitions, exact scores by forward recursion.

A state emits one of a fixed number of word classes, and the class its word. Classes are hashes
of words, so what the states learn has a fixed size and can be sent to every task, while the
vocabulary, which grows with the corpus, is only ever joined. Within a class a word has its share
of the class's training tokens. One more class is the end of a text and one stands for all words
never seen in training; its probability is that of a word seen once, the share that such words
have in the training tokens.

The corpus is encoded once, in blocks of texts with a word list of their own. Counts of words are
summed over the lists and go back to their blocks. Each round of training reads the blocks, adds
up expected counts per task, and sums these over tasks. Training cuts texts into passages, all of
them used; scores run over whole texts.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import stored

STATES = 8
CLASSES = 1 << 16
ROUNDS = 4
# Bytes of text in a block (one text more may make it larger) and tokens of a training passage.
BLOCK = 4 << 20
PASSAGE = 512
# Tokens in one step of the recursions, and the share of the overall word rates in each state.
STEP = 300_000
SMOOTHING = 0.05
FOLDS, HELD_OUT = 7, 2


def held_out(id_column: str) -> Column:
    """Whether a row is not learned from: by the CRC-32 of its id as text; never for a null id."""
    fold = F.crc32(F.col(f"`{id_column}`").cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def word_class(word: bytes, classes: int = CLASSES) -> int:
    return zlib.crc32(word) % classes


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def encoded(docs: DataFrame, id_column: str, text: str, classes: int, block_bytes: int) -> DataFrame:
    """Blocks and their words, by ``kind``.

    ``block``: ids, held-out flags and lengths of the texts, their tokens as numbers in the
    block's word list, and the class of each word. ``word``: one row per word of a block, with its
    number and how often training texts of the block have it. Numbers run by first use.
    """
    id_kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"kind string, block long, number int, word binary, n long, ids array<{id_kind}>, "
        "held array<boolean>, lengths array<int>, tokens binary, classes binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = count(TaskContext.get().partitionId() << 32)
        types = None

        def flushed() -> Iterator[pa.RecordBatch]:
            number, words = next(blocks), list(numbers)
            tokens = np.concatenate([np.array(t, np.int32) for t in lists])
            lengths = np.array([len(t) for t in lists], np.int32)
            learned = np.repeat(~np.array(held), lengths)
            n = np.bincount(tokens[learned], minlength=len(words))
            of = np.array([word_class(w, classes) for w in words], np.uint32)
            rows = {
                "kind": ["word"] * len(words),
                "block": [number] * len(words),
                "number": range(len(words)),
                "word": words,
                "n": n,
            }
            arrays = [pa.array(rows[f.name], f.type) if f.name in rows else pa.nulls(len(words), f.type) for f in types]
            yield pa.RecordBatch.from_arrays(arrays, schema=types)
            row = {
                "kind": "block",
                "block": number,
                "ids": pa.concat_arrays(ids),
                "held": held,
                "lengths": lengths,
                "tokens": _packed(tokens),
                "classes": _packed(of),
            }
            arrays = []
            for f in types:
                if f.name == "ids":
                    ends = pa.array([0, len(row["ids"])], pa.int32())
                    arrays.append(pa.ListArray.from_arrays(ends, row["ids"]))
                else:
                    arrays.append(pa.array([row.get(f.name)], f.type))
            yield pa.RecordBatch.from_arrays(arrays, names=types.names)

        ids, held, lists, numbers, size = [], [], [], defaultdict(count().__next__), 0
        for batch in batches:
            id_values = batch.column(0)
            types = pa.schema(
                [
                    ("kind", pa.string()), ("block", pa.int64()), ("number", pa.int32()),
                    ("word", pa.binary()), ("n", pa.int64()), ("ids", pa.list_(id_values.type)),
                    ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())),
                    ("tokens", pa.binary()), ("classes", pa.binary()),
                ]
            )
            begin = 0
            for i in range(batch.num_rows):
                raw = (batch.column(1)[i].as_py() or "").encode().lower()
                lists.append(np.fromiter(map(numbers.__getitem__, raw.split()), np.int32))
                held.append(batch.column(2)[i].as_py())
                size += len(raw)
                if size >= block_bytes:
                    ids.append(id_values.slice(begin, i + 1 - begin))
                    yield from flushed()
                    begin = i + 1
                    ids, held, lists, numbers, size = [], [], [], defaultdict(count().__next__), 0
            ids.append(id_values.slice(begin))
        if lists:
            yield from flushed()

    rows = docs.select(F.col(f"`{id_column}`"), F.col(f"`{text}`"), held_out(id_column))
    return rows.mapInArrow(run, schema)


class Model(NamedTuple):
    """Probabilities: of states at the start and after each state, of classes in each state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Totals(NamedTuple):
    """Of the training texts: tokens and distinct words (ends included), words seen once, texts."""

    tokens: int
    words: int
    once: int
    texts: int

    @property
    def unseen(self) -> float:
        """Probability that a token is a word not seen in training."""
        return (self.once + 1) / (self.tokens + self.once + 1)


def _first_model(rates: np.ndarray, states: int) -> Model:
    """Even chances to start, mostly staying, and classes near their rates, a little apart."""
    apart = np.random.default_rng(0).uniform(0.5, 1.5, (states, len(rates)))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, _emissions(apart * rates, rates, 0.0))


def _emissions(counts: np.ndarray, rates: np.ndarray, unseen: float) -> np.ndarray:
    """Class probabilities per state, smoothed by the overall rates; the last class is unseen words."""
    own = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300)
    out = (1 - unseen) * ((1 - SMOOTHING) * own + SMOOTHING * rates)
    out[:, -1] = unseen
    return out


def _runs(lengths: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of lengths sorted downwards, each of about ``most`` tokens or one long text."""
    start = 0
    while start < len(lengths):
        n = max(1, int(most // max(1, lengths[start])))
        yield slice(start, min(start + n, len(lengths)))
        start += n


def expected(model: Model, classes: np.ndarray, lengths: np.ndarray, sums: Model) -> float:
    """Add the expected counts of the passages (one after another in ``classes``) to ``sums``.

    Returns the natural log likelihood. Passages of like length go through the scaled
    recursions together, one column each.
    """
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    start, move, emit = (x.astype(np.float32) for x in model)
    moves = np.zeros(move.shape)
    total = 0.0
    for part in _runs(lengths, STEP):
        at, size = begins[part], lengths[part]
        active = [int(m) for m in np.searchsorted(-size, -np.arange(size[0]), "left")]
        seen = [classes[at[:m] + t] for t, m in enumerate(active)]
        alphas, scales, rates = [], [], []
        for t, m in enumerate(active):
            rate = emit[:, seen[t]]
            alpha = (move.T @ alphas[-1][:, :m] if t else start[:, None]) * rate
            scale = alpha.sum(axis=0)
            alphas.append(alpha / scale)
            scales.append(scale)
            rates.append(rate)
            total += float(np.log(scale).sum(dtype=np.float64))
        beta = None
        for t in range(len(active) - 1, -1, -1):
            now = np.ones((len(start), active[t]), np.float32)
            if beta is not None:
                later = rates[t + 1] * beta / scales[t + 1]
                now[:, : active[t + 1]] = move @ later
                moves += alphas[t][:, : active[t + 1]] @ later.T
            beta = now
            alphas[t] *= beta
        sums.start[:] += alphas[0].sum(axis=1, dtype=np.float64)
        where, weight = np.concatenate(seen), np.concatenate(alphas, axis=1)
        for k, row in enumerate(weight):
            sums.emit[k] += np.bincount(where, row, sums.emit.shape[1])
    sums.move[:] += moves * model.move
    return total


def log10_forward(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The log10 probability of each whole text, by the scaled forward recursion."""
    order = np.argsort(-lengths, kind="stable")
    begins, out = (np.cumsum(lengths) - lengths)[order], np.zeros(len(lengths))
    sizes = lengths[order]
    for part in _runs(sizes, STEP):
        at, size, alpha = begins[part], sizes[part], None
        scores = np.zeros(len(size))
        active = np.searchsorted(-size, -np.arange(size[0]), "left").tolist()
        for t, m in enumerate(active):
            rate = model.emit[:, classes[at[:m] + t]]
            alpha = (model.start[:, None] if alpha is None else model.move.T @ alpha[:, :m]) * rate
            scale = alpha.sum(axis=0)
            alpha /= scale
            scores[:m] += np.log10(scale)
        out[order[part]] = scores
    return out


def _with_ends(values: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values with ``end`` after them, and the lengths with it."""
    return np.insert(values, np.cumsum(lengths), end), lengths + 1


def _passages(lengths: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the passages that texts are cut into for training."""
    pieces = -(-lengths // most)
    out = np.full(int(pieces.sum()), most)
    out[np.cumsum(pieces) - 1] = lengths - (pieces - 1) * most
    return out


def round_of(blocks: DataFrame, model: Model, classes: int, passage: int) -> tuple[Model, float]:
    """Expected counts over the training texts of all blocks, and their log likelihood."""
    states = len(model.start)
    sent = blocks.sparkSession.sparkContext.broadcast(tuple(model))
    columns = ", ".join(f"s{k} double" for k in range(states))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, likelihood = Model(*sent.value), 0.0
        sums = Model(*(np.zeros(x.shape) for x in model))
        for batch in batches:
            for held, lengths, tokens, packed in zip(*batch.columns, strict=True):
                learn = ~held.values.to_numpy(zero_copy_only=False)
                lengths = lengths.values.to_numpy().astype(np.int64)
                own = _unpacked(tokens.as_py(), "<i4")[np.repeat(learn, lengths)]
                own = _unpacked(packed.as_py(), "<u4").astype(np.int64)[own]
                own, lengths = _with_ends(own, lengths[learn], classes)
                if len(lengths):
                    likelihood += expected(model, own, _passages(lengths, passage), sums)
        # Rows from -1 down: start, log likelihood, moves; from 0 up: classes.
        rows = np.concatenate([sums.emit, sums.move.T, np.full((states, 1), likelihood), sums.start[:, None]], axis=1)
        keys = np.concatenate([np.arange(classes + 2), -np.arange(states + 2, 0, -1)])
        some = np.flatnonzero(rows.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[some]), *(pa.array(r[some]) for r in rows)],
            ["key", *(f"s{k}" for k in range(states))],
        )

    parts = blocks.select("held", "lengths", "tokens", "classes").mapInArrow(run, f"key long, {columns}")
    summed = parts.groupBy("key").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)])
    found = summed.toArrow()  # at most a row per class and a few more
    rows = np.zeros((states, classes + 2 + states + 2))
    keys = found["key"].to_numpy()
    rows[:, keys] = np.stack([found[f"s{k}"].to_numpy() for k in range(states)])
    sent.unpersist()
    move = rows[:, classes + 2 : classes + 2 + states].T
    return Model(rows[:, -1], move, rows[:, : classes + 2]), float(rows[0, -2])


def trained(blocks: DataFrame, rates: np.ndarray, totals: Totals, states: int, rounds: int, passage: int) -> tuple[Model, list[float]]:
    """The model after some rounds of Baum-Welch, and the log likelihoods before each."""
    model, seen = _first_model(rates, states), []
    for _ in range(rounds if totals.tokens else 0):
        sums, likelihood = round_of(blocks, model, len(rates) - 2, passage)
        seen.append(likelihood)
        move = sums.move + 1.0
        model = Model(
            (sums.start + 1.0) / (sums.start + 1.0).sum(),
            move / move.sum(axis=1, keepdims=True),
            _emissions(sums.emit, rates, 0.0),
        )
        counts = sums.emit
    final = _emissions(counts if seen else model.emit, rates, totals.unseen)
    return model._replace(emit=final), seen


def scored(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
    classes: int = CLASSES,
    block_bytes: int = BLOCK,
    passage: int = PASSAGE,
) -> DataFrame:
    """Scores of every text by a model trained on those not held out.

    Columns: ``id_column, held_out, n_tokens, n_known, train_tokens, base_score, score``. Tokens
    are the words (lower-cased A-Z) and one end; ``n_known`` counts those seen in training. Scores
    are log10 probabilities: ``base_score`` by single word counts plus one, ``score`` by the hidden
    Markov model. Null texts are empty ones, rows with a null id are learned from, repeated rows
    count each time, extra columns are ignored, and no rows give no rows.
    """
    table = stored(encoded(docs, id_column, text, classes, block_bytes), "encoded", ["kind"])
    blocks = table.where("kind = 'block'").select("block", "ids", "held", "lengths", "tokens", "classes")
    words = table.where("kind = 'word'").select("block", "number", "word", "n")
    same = Window.partitionBy("word")
    counted = stored(
        words.select(
            "block",
            "number",
            F.sum("n").over(same).alias("c"),
            (F.row_number().over(same.orderBy("block")) == 1).alias("first"),
            F.col("word"),
        ).select(
            "block",
            "number",
            "c",
            F.when(F.col("first"), (F.crc32("word") % classes).cast("int")).alias("class"),
        ),
        "counted",
    )
    by_class = counted.where("class is not null and c > 0").groupBy("class").agg(
        F.sum("c").alias("c"), F.count("*").alias("words"), F.count(F.when(F.col("c") == 1, 1)).alias("once")
    ).toArrow()  # at most a row per class
    texts = blocks.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    rates = np.zeros(classes + 2)
    rates[by_class["class"].to_numpy()] = by_class["c"].to_numpy()
    rates[classes] = texts
    totals = Totals(
        int(rates.sum()),
        sum(by_class["words"].to_pylist()) + (texts > 0),
        sum(by_class["once"].to_pylist()) + (texts == 1),
        texts,
    )
    in_class = rates.copy()
    model, _ = trained(blocks, rates / max(1.0, rates.sum()), totals, states, rounds, passage)
    sent = docs.sparkSession.sparkContext.broadcast((*model, in_class))
    id_kind = docs.schema[id_column].dataType.simpleString()
    names = [id_column, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(block: pa.Table, counts: pa.Table) -> pa.Table:
        *parts, in_class = sent.value
        model = Model(*parts)
        known = np.zeros(counts.num_rows + 1, np.int64)
        known[counts["number"].to_numpy()] = counts["c"].to_numpy()
        known[-1] = totals.texts
        of = np.append(_unpacked(block["classes"][0].as_py(), "<u4").astype(np.int64), classes)
        of[known == 0] = classes + 1
        inside = np.zeros(len(known))
        inside[known > 0] = np.log10(known[known > 0] / in_class[of[known > 0]])
        base = np.log10((known + 1) / (totals.tokens + totals.words + 1))
        lengths = block["lengths"][0].values.to_numpy().astype(np.int64)
        tokens = _unpacked(block["tokens"][0].as_py(), "<i4")
        tokens, lengths = _with_ends(tokens, lengths, len(known) - 1)
        begins = np.cumsum(lengths) - lengths
        score = log10_forward(model, of[tokens], lengths) + np.add.reduceat(inside[tokens], begins)
        ids = block["ids"].chunk(0).values
        values = [
            ids,
            block["held"].chunk(0).values,
            pa.array(lengths),
            pa.array(np.add.reduceat((known > 0)[tokens].astype(np.int64), begins)),
            pa.array(np.full(len(lengths), totals.tokens)),
            pa.array(np.add.reduceat(base[tokens], begins)),
            pa.array(score),
        ]
        return pa.Table.from_arrays(values, names)

    schema = (
        f"`{id_column}` {id_kind}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double"
    )
    whole = blocks.select("block", "ids", "held", "lengths", "tokens", "classes").groupBy("block")
    return whole.cogroup(counted.select("block", "number", "c").groupBy("block")).applyInArrow(run, schema)
