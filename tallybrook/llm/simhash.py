"""SimHash near-duplicates over an inverted index of fingerprint bytes.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits differ in at most as
many of their eight bytes, so they share at least ``8 - max_bits`` bytes at the same
places. The index posts each distinct fingerprint under every choice of that many
positions with the bytes found there; a pair meets in a posting list exactly when its
tally of shared positional bytes reaches the guaranteed minimum. Posting single bytes
and counting afterwards gives the same pairs, but lists of one byte hold a 256th of the
corpus each, so the pairs to count would grow with its square.

Members of a posting list differ in the left-out bytes only. Their links are found by
looking up the values one to ``max_bits`` bit flips away, and a list gives one edge per
member at most, to the smallest member it is connected with: no list makes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import slices, stored, texts_of, unused
from tallybrook.llm.components import components

SEED = 42
BYTES = 8
_SHINGLES = 1 << 16


def _bit_sums(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit, the highest bit first."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _SHINGLES):
        part = np.array(hashes[i : i + _SHINGLES], dtype=">u8").view(np.uint8)
        total += np.unpackbits(part.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The text's SimHash, unsigned; zero for a text without words.

    Words are lower-cased (A-Z) runs without ASCII white space. A text of fewer words
    than a shingle has is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(run, SEED) for run in runs]
    bits = _bit_sums(hashes) * 2 > len(hashes)
    return int(np.packbits(bits).view(">u8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3
) -> DataFrame:
    """``id_column`` and ``fp`` (the fingerprint as a signed long), one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([fingerprint(t, shingle) for t in texts_of(batch, text)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(prints.view(np.int64))], [id_column, "fp"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, fp long")


def _near_masks(max_bits: int, free: np.uint64) -> list[np.uint64]:
    """Every set of one to ``max_bits`` bits out of ``free``."""
    places = [np.uint64(1 << i) for i in range(64) if int(free) >> i & 1]
    return [
        np.bitwise_or.reduce(np.array(chosen, np.uint64))
        for n in range(1, max_bits + 1)
        for chosen in combinations(places, n)
    ]


def linked(members: np.ndarray, max_bits: int, free: np.uint64) -> np.ndarray:
    """For sorted distinct members equal outside ``free``: the smallest of their component."""
    label = np.arange(len(members))
    if len(members) <= 64:  # fewer pairs than lookups
        apart = np.bitwise_count(members[:, None] ^ members[None, :])
        pairs = [np.nonzero(apart <= max_bits)]
    else:
        pairs = []
        for mask in _near_masks(max_bits, free):
            found = np.searchsorted(members, other := members ^ mask)
            found[found == len(members)] = 0
            at = np.nonzero(members[found] == other)[0]
            pairs.append((at, found[at]))
    while True:
        before = label.copy()
        for at, to in pairs:
            np.minimum.at(label, at, label[to])
        label = label[label]
        if np.array_equal(before, label):
            return members[label]


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges ``(fp, other)`` between distinct fingerprints that connect all within ``max_bits``.

    ``prints`` has one row per distinct ``fp``. Fingerprints without a near one have no row.
    A posting list holds at most ``256 ** max_bits`` members, since they share all other bytes.
    """
    if not 1 <= max_bits <= 2:
        raise ValueError("max_bits must be 1 or 2")
    frees = []
    for left_out in combinations(range(BYTES), max_bits):
        frees.append(sum(0xFF << (8 * p) for p in left_out))
    signed = [np.array([~f & (1 << 64) - 1], np.uint64).view(np.int64)[0].item() for f in frees]
    postings = prints.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("places"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
                    for i, m in enumerate(signed)
                ]
            )
        ).alias("key"),
    )
    lists = (
        postings.groupBy("key").agg(F.collect_list("fp").alias("members")).where("size(members) > 1")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, members in zip(*batch.columns, strict=True):
                fps = np.sort(members.values.to_numpy().view(np.uint64))
                root = linked(fps, max_bits, np.uint64(frees[places.as_py()]))
                new = fps != root
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps[new].view(np.int64)), pa.array(root[new].view(np.int64))],
                    ["fp", "other"],
                )

    return lists.select("key.places", "members").mapInArrow(run, "fp long, other long").distinct()


def classes(prints: DataFrame, first: str, max_bits: int = 2) -> DataFrame:
    """``(fp, first)``: for every distinct ``fp`` the smallest ``first`` it is connected with."""
    nodes = stored(prints.groupBy("fp").agg(F.min(first).alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits), "fp", "other")
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(smallest, "root").select("fp", F.col("least").alias("first"))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """``id_column``, ``fp`` and ``component_id``, one row per input row.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most
    ``max_bits`` bits, the row's own among them. Null and empty texts have fingerprint zero
    and are linked like any other. Equal fingerprints are one node, so copies cost one row
    each. Null ids are kept; a component of null ids only has a null ``component_id``.
    Repeated rows stay. Other columns are ignored. No rows give no rows.
    """
    prints = stored(fingerprints(docs, id_column, text, shingle), "fingerprints")
    named = classes(prints, id_column, max_bits)
    return prints.join(named, "fp").select(id_column, "fp", F.col("first").alias("component_id"))


def one_per_group(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """One whole row per component: that of its smallest id, with the columns of ``docs``.

    Of rows repeated under one id, one stays; a row with a null id stays only if its
    component has no other id. Extra columns may have any name.
    """
    row, given = unused(docs, "row"), docs.columns
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    prints = fingerprints(rows, row, text, shingle)
    ids = rows.select(
        row, F.struct(F.col(f"`{id_column}`").isNull(), f"`{id_column}`", row).alias("first")
    )
    numbered = stored(prints.join(ids, row), "fingerprints")
    keep = classes(numbered, "first", max_bits).select(F.col(f"first.`{row}`").alias(row)).distinct()
    return rows.join(keep, row, "left_semi").select(*[f"`{c}`" for c in given])
