"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into segments with an index each. If two codes differ in at most ``m * (r + 1) - 1``
bits, one of their ``m`` segments differs in at most ``r``. A search therefore looks up all segment
values within 0, 1, 2 ... bits of its own, verifies the codes found there, and ends when its kth
distance is covered by that bound.

Equal codes are one entry with the smallest ids that could be wanted. Entries are dealt into shards
and queries into blocks; every block meets every shard once, and of each meeting only k entries a
query come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import slices, stored

K = 10
SHARD, BLOCK = 100_000, 2_000
WIDEST = 16


def codes(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id, code``: one bit per dimension, set where the value is above zero, as bytes.

    Null vectors have no code and are left out; null values count as zero.
    """
    kind = rows.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            found = [
                None if v is None else np.packbits([(x or 0) > 0 for x in v]).tobytes()
                for v in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], ["id", "code"]
            )

    plain = rows.select(F.col(f"`{id_column}`"), F.col(f"`{vector}`"))
    return plain.mapInArrow(run, f"id {kind}, code binary").where("code is not null")


class Index:
    """Codes (rows of bytes) by the values of their segments."""

    def __init__(self, bits: np.ndarray):
        self.packed = bits
        n_bits = bits.shape[1] * 8
        width = int(np.clip(round(np.log2(max(2, len(bits)))), 4, WIDEST))
        self.segments = np.array_split(np.arange(n_bits), max(1, round(n_bits / width)))
        self.flips: dict[tuple[int, int], np.ndarray] = {}
        self.by_value = []
        for values, seg in zip(self.values(bits), self.segments, strict=True):
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << len(seg)) + 1))
            self.by_value.append((order, starts))

    def _flips(self, width: int, n: int) -> np.ndarray:
        """All values of ``width`` bits with ``n`` bits set."""
        if (width, n) not in self.flips:
            values = [sum(1 << b for b in chosen) for chosen in combinations(range(width), n)]
            self.flips[width, n] = np.array(values, np.int64)
        return self.flips[width, n]

    def values(self, packed: np.ndarray) -> list[np.ndarray]:
        """The segments of codes as numbers."""
        bits = np.unpackbits(packed, axis=1)
        return [bits[:, s] @ (1 << np.arange(len(s) - 1, -1, -1)) for s in self.segments]

    def nearest(self, code: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries and distances up to that of the kth row; ``wanted`` is how many rows an entry has.

        All entries at the last distance are among them, so that ties can be settled by id.
        """
        own = [int(v[0]) for v in self.values(code[None, :])]
        seen = np.zeros(len(self.packed), bool)
        rows = np.zeros(self.packed.shape[1] * 8 + 1, np.int64)
        found, apart, m = [], [], len(self.segments)
        for r in range(max(map(len, self.segments)) + 1):
            for value, seg, (order, starts) in zip(own, self.segments, self.by_value, strict=True):
                if r > len(seg):
                    continue
                at = value ^ self._flips(len(seg), r)
                begin, size = starts[at], starts[at + 1] - starts[at]
                some = size > 0
                begin, size = begin[some], size[some]
                if not len(begin):
                    continue
                steps = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                entries = order[np.repeat(begin, size) + steps]
                entries = entries[~seen[entries]]
                seen[entries] = True
                distance = np.bitwise_count(self.packed[entries] ^ code).sum(axis=1, dtype=np.int64)
                np.add.at(rows, distance, wanted[entries])
                found.append(entries)
                apart.append(distance)
            within = np.cumsum(rows)
            kth = int(np.searchsorted(within, k))
            if kth <= m * (r + 1) - 1:
                break
        entries, distance = np.concatenate(found), np.concatenate(apart)
        near = distance <= kth
        return entries[near], distance[near]


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    id_column: str,
    vector: str,
    k: int = K,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, neighbor_id, distance``: the ``k`` rows nearest to each query, itself not.

    Distances are numbers of differing bits; ties go to the smaller id. Fewer rows than ``k`` give
    what there is, rows and queries without a vector give and are given nothing. Rows repeated under
    one id count as one; null ids are left out. All vectors have the same length.
    """
    every = stored(codes(rows, id_column, vector).where("id is not null").distinct(), "codes")
    asked = stored(codes(queries, id_column, vector).where("id is not null").distinct(), "queries")
    first = Window.partitionBy("code").orderBy("id")
    # One id more than k, since a query is not its own neighbour.
    entries = (
        every.withColumn("turn", F.row_number().over(first))
        .where(F.col("turn") <= k + 1)
        .groupBy("code")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )
    entries = stored(entries, "entries")
    wanted = asked.select("code").distinct()
    shards, blocks = -(-entries.count() // shard) or 1, -(-wanted.count() // block) or 1
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("code"), F.lit(n)).cast("int")
    index = entries.select(dealt(shards).alias("shard"), spread(blocks).alias("block"), "code", "ids")
    search = wanted.select(spread(shards).alias("shard"), dealt(blocks).alias("block"), "code")
    kind = every.schema["id"].dataType.simpleString()

    def run(own: pd.DataFrame, sought: pd.DataFrame) -> pd.DataFrame:
        out = {"code": [], "neighbor_id": [], "distance": []}
        if len(own) and len(sought):
            table = Index(np.frombuffer(b"".join(own["code"]), np.uint8).reshape(len(own), -1))
            size = own["ids"].map(len).to_numpy()
            for code in sought["code"]:
                at, apart = table.nearest(np.frombuffer(code, np.uint8), size, k + 1)
                pairs = sorted((d, i) for e, d in zip(at.tolist(), apart.tolist(), strict=True) for i in own["ids"].iat[e])
                for d, i in pairs[: k + 1]:
                    out["code"].append(code)
                    out["neighbor_id"].append(i)
                    out["distance"].append(d)
        return pd.DataFrame(out).astype({"distance": "int32"})

    schema = f"code binary, neighbor_id {kind}, distance int"
    near = (
        index.groupBy("shard", "block")
        .cogroup(search.groupBy("shard", "block"))
        .applyInPandas(run, schema)
    )
    best = Window.partitionBy("code").orderBy("distance", "neighbor_id")
    near = near.withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= k + 1)
    lists = near.groupBy("code").agg(
        F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))).alias("near")
    )
    others = F.slice(F.filter("near", lambda n: n["neighbor_id"] != F.col("id")), 1, k)
    return (
        asked.join(lists, "code")
        .select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "found"))
        .select(
            "query_id",
            (F.col("at") + 1).alias("rank"),
            F.col("found.neighbor_id").alias("neighbor_id"),
            F.col("found.distance").alias("distance"),
        )
    )
