"""Sums of allocated amounts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybrook.schemas import SPU_TOTAL, TRADEMARK_TOTAL


def spu_amounts(wide: DataFrame) -> DataFrame:
    """Amount per spu, stamped with its earliest order time."""
    return wide.groupBy("spu_id", "spu_name").agg(
        F.min("create_time").alias("stat_time"),
        F.sum("final_detail_amount").alias("amount"),
    )


def trademark_amounts(wide: DataFrame, stat_time: Column) -> DataFrame:
    """Amount per trademark, rounded to cents once, stamped with ``stat_time``."""
    sums = wide.groupBy("tm_id", "tm_name").agg(
        F.round(F.sum("final_detail_amount"), 2).alias("amount")
    )
    return sums.select(stat_time.alias("stat_time"), "tm_id", "tm_name", "amount")


@dataclass(frozen=True)
class Mart:
    """Sums that can be added to: what names a group, and how two sums of it become one.

    ``schema`` is that of the totals, with the group's ``key`` as text.
    """

    schema: str
    group: tuple[str, ...]
    merge: dict[str, Callable[[str], Column]]

    def keyed(self, sums: DataFrame) -> DataFrame:
        """``sums`` with ``key``; null names make a group of their own."""
        parts = F.array(*[F.col(c).cast("string") for c in self.group])
        return sums.withColumn("key", F.to_json(parts))

    def merged(self, first: DataFrame, *others: DataFrame) -> DataFrame:
        """One row per group of several keyed sums."""
        columns = ["key", *self.group, *self.merge]
        every = first.select(*columns)
        for part in others:
            every = every.unionByName(part.select(*columns))
        sums = every.groupBy("key", *self.group).agg(*[f(c).alias(c) for c, f in self.merge.items()])
        kinds = StructType.fromDDL(self.schema).fields
        return sums.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds])


SPU_MART = Mart(SPU_TOTAL, ("spu_id", "spu_name"), {"stat_time": F.min, "amount": F.sum})
TRADEMARK_MART = Mart(TRADEMARK_TOTAL, ("tm_id", "tm_name"), {"stat_time": F.max, "amount": F.sum})
