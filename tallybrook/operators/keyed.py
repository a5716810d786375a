"""One row per key: first, latest, distinct.

Ranking by ``row_number() = 1`` lets Spark keep a single row per key in every
map task before the shuffle, so a key that holds much of the data costs no more
than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank_in_key"


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)


def first_by_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The lowest row of each key in the order of ``order_by``."""
    return _one_per_key(df, keys, [F.col(c).asc() for c in order_by])


def latest_by_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The highest row of each key in the order of ``order_by``."""
    return _one_per_key(df, keys, [F.col(c).desc() for c in order_by])


def distinct_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key where rows of a key are copies of each other."""
    return df.dropDuplicates(keys)
