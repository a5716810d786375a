"""Finding keys with very many rows and treating them apart.

Which keys count as hot only decides the route a row takes; every route gives the
same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.session import work_path

HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys of ``hot_rows`` rows or more; None if there are none.

    ``df`` should be a scan or persisted: it is counted first, which a scan does from file
    footers, and no key of fewer rows in all can be hot. Else this runs one job that reads ``key`` alone and counts all of its rows, in each map task
    first, so that a hot key costs no more than another. The keys found are written to
    the shared folder: they are counted once, and every use sees the same ones.
    """
    spark = df.sparkSession
    if df.count() < hot_rows:
        return None
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    path = work_path(spark, "hot")
    counts.where(F.col("count") >= hot_rows).select(key).write.parquet(path)
    found = spark.read.schema(counts.select(key).schema).parquet(path)
    return None if found.isEmpty() else found


def by_heat(
    df: DataFrame,
    key: str,
    hot: DataFrame | None,
    usual: Callable[[DataFrame], DataFrame],
    heavy: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``usual`` over rows of ordinary keys and ``heavy`` over rows of hot ones.

    How the keys are joined is Spark's choice by their size.
    """
    if hot is None:
        return usual(df)
    return usual(df.join(hot, key, "left_anti")).unionByName(
        heavy(df.join(hot, key, "left_semi"))
    )
