"""Running totals within a group, with or without splitting the group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.session import work_path

_CHUNK = "_chunk"
_TIE = "_tie"


def cut_into_ranges(df: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` dealt into ranges of ``group`` and ``order``, with the range's number as ``_chunk``.

    Rows equal in ``order`` may be cut anywhere: a number that is unique settles their
    order, and is returned as its last column. The rows are written to the shared folder,
    because the ranges come from a sample and the numbers from the tasks, and all who use
    them must see the same.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = [*order, _TIE]
    ranges = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(n, group, *full)
        .withColumn(_CHUNK, F.spark_partition_id())
    )
    path = work_path(spark, "ranges")
    ranges.write.parquet(path)
    return spark.read.schema(ranges.schema).parquet(path), full


def running_totals(
    df: DataFrame,
    group: str,
    order: list[str],
    totals: dict[str, Column],
    overall: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running sums, each up to and including the row, and sums over the group."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    all_rows = Window.partitionBy(group)
    return df.withColumns(
        {
            **{name: F.sum(expr).over(w) for name, expr in totals.items()},
            **{name: F.sum(expr).over(all_rows) for name, expr in (overall or {}).items()},
        }
    )


def chunked_running_totals(
    df: DataFrame,
    group: str,
    order: list[str],
    totals: dict[str, Column],
    chunk: Column,
    overall: dict[str, Column] | None = None,
) -> DataFrame:
    """The same sums for groups too large for one task.

    ``chunk`` is not null and never falls as ``order`` rises. Rows are shuffled and
    summed by group and chunk; only one total per chunk is ordered within the group.
    """
    overall = overall or {}
    kept = df.columns
    rows = df.withColumn(_CHUNK, chunk)
    per_chunk = rows.groupBy(group, _CHUNK).agg(
        *[F.sum(expr).alias(name) for name, expr in {**totals, **overall}.items()]
    )
    all_chunks = Window.partitionBy(group)
    earlier = all_chunks.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    before = per_chunk.select(
        F.col(group).alias("_group"),
        F.col(_CHUNK).alias("_at"),
        *[
            F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}")
            for name in totals
        ],
        *[F.sum(name).over(all_chunks).alias(name) for name in overall],
    )
    inside = Window.partitionBy(group, _CHUNK).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = rows.withColumns({n: F.sum(e).over(inside) for n, e in totals.items()})
    joined = sums.join(
        before, (F.col(group) == F.col("_group")) & (F.col(_CHUNK) == F.col("_at"))
    )
    done = [
        (F.col(c) + F.col(f"_before_{c}")).alias(c) if c in totals else F.col(c)
        for c in [*kept, *totals, *overall]
    ]
    return joined.select(*done)
