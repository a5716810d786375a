"""Keys that stay known for a time after each touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_touches(
    rows: DataFrame, key: str, at: str, ttl_ms: int, known: DataFrame, order_by: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows whose key was not known when they came, and what is known after them.

    A key is known for ``ttl_ms`` after each of its rows, at ``at`` (epoch ms); ``known`` is
    ``key, last`` from before and is returned renewed for the keys of ``rows``. Equal times go by
    ``order_by``. Rows without a key or a time are left out.

    Times are first cut into spans of ``ttl_ms``: inside one a key never lapses, so each map task
    reduces a key's rows in a span to the first one and the last time, and only spans are compared.
    """
    columns = [F.col(c) for c in rows.columns]
    place = F.struct(F.col(at), *[F.col(c) for c in order_by or []])
    spans = (
        rows.where(F.col(key).isNotNull() & F.col(at).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.floor(F.col(at) / ttl_ms).alias("_span"))
        .agg(
            F.min_by(F.struct(*columns), place).alias("_first"),
            F.min(at).alias("_from"),
            F.max(at).alias("_to"),
        )
    )
    before = known.select(F.col("key").alias("_known"), F.col("last").alias("_last"))
    joined = spans.join(before, F.col("_key") == F.col("_known"), "left")
    along = Window.partitionBy("_key").orderBy("_span")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    since = F.greatest(F.col("_last"), F.max("_to").over(earlier))
    lapsed = since.isNull() | (F.col("_from") - since > ttl_ms)
    new = joined.withColumn("_new", lapsed).where("_new").select("_first.*")
    after = joined.groupBy(F.col("_key").alias("key")).agg(
        F.greatest(F.max("_last"), F.max("_to")).alias("last")
    )
    return new, after
