"""Joining two sides whose sliding windows overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK_SLIDES = 16


def slide_index(ts: Column, slide_seconds: int) -> Column:
    """Number of the slide a TIMESTAMP falls into, counted from the epoch."""
    return F.floor(F.unix_seconds(ts) / F.lit(slide_seconds)).cast("bigint")


def sliding_window_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_slide: str,
    right_slide: str,
    windows: int = 3,
    emits: str | None = "n_emits",
) -> DataFrame:
    """Pairs with equal ``on`` that share at least one sliding window.

    A window spans ``windows`` slides and moves by one, so rows of slides ``a`` and
    ``b`` share ``windows - |a - b|`` windows. Each pair comes out once, with that
    count in ``emits``. ``left`` should be the side with few rows per key; column
    names of the two sides differ except for ``on``.

    The key is joined together with a block of slides: a left row enters the one or
    two blocks its partners can lie in, which keeps it an equi-join and spreads a
    key with very many rows over its blocks.
    """
    reach = windows - 1
    size = max(_BLOCK_SLIDES, 2 * reach)

    def block(slide: Column) -> Column:
        return F.floor(slide / F.lit(size)).cast("bigint")

    lo, hi = block(F.col(left_slide) - reach), block(F.col(left_slide) + reach)
    a = left.withColumn("_block", F.explode(F.array_distinct(F.array(lo, hi))))
    b = right.withColumn("_block", block(F.col(right_slide)))
    gap = F.abs(F.col(left_slide) - F.col(right_slide))
    pairs = a.join(b, [on, "_block"]).where(gap <= reach).drop("_block")
    return pairs if emits is None else pairs.withColumn(emits, F.lit(windows) - gap)
