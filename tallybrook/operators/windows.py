"""Sums over sliding windows of event time, kept open between batches and closed by a watermark."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Open windows are stored by spans of so many widths, so that a batch opens few of them.
SPAN_WIDTHS = 64


@dataclass(frozen=True)
class Windows:
    """Windows of ``width`` that begin every ``slide``, in ms; widths are whole slides.

    A window is closed once a row has come that is ``lag`` past its end.
    """

    width: int
    slide: int
    lag: int

    def __post_init__(self) -> None:
        if self.slide <= 0 or self.width % self.slide:
            raise ValueError("the width of windows must be a multiple of their slide")

    def last_end(self, at: Column) -> Column:
        """The end of the last window that holds the time ``at``."""
        return at - F.pmod(at, F.lit(self.slide)) + self.width

    def is_late(self, at: Column, closed: int | None) -> Column:
        """Whether every window of ``at`` was closed: none that ends by ``closed`` is open."""
        return F.lit(False) if closed is None else self.last_end(at) <= closed

    def span(self, ending: Column) -> Column:
        return F.floor(ending / (self.width * SPAN_WIDTHS)).cast("bigint")

    def partial(self, rows: DataFrame, at: str, group: str, amount: str, closed: int | None) -> DataFrame:
        """``span, ending, group, amount, n`` of the rows' windows that are still open."""
        own = self.last_end(F.col(at))
        ends = F.sequence(own - (self.width - self.slide), own, F.lit(self.slide))
        each = rows.select(F.col(group).alias("group"), F.col(amount).alias("amount"), F.explode(ends).alias("ending"))
        live = each if closed is None else each.where(F.col("ending") > closed)
        return self.added(live.withColumns({"span": self.span(F.col("ending")), "n": F.lit(1).cast("bigint")}))

    def added(self, sums: DataFrame) -> DataFrame:
        """One row per window and group."""
        return sums.groupBy("span", "ending", "group").agg(
            F.sum("amount").cast("decimal(28,2)").alias("amount"), F.sum("n").alias("n")
        )
