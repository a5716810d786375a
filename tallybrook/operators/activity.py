"""Daily active devices from start logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import times
from tallybrook.operators.keyed import first_by_key

VISIT_KEY = ["dt", "mid"]


def visits(logs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Start logs (``common`` struct, ``ts`` in epoch ms) as flat visit rows."""
    at = times.from_epoch_ms(F.col("ts"))
    return logs.select(
        *(keep or []),
        *[F.col(f"common.{f}").alias(f) for f in ("mid", "uid", "ar", "ch", "vc")],
        times.day(at).alias("dt"),
        times.hour(at).alias("hr"),
        times.minute(at).alias("mi"),
        "ts",
    )


def first_visits(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """The first visit of every device on every day."""
    return first_by_key(rows, VISIT_KEY, order_by)
