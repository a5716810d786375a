"""Order facts: date parts, first-order flag, user state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import times

CONSUMED = "1"


def add_date_parts(orders: DataFrame, created: str = "create_time") -> DataFrame:
    """Add ``create_date`` and ``create_hour`` from a timestamp or its text form."""
    c = F.col(created)
    if dict(orders.dtypes)[created] == "string":
        parts = {"create_date": times.date_of_text(c), "create_hour": times.hour_of_text(c)}
    else:
        parts = {"create_date": times.day(c), "create_hour": times.hour(c)}
    return orders.withColumns(parts)


def flag_first_orders(orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Add ``if_first_order``: ``'1'`` on the earliest order of each user who has
    not consumed before, ``'0'`` on all others.

    Order ids are unique; equal times are settled by the lower id. ``state`` is ``user_id, if_consumed``.
    Orders are reduced to one row per user before they meet the state, and the
    flag is joined back by order id, so no step depends on how many orders one
    user has.
    """
    first = orders.groupBy("user_id").agg(
        F.min(F.struct("create_time", "id")).alias("_first")
    )
    if state is not None:
        known = state.where(F.col("if_consumed") == CONSUMED).select("user_id")
        first = first.join(known, "user_id", "left_anti")
    marks = first.select(F.col("_first.id").alias("_first_id"))
    flagged = orders.join(marks, F.col("id") == F.col("_first_id"), "left")
    flag = F.when(F.col("_first_id").isNotNull(), "1").otherwise("0")
    return flagged.withColumn("if_first_order", flag).drop("_first_id")


def consumed_users(flagged: DataFrame) -> DataFrame:
    """State rows of the users whose first order is among ``flagged``."""
    first = flagged.where(F.col("if_first_order") == "1")
    return first.select("user_id", F.col("if_first_order").alias("if_consumed"))
