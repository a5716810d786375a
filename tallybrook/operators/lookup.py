"""Joining facts with dimensions.

No join is forced to broadcast: Spark checks a dimension's size against
``spark.sql.autoBroadcastJoinThreshold``, when planning and again at run time,
and shuffles by key beyond it, where adaptive execution splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HIT = "_dim_hit"


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    columns: dict[str, str],
    dim_key: str = "id",
    on_missing: str = "null",
) -> DataFrame:
    """Add dimension columns to facts; ``columns`` maps dimension name to new name.

    ``dim`` has one row per key (see ``keyed.latest_by_key``). A fact whose key is
    unknown keeps nulls (``on_missing='null'``), is dropped (``'drop'``) or fails
    the job (``'fail'``).
    """
    if on_missing not in ("null", "drop", "fail"):
        raise ValueError(f"on_missing must be null, drop or fail, not {on_missing!r}")
    key = "_dim_key"
    side = dim.select(
        F.col(dim_key).alias(key), *[F.col(c).alias(n) for c, n in columns.items()]
    )
    if on_missing == "fail":
        side = side.withColumn(_HIT, F.lit(True))
    how = "inner" if on_missing == "drop" else "left"
    out = facts.join(side, F.col(fact_key) == F.col(key), how).drop(key)
    if on_missing == "fail":
        message = F.concat(F.lit(f"no dimension row for {fact_key} "), F.col(fact_key))
        found = F.when(F.col(_HIT), True).otherwise(F.raise_error(message).cast("boolean"))
        out = out.where(found).drop(_HIT)
    return out


def rows_for_keys(dim: DataFrame, dim_key: str, facts: DataFrame, fact_key: str) -> DataFrame:
    """The dimension rows some fact refers to; keys are made distinct before the join."""
    keys = facts.select(F.col(fact_key).alias("_key")).distinct()
    return dim.join(keys, F.col(dim_key) == F.col("_key"), "left_semi")


def enrich_sku(
    sku: DataFrame, category3: DataFrame, trademark: DataFrame, spu: DataFrame
) -> DataFrame:
    """Freeze category, trademark and spu names into the sku dimension."""
    out = lookup(sku, category3, "category3_id", {"name": "category3_name"})
    out = lookup(out, trademark, "tm_id", {"tm_name": "tm_name"})
    return lookup(out, spu, "spu_id", {"spu_name": "spu_name"})


def add_province(orders: DataFrame, province: DataFrame) -> DataFrame:
    return lookup(
        orders,
        province,
        "province_id",
        {"name": "province_name", "area_code": "province_area_code"},
    )


def add_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    return lookup(
        orders,
        users,
        "user_id",
        {"age_group": "user_age_group", "gender_name": "user_gender"},
    )


def add_sku(details: DataFrame, sku: DataFrame, on_missing: str = "null") -> DataFrame:
    names = ("spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")
    return lookup(details, sku, "sku_id", {n: n for n in names}, on_missing=on_missing)
