"""Orders joined with their lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.operators.keyed import latest_by_key

# Fields of the wide record, by the side they come from: new name -> source name.
FROM_ORDER = {
    "order_id": "id",
    "order_status": "order_status",
    "create_time": "create_time",
    "user_id": "user_id",
    "benefit_reduce_amount": "benefit_reduce_amount",
    "original_total_amount": "original_total_amount",
    "feight_fee": "feight_fee",
    "final_total_amount": "final_total_amount",
    "if_first_order": "if_first_order",
    "province_name": "province_name",
    "province_area_code": "province_area_code",
    "user_age_group": "user_age_group",
    "user_gender": "user_gender",
    "dt": "create_date",
}
FROM_DETAIL = {
    "order_detail_id": "id",
    "sku_id": "sku_id",
    "sku_price": "order_price",
    "sku_num": "sku_num",
    "sku_name": "sku_name",
    "spu_id": "spu_id",
    "tm_id": "tm_id",
    "category3_id": "category3_id",
    "spu_name": "spu_name",
    "tm_name": "tm_name",
    "category3_name": "category3_name",
}


def _side(df: DataFrame, names: dict[str, str], extra: dict[str, Column]) -> DataFrame:
    have = set(df.columns)
    cols = [F.col(src).alias(new) for new, src in names.items() if src in have]
    return df.select(*cols, *[c.alias(n) for n, c in extra.items()])


def merge_wide(
    orders: DataFrame,
    details: DataFrame,
    order_extra: dict[str, Column] | None = None,
    detail_extra: dict[str, Column] | None = None,
    condition: Column | None = None,
    how: str = "inner",
) -> DataFrame:
    """One row per order line with the fields of both sides.

    Only fields a side has are taken. ``*_extra`` carries more columns, such as
    event times, and ``condition`` may narrow the match by them. ``how`` is the kind of join.
    """
    left = _side(orders, FROM_ORDER, order_extra or {})
    right = _side(
        details, FROM_DETAIL, {"_order_id": F.col("order_id"), **(detail_extra or {})}
    )
    on = F.col("order_id") == F.col("_order_id")
    if condition is not None:
        on = on & condition
    return left.join(right, on, how).drop("_order_id")


def new_pairs(orders: DataFrame, details: DataFrame, reach: str) -> DataFrame:
    """Orders merged with lines that arrived within ``reach`` of them, each pair once.

    Both sides have ``arrived`` and ``known``: whether a row stood there before. Pairs that known
    rows make among themselves were given out then and are left out, with their repeats. The time
    of the order stays as ``order_at``.
    """
    near = F.expr(
        f"detail_at BETWEEN order_at - INTERVAL {reach} AND order_at + INTERVAL {reach}"
    )
    wide = merge_wide(
        orders,
        details,
        order_extra={"order_at": F.col("arrived"), "_order_known": F.col("known")},
        detail_extra={"detail_at": F.col("arrived"), "_detail_known": F.col("known")},
        condition=near,
    ).withColumn("_known", F.col("_order_known") & F.col("_detail_known"))
    pair = ["order_id", "order_detail_id"]
    once = latest_by_key(wide, pair, ["_known", "detail_at", "order_at"])
    return once.where("NOT _known").drop("_known", "_order_known", "_detail_known", "detail_at")
