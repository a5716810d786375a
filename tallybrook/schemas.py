"""Record types of the warehouse.

Ids are BIGINT, money is DECIMAL(18,2), times are TIMESTAMP_NTZ, flags are
STRING ``'0'``/``'1'``. Records arrive as JSON text; fields a record does not
carry are null and fields a schema does not name are ignored.
"""

from __future__ import annotations

MONEY = "DECIMAL(18,2)"

TOPIC = (
    "topic STRING, key STRING, value STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP"
)

START_LOG = (
    "common STRUCT<mid: STRING, uid: STRING, ar: STRING, ch: STRING, vc: STRING>, "
    "ts BIGINT"
)

CANAL = "table STRING, type STRING, data ARRAY<STRING>"
MAXWELL = "table STRING, type STRING, data STRING"

ORDER_INFO = (
    "id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT, "
    f"final_total_amount {MONEY}, benefit_reduce_amount {MONEY}, "
    f"original_total_amount {MONEY}, feight_fee {MONEY}, "
    "expire_time TIMESTAMP_NTZ, create_time TIMESTAMP_NTZ, operate_time TIMESTAMP_NTZ"
)
ORDER_INFO_ENRICHED = ORDER_INFO + (
    ", create_date STRING, create_hour STRING, if_first_order STRING, "
    "province_name STRING, province_area_code STRING, "
    "user_age_group STRING, user_gender STRING"
)

ORDER_DETAIL = (
    f"id BIGINT, order_id BIGINT, sku_id BIGINT, order_price {MONEY}, "
    "sku_num BIGINT, sku_name STRING, create_time TIMESTAMP_NTZ"
)
ORDER_DETAIL_ENRICHED = ORDER_DETAIL + (
    ", spu_id BIGINT, tm_id BIGINT, category3_id BIGINT, "
    "spu_name STRING, tm_name STRING, category3_name STRING"
)

ORDER_WIDE = (
    "order_detail_id BIGINT, order_id BIGINT, order_status STRING, "
    "create_time TIMESTAMP_NTZ, user_id BIGINT, sku_id BIGINT, "
    f"sku_price {MONEY}, sku_num BIGINT, sku_name STRING, "
    f"benefit_reduce_amount {MONEY}, original_total_amount {MONEY}, "
    f"feight_fee {MONEY}, final_total_amount {MONEY}, final_detail_amount {MONEY}, "
    "if_first_order STRING, province_name STRING, province_area_code STRING, "
    "user_age_group STRING, user_gender STRING, dt STRING, spu_id BIGINT, "
    "tm_id BIGINT, category3_id BIGINT, spu_name STRING, tm_name STRING, "
    "category3_name STRING"
)

# What queries and marts read of a wide row.
LINE_SHARE = f"order_id BIGINT, order_detail_id BIGINT, final_detail_amount {MONEY}"
SPU_AMOUNT = (
    f"spu_id BIGINT, spu_name STRING, create_time TIMESTAMP_NTZ, final_detail_amount {MONEY}"
)
TRADEMARK_AMOUNT = f"tm_id BIGINT, tm_name STRING, final_detail_amount {MONEY}"
# Running totals of the marts; ``key`` names the group.
SPU_TOTAL = (
    "key STRING, spu_id BIGINT, spu_name STRING, stat_time TIMESTAMP_NTZ, amount DECIMAL(28,2)"
)
TRADEMARK_TOTAL = (
    "key STRING, tm_id BIGINT, tm_name STRING, stat_time STRING, amount DECIMAL(28,2)"
)

# Open windows, and how far a job's events have come.
WINDOW_TOTAL = "ending BIGINT, group BIGINT, amount DECIMAL(28,2), n BIGINT, span BIGINT"
PROGRESS = "name STRING, newest BIGINT"

# When a key was seen last, in epoch ms.
SEEN = "key STRING, last BIGINT"
USER_STATE = "user_id BIGINT, if_consumed STRING"
# What the lines of an order so far amount to, and when the last of them came.
ORDER_SUMS = "order_id BIGINT, lines BIGINT, cents BIGINT, given BIGINT, at BIGINT"
# Orders and lines that the other side may still come for.
WIDE_SIDES = (
    f"order_id BIGINT, side STRING, id BIGINT, arrived TIMESTAMP, "
    f"orders STRUCT<{ORDER_INFO_ENRICHED}>, lines STRUCT<{ORDER_DETAIL_ENRICHED}>"
)

BASE_PROVINCE = "id BIGINT, name STRING, region_id STRING, area_code STRING"
BASE_CATEGORY3 = "id BIGINT, name STRING, category2_id STRING"
BASE_TRADEMARK = "id BIGINT, tm_name STRING"
SPU_INFO = "id BIGINT, spu_name STRING"
SKU_INFO = (
    f"id BIGINT, spu_id BIGINT, price {MONEY}, sku_name STRING, tm_id BIGINT, "
    "category3_id BIGINT, create_time TIMESTAMP_NTZ"
)
SKU_INFO_ENRICHED = SKU_INFO + ", category3_name STRING, spu_name STRING, tm_name STRING"
USER_INFO = "id BIGINT, user_level STRING, birthday DATE, gender STRING"
USER_INFO_ENRICHED = USER_INFO + ", age_group STRING, gender_name STRING"
