"""The same results in plain SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

# Lines numbered within their order, with price and amount in cents.
_LINES = """
lines AS (
  SELECT l.l_orderkey AS order_id,
         l.l_partkey AS sku_id,
         CAST(l.l_quantity AS BIGINT) AS sku_num,
         CAST(round(p.p_retailprice * 100) AS BIGINT) AS price_c,
         coalesce(CAST(round(p.p_retailprice * 100) AS BIGINT), 0)
           * CAST(l.l_quantity AS BIGINT) AS amt,
         p.p_name AS sku_name,
         row_number() OVER (
           PARTITION BY l.l_orderkey
           ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice
         ) AS seq
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
)"""

_SKUS = """
stored_skus AS (
  SELECT p_partkey AS id,
         CAST('0x' || substr(md5(p_name), 1, 15) AS BIGINT) AS spu_id,
         CASE WHEN p_name NOT LIKE '%bolt' THEN p_name END AS spu_name,
         CAST(split_part(p_brand, '#', 2) AS BIGINT) AS tm_id,
         CASE WHEN p_brand <> 'Brand#13' THEN p_brand END AS tm_name,
         CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS category3_id,
         CASE WHEN p_type <> 'LARGE' THEN p_type END AS category3_name
  FROM part WHERE p_size <> 1
)"""

_USERS = """
users AS (
  SELECT c_custkey AS id,
         CASE WHEN age < 20 THEN '20岁及以下' WHEN age > 30 THEN '30岁以上'
              ELSE '21岁到30岁' END AS age_group,
         CASE WHEN c_custkey % 3 = 0 THEN '男' ELSE '女' END AS gender_name
  FROM (SELECT c_custkey,
               date_diff('day', DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER),
                         DATE '2020-05-12') // 365 AS age
        FROM customer)
)"""

# Shares by the rule itself: what earlier lines were given is subtracted on the
# line that first completes the order's total.
_SHARES = (
    _LINES
    + """,
base AS (
  SELECT li.*, o.o_orderdate AS create_time,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS fin,
         sum(amt) OVER (PARTITION BY order_id) AS orig,
         sum(amt) OVER (PARTITION BY order_id ORDER BY seq) AS cum
  FROM lines li JOIN orders o ON o.o_orderkey = li.order_id
),
parts AS (
  SELECT *, CAST((2::HUGEINT * fin * amt + orig) // nullif(2 * orig, 0) AS BIGINT) AS part,
         max(cum) OVER (PARTITION BY order_id ORDER BY seq
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pcum
  FROM base
),
prior AS (
  SELECT *, coalesce(sum(part) OVER (PARTITION BY order_id ORDER BY seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given
  FROM parts
),
shares AS (
  SELECT *, order_id * 4294967296 + seq AS order_detail_id,
         CAST(CASE WHEN cum = orig AND coalesce(pcum, -1) < orig THEN fin - given
                   WHEN cum = orig THEN 0 ELSE part END AS BIGINT) AS share_c
  FROM prior
)"""
)

_FIRST_VISITS = """
SELECT user_id AS mid, event_type AS ch, strftime(ts, '%Y-%m-%d') AS dt,
       strftime(ts, '%H') AS hr, strftime(ts, '%M') AS mi, ts
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1
"""

_TRADEMARK = f"""
WITH {_SHARES}, {_SKUS}
SELECT '2020-05-12 00:00:00' AS stat_time, k.tm_id, k.tm_name,
       CAST(sum(share_c) AS DOUBLE) / 100 AS amount
FROM shares s LEFT JOIN stored_skus k ON k.id = s.sku_id
GROUP BY k.tm_id, k.tm_name
"""

_STATE = "TIMESTAMP '1995-07-01'"

BATCH_ORACLE: dict[str, str] = {
    "json_parse": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""",
    "cdc_canal_route": """
SELECT CASE WHEN l_linestatus = 'F' THEN 'ODS_T_ORDER_DETAIL'
            ELSE 'ODS_T_ORDER_DETAIL_ACTIVITY' END AS topic,
       CAST(l_orderkey AS VARCHAR) AS key, l_partkey AS sku_id,
       CAST(l_quantity AS BIGINT) AS sku_num,
       CAST(round(l_extendedprice * 100) AS DOUBLE) / 100 AS order_price
FROM lineitem WHERE l_linenumber <> 7
UNION ALL
SELECT CASE WHEN l_linestatus = 'F' THEN 'ODS_T_ORDER_DETAIL'
            ELSE 'ODS_T_ORDER_DETAIL_ACTIVITY' END,
       CAST(l_orderkey AS VARCHAR), l_suppkey, CAST(l_linenumber AS BIGINT),
       CAST(round(l_discount * 100) AS DOUBLE) / 100
FROM lineitem WHERE l_linenumber <> 7 AND l_returnflag = 'R'
""",
    "cdc_maxwell_route": """
SELECT 'ODS_T_ORDER_INFO' AS topic, CAST(o_orderkey AS VARCHAR) AS key, 'insert' AS type
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'ODS_T_SKU_INFO', CAST(p_partkey AS VARCHAR),
       CASE p_size % 3 WHEN 0 THEN 'insert' ELSE 'update' END
FROM part WHERE p_size % 3 <> 2
UNION ALL
SELECT 'ODS_T_BASE_PROVINCE', CAST(n_nationkey AS VARCHAR), 'insert'
FROM nation WHERE n_regionkey <> 0
""",
    "topic_fanout": """
SELECT 'ODS_T_ORDER_INFO' AS topic, CAST(o_orderkey AS VARCHAR) AS key FROM orders
UNION ALL
SELECT 'ODS_T_BASE_PROVINCE', CAST(n_nationkey AS VARCHAR) FROM nation
UNION ALL
SELECT 'ODS_T_SKU_INFO', CAST(p_partkey AS VARCHAR) FROM part
""",
    "dau_first_visit": _FIRST_VISITS,
    "dau_upsert_by_day": f"""
SELECT mid, CASE WHEN mid % 2 = 1 THEN ch ELSE 'unknown' END AS ch, dt, hr, mi, ts
FROM ({_FIRST_VISITS})
""",
    "user_age_gender": f"WITH {_USERS} SELECT * FROM users",
    "sku_enrich": """
SELECT p_partkey AS id,
       CASE WHEN p_name NOT LIKE '%bolt' THEN p_name END AS spu_name,
       CASE WHEN p_brand <> 'Brand#13' THEN p_brand END AS tm_name,
       CASE WHEN p_type <> 'LARGE' THEN p_type END AS category3_name
FROM part
""",
    "dim_lookup_by_keys": """
SELECT * FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01')
""",
    "dim_upsert_latest": """
SELECT user_id, event_type, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""",
    "relation_read": """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0
""",
    "order_date_parts": """
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
       strftime(o_orderdate, '%H') AS create_hour
FROM orders
""",
    "first_order_flag": f"""
WITH known AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < {_STATE})
SELECT o_orderkey AS id, o_custkey AS user_id,
       CASE WHEN o_custkey IN (SELECT o_custkey FROM known) THEN '0'
            WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
            THEN '1' ELSE '0' END AS if_first_order
FROM orders WHERE o_orderdate >= {_STATE}
""",
    "user_state_upsert": "SELECT DISTINCT o_custkey AS user_id, '1' AS if_consumed FROM orders",
    "order_province": """
SELECT o.o_orderkey AS id, n.n_name AS province_name
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_regionkey <> 4
""",
    "order_user": f"""
WITH {_USERS}
SELECT o.o_orderkey AS id, u.age_group AS user_age_group, u.gender_name AS user_gender
FROM orders o LEFT JOIN users u ON u.id = o.o_custkey
""",
    "detail_sku": f"""
WITH {_LINES}, {_SKUS}
SELECT li.order_id * 4294967296 + li.seq AS detail_id, k.spu_id, k.tm_id, k.category3_id,
       k.spu_name, k.tm_name, k.category3_name
FROM lines li LEFT JOIN stored_skus k ON k.id = li.sku_id
""",
    "order_wide_join": f"""
WITH {_LINES}, {_SKUS}, {_USERS},
facts AS (
  SELECT o.*, n.n_name, CASE WHEN n.n_name IS NOT NULL THEN 'A' || n.n_nationkey END AS area,
         u.age_group, u.gender_name,
         CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
              THEN '1' ELSE '0' END AS first_flag
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_regionkey <> 4
  LEFT JOIN users u ON u.id = o.o_custkey
)
SELECT li.order_id * 4294967296 + li.seq AS order_detail_id, li.order_id,
       f.o_orderstatus AS order_status, f.o_orderdate AS create_time,
       f.o_custkey AS user_id, li.sku_id, CAST(li.price_c AS DOUBLE) / 100 AS sku_price,
       li.sku_num, li.sku_name,
       CAST(sum(li.amt) OVER (PARTITION BY li.order_id) AS DOUBLE) / 100 AS original_total_amount,
       CAST(round(f.o_totalprice * 100) AS DOUBLE) / 100 AS final_total_amount,
       f.first_flag AS if_first_order, f.n_name AS province_name,
       f.area AS province_area_code, f.age_group AS user_age_group,
       f.gender_name AS user_gender, strftime(f.o_orderdate, '%Y-%m-%d') AS dt,
       k.spu_id, k.tm_id, k.category3_id, k.spu_name, k.tm_name, k.category3_name
FROM lines li JOIN facts f ON f.o_orderkey = li.order_id
LEFT JOIN stored_skus k ON k.id = li.sku_id
""",
    "order_wide_dedup": f"""
WITH {_LINES}
SELECT li.order_id, li.order_id * 4294967296 + li.seq AS order_detail_id, o.o_custkey AS user_id,
       li.sku_id, li.sku_num, CAST(li.price_c AS DOUBLE) / 100 AS sku_price
FROM lines li JOIN orders o ON o.o_orderkey = li.order_id
""",
    "order_amount_split": f"""
WITH {_SHARES}
SELECT order_id, order_detail_id, CAST(share_c AS DOUBLE) / 100 AS final_detail_amount
FROM shares
""",
    "spu_amount_sum": f"""
WITH {_SHARES}, {_SKUS}
SELECT k.spu_id, k.spu_name, min(s.create_time) AS stat_time,
       CAST(sum(s.share_c) AS DOUBLE) / 100 AS amount
FROM shares s LEFT JOIN stored_skus k ON k.id = s.sku_id
GROUP BY k.spu_id, k.spu_name
""",
    "trademark_amount_sum": _TRADEMARK,
    "idempotent_sink": f"""
SELECT t.*, 'trademark_amount_sum' AS query_id, 7 AS batch_id FROM ({_TRADEMARK}) t
""",
    "sliding_window_join": """
WITH a AS (SELECT o_orderkey AS order_id,
                  CAST(floor(date_diff('day', TIMESTAMP '1970-01-01', o_orderdate) / 30)
                       AS BIGINT) AS order_slide FROM orders),
b AS (SELECT l_orderkey AS order_id, l_linenumber, l_partkey, l_suppkey,
             CAST(floor(date_diff('day', TIMESTAMP '1970-01-01', l_shipdate) / 30)
                  AS BIGINT) AS ship_slide FROM lineitem)
SELECT a.order_id, a.order_slide, b.l_linenumber, b.l_partkey, b.l_suppkey, b.ship_slide,
       3 - abs(a.order_slide - b.ship_slide) AS n_emits
FROM a JOIN b ON a.order_id = b.order_id AND abs(a.order_slide - b.ship_slide) <= 2
""",
    "match_search": r"""
SELECT doc_id, n_chars FROM documents
WHERE list_has_any(
  string_split_regex(lower(text), '[^\p{L}\p{N}]+'), ['the', 'nation', 'house'])
ORDER BY n_chars, doc_id LIMIT 10
""",
}
BATCH_ORACLE["topic_values"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS id, o_orderstatus,
       CAST(round(o_totalprice * 100) AS DOUBLE) / 100 AS total, o_orderdate
FROM orders
"""
BATCH_ORACLE["match_search_index"] = BATCH_ORACLE["match_search"]

STREAM_ORACLE: dict[str, str] = {
    "dau_stream": """
SELECT DISTINCT user_id AS mid, strftime(ts, '%Y-%m-%d') AS dt FROM events
""",
    "cdc_stream": f"SELECT topic, key FROM ({BATCH_ORACLE['cdc_maxwell_route']})",
    "sku_dimension_stream": BATCH_ORACLE["sku_enrich"],
    "order_fact_stream": f"""
WITH {_USERS}
SELECT o.o_orderkey AS id,
       CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
            THEN '1' ELSE '0' END AS if_first_order,
       strftime(o.o_orderdate, '%Y-%m-%d') AS create_date,
       strftime(o.o_orderdate, '%H') AS create_hour,
       n.n_name AS province_name, u.gender_name AS user_gender
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_regionkey <> 4
LEFT JOIN users u ON u.id = o.o_custkey
""",
    "order_detail_stream": f"""
WITH {_SKUS}
SELECT l_orderkey AS order_id, l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num,
       k.spu_id, k.tm_id, k.category3_id, k.spu_name, k.tm_name, k.category3_name
FROM lineitem LEFT JOIN stored_skus k ON k.id = l_partkey
""",
    "order_wide_stream": """
SELECT o_orderkey AS order_id, count(*) AS n_lines,
       CAST(round(min(o_totalprice) * 100) AS DOUBLE) / 100 AS paid
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""",
    "order_amount_stream": f"""
WITH {_SHARES.replace("ORDER BY seq", "ORDER BY seq % 3, seq")}
SELECT order_id, order_detail_id, CAST(share_c AS DOUBLE) / 100 AS final_detail_amount
FROM shares
""",
    "trademark_amount_stream": f"SELECT tm_id, tm_name, amount FROM ({_TRADEMARK})",
    "spu_amount_stream": BATCH_ORACLE["spu_amount_sum"],
    "order_wide_unmatched_stream": """
WITH o AS (SELECT o_orderkey FROM orders WHERE o_custkey % 7 <> 0),
l AS (SELECT * FROM lineitem WHERE l_orderkey % 5 <> 0)
SELECT o_orderkey AS order_id, 'no lines' AS reason, 0::BIGINT AS n_lines
FROM o WHERE NOT EXISTS (SELECT 1 FROM l WHERE l_orderkey = o_orderkey)
UNION ALL
SELECT l_orderkey, 'no order', count(DISTINCT (l_linenumber, l_partkey, l_suppkey))
FROM l WHERE NOT EXISTS (SELECT 1 FROM o WHERE l_orderkey = o_orderkey) GROUP BY l_orderkey
""",
    "dim_delete_stream": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'again' WHEN c_custkey % 5 = 1 THEN 'changed'
  ELSE c_mktsegment END AS user_level
FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 10 = 0
""",
    "returning_device_stream": """
WITH e AS (SELECT user_id, event_id, ts AS t, epoch_us(ts) // 1000 AS ms FROM events)
SELECT DISTINCT user_id AS mid, ms AS ts, strftime(t, '%Y-%m-%d') AS dt FROM e
QUALIFY coalesce(ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms, event_id), 1e15) > 259200000
""",
    "amount_window_stream": """
WITH e AS (SELECT length(event_type) AS tm_id, CAST(value AS DECIMAL(18,2)) AS amount,
                  epoch_us(ts) // 1000 AS ms FROM events WHERE event_id % 10 <> 0),
each AS (SELECT *, ms - ms % 7200000 + 7200000 * k AS ending FROM e, (VALUES (1), (2), (3)) AS o(k))
SELECT ending, tm_id, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS n FROM each GROUP BY ending, tm_id
""",
}
