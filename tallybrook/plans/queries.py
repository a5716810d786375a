"""Every operator as a query over the test tables.

Money is exact inside and comes out as DOUBLE; ids are BIGINT, flags STRING.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import times
from tallybrook.functions.money import cents, from_cents, money
from tallybrook.operators.allocation import CHUNK_IDS, allocate_cents
from tallybrook.operators.cdc import route_canal, route_maxwell
from tallybrook.operators.activity import first_visits
from tallybrook.operators.keyed import distinct_by_key, latest_by_key
from tallybrook.operators.lookup import add_province, add_sku, add_user, lookup, rows_for_keys
from tallybrook.operators.marts import spu_amounts, trademark_amounts
from tallybrook.operators.orders import add_date_parts, consumed_users, flag_first_orders
from tallybrook.operators.records import parse_json, topic_rows
from tallybrook.operators.search import match_search
from tallybrook.operators.skew import by_heat
from tallybrook.operators.text_index import build_index, search_index
from tallybrook.operators.wide import merge_wide
from tallybrook.operators.window_join import sliding_window_join
from tallybrook.plans.tables import (
    STAT_TIME,
    STATE_CUTOFF,
    Tables,
    as_details,
    number_lines,
)
from tallybrook.schemas import MONEY, USER_STATE
from tallybrook.session import work_path
from tallybrook.sources.relations import read_query
from tallybrook.sources.results import read_results, write_result
from tallybrook.sources.tables import read_latest, upsert
from tallybrook.sources.topics import TopicStore, read_topic_log, send

Query = Callable[[SparkSession, str], DataFrame]

SEARCH = "the nation house"
MONEY_COLUMNS = (
    "sku_price",
    "original_total_amount",
    "final_total_amount",
    "final_detail_amount",
)


def _surface(df: DataFrame) -> DataFrame:
    """Money columns as DOUBLE."""
    have = [c for c in MONEY_COLUMNS if c in df.columns]
    return df.withColumns({c: F.col(c).cast("double") for c in have})


# Parsing and routing -------------------------------------------------------


def json_parse(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).read("events").select("event_id", "props")
    return parse_json(events, "k BIGINT", value="props", keep=["event_id"])


def cdc_canal_route(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes of two tables made of lines: returned ones list two rows, line 7 lists none."""
    line = Tables(spark, folder).read("lineitem")
    first = F.struct(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        money(F.col("l_extendedprice")).alias("order_price"),
    )
    second = F.struct(
        F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").alias("sku_id"),
        F.col("l_linenumber").cast("bigint").alias("sku_num"),
        money(F.col("l_discount")).alias("order_price"),
    )
    data = F.when(F.col("l_linenumber") == 7, None).otherwise(
        F.when(F.col("l_returnflag") == "R", F.array(first, second)).otherwise(F.array(first))
    )
    envelope = F.struct(
        F.when(F.col("l_linestatus") == "F", "order_detail")
        .otherwise("order_detail_activity")
        .alias("table"),
        F.when(F.col("l_returnflag") == "A", "DELETE").otherwise("INSERT").alias("type"),
        data.alias("data"),
    )
    fields = f"sku_id BIGINT, sku_num BIGINT, order_price {MONEY}"
    rows = route_canal(line.select(F.to_json(envelope).alias("value")), record=fields)
    return rows.withColumn("order_price", F.col("order_price").cast("double"))


def maxwell_envelopes(t: Tables) -> DataFrame:
    """Maxwell envelopes of four source tables."""
    orders = t.read("orders").select(
        F.lit("order_info").alias("table"),
        F.when(F.col("o_orderstatus") == "F", "insert")
        .when(F.col("o_orderstatus") == "O", "update")
        .otherwise("delete")
        .alias("type"),
        F.to_json(F.struct(F.col("o_orderkey").alias("id"))).alias("data"),
    )
    kind = F.col("p_size") % 3
    part = t.read("part").select(
        F.lit("sku_info").alias("table"),
        F.when(kind == 0, "insert").when(kind == 1, "update").otherwise("delete").alias("type"),
        F.to_json(F.struct(F.col("p_partkey").alias("id"), "p_name")).alias("data"),
    )
    nation = t.read("nation").select(
        F.lit("base_province").alias("table"),
        F.lit("insert").alias("type"),
        F.when(F.col("n_regionkey") == 0, "{}")
        .otherwise(F.to_json(F.struct(F.col("n_nationkey").alias("id"), "n_name")))
        .alias("data"),
    )
    supplier = t.read("supplier").select(
        F.lit("base_supplier").alias("table"),
        F.lit("insert").alias("type"),
        F.to_json(F.struct(F.col("s_suppkey").alias("id"))).alias("data"),
    )
    rows = orders.unionByName(part).unionByName(nation).unionByName(supplier)
    text = F.format_string('{"table":"%s","type":"%s","data":%s}', "table", "type", "data")
    return rows.select(text.alias("value"))


def cdc_maxwell_route(spark: SparkSession, folder: str) -> DataFrame:
    return route_maxwell(maxwell_envelopes(Tables(spark, folder))).select("topic", "key", "type")


def topic_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables sent to a topic each and read back."""
    t = Tables(spark, folder)
    orders = t.read("orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    nation = t.read("nation").select(F.col("n_nationkey").alias("id"), "n_name")
    part = t.read("part").select(F.col("p_partkey").alias("id"), "p_name")
    rows = (
        topic_rows(orders, "ODS_T_ORDER_INFO", F.col("id"))
        .unionByName(topic_rows(nation, "ODS_T_BASE_PROVINCE", F.col("id")))
        .unionByName(topic_rows(part, "ODS_T_SKU_INFO", F.col("id")))
    )
    store = TopicStore(location=work_path(spark, "topics"))
    send(rows, store, "topic_fanout", 0)
    return read_topic_log(spark, store).select("topic", "key")


def topic_values(spark: SparkSession, folder: str) -> DataFrame:
    """Orders sent to a topic as text, and read from it as records."""
    orders = Tables(spark, folder).read("orders").select(
        F.col("o_orderkey").alias("id"), "o_orderstatus", money(F.col("o_totalprice")).alias("total"), "o_orderdate"
    )
    store = TopicStore(location=work_path(spark, "topics"))
    send(topic_rows(orders, "ODS_T_ORDER_INFO", F.col("id")), store, "topic_values", 0)
    fields = f"id BIGINT, o_orderstatus STRING, total {MONEY}, o_orderdate TIMESTAMP_NTZ"
    rows = parse_json(read_topic_log(spark, store, "ODS_T_ORDER_INFO"), fields, keep=["key"])
    return rows.withColumn("total", F.col("total").cast("double"))


# Activity ------------------------------------------------------------------


def dau_first_visit(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked by DATE; days and hours are written out for the rows that are left."""
    events = Tables(spark, folder).read("events").select(
        F.col("user_id").alias("mid"),
        F.col("event_type").alias("ch"),
        F.col("ts").cast("date").alias("dt"),
        "ts",
        "event_id",
    )
    first = first_visits(events, ["ts", "event_id"])
    ts = F.col("ts")
    return first.select(
        "mid",
        "ch",
        times.day(ts).alias("dt"),
        times.hour(ts).alias("hr"),
        times.minute(ts).alias("mi"),
        "ts",
    )


def dau_upsert_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """First visits written without their channel; a second batch corrects those of odd devices."""
    rows = dau_first_visit(spark, folder)
    path = work_path(spark, "visits")
    upsert(rows.withColumn("ch", F.lit("unknown")), path, 0, partition_by=["dt"])
    upsert(rows.where(F.col("mid") % 2 == 1), path, 1, partition_by=["dt"])
    fields = "mid BIGINT, ch STRING, hr STRING, mi STRING, ts TIMESTAMP_NTZ, dt STRING"
    return read_latest(spark, path, fields, ["dt", "mid"])


# Dimensions ----------------------------------------------------------------


def _seconds(column: str) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp"))


def user_age_gender(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).users().select("id", "age_group", "gender_name")


def sku_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).skus().select("id", "spu_name", "tm_name", "category3_name")


def dim_lookup_by_keys(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    day = F.col("o_orderdate")
    january = t.read("orders").where(
        (day >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (day < F.lit("1997-02-01").cast("timestamp_ntz"))
    )
    return rows_for_keys(t.read("customer"), "c_custkey", january, "o_custkey")


def dim_upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    events = Tables(spark, folder).read("events")
    rows = events.select("user_id", "event_type", "value", "ts", "event_id")
    # The earlier half of the time in one batch, the later one in another.
    middle = F.lit(rows.agg(F.avg(_seconds("ts"))).first()[0] or 0.0)
    path = work_path(spark, "profiles")
    for batch_id, part in enumerate([_seconds("ts") < middle, _seconds("ts") >= middle]):
        last = latest_by_key(rows.where(part), ["user_id"], ["ts", "event_id"])
        upsert(last.drop("event_id"), path, batch_id, keys=["user_id"])
    fields = "user_id BIGINT, event_type STRING, value DOUBLE, ts TIMESTAMP_NTZ"
    return read_latest(spark, path, fields, ["user_id"])


def relation_read(spark: SparkSession, folder: str) -> DataFrame:
    """A query over a relation whose column names are upper-case."""
    customer = Tables(spark, folder).read("customer")
    customer.toDF(*[c.upper() for c in customer.columns]).createOrReplaceTempView(
        "tallybrook_customer"
    )
    return read_query(
        spark,
        "SELECT C_CUSTKEY, C_NAME, C_MKTSEGMENT FROM tallybrook_customer WHERE C_ACCTBAL > 0",
    )


# Orders --------------------------------------------------------------------


def order_date_parts(spark: SparkSession, folder: str) -> DataFrame:
    orders = add_date_parts(Tables(spark, folder).orders().select("id", "create_time"))
    return orders.select("id", "create_date", "create_hour")


def _state_and_batch(t: Tables) -> tuple[DataFrame, DataFrame]:
    cutoff = F.lit(STATE_CUTOFF).cast("timestamp_ntz")
    orders = t.orders().select("id", "user_id", "create_time")
    known = orders.where(F.col("create_time") < cutoff).select("user_id").distinct()
    return known.withColumn("if_consumed", F.lit("1")), orders.where(
        F.col("create_time") >= cutoff
    )


def first_order_flag(spark: SparkSession, folder: str) -> DataFrame:
    state, batch = _state_and_batch(Tables(spark, folder))
    return flag_first_orders(batch, state).select("id", "user_id", "if_first_order")


def user_state_upsert(spark: SparkSession, folder: str) -> DataFrame:
    state, batch = _state_and_batch(Tables(spark, folder))
    new = consumed_users(flag_first_orders(batch, state))
    path = work_path(spark, "users")
    # New users are first written as not having ordered.
    upsert(state.unionByName(new.withColumn("if_consumed", F.lit("0"))), path, 0, keys=["user_id"])
    upsert(new, path, 1, keys=["user_id"])
    return read_latest(spark, path, USER_STATE, ["user_id"])


def order_province(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    out = add_province(t.orders_with_province_id(), t.province())
    return out.select("id", "province_name")


def order_user(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return add_user(t.orders(), t.users()).select("id", "user_age_group", "user_gender")


# Lines and the wide fact ---------------------------------------------------


def detail_sku(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    numbered = by_heat(
        t.lines(),
        "order_id",
        t.hot_orders(),
        number_lines,
        lambda rows: number_lines(rows, split=True),
    )
    out = add_sku(as_details(numbered), t.stored_skus())
    return out.select(
        F.col("id").alias("detail_id"),
        *SKU_COLUMNS,
    )


def wide_rows(t: Tables, orders: DataFrame, sku: DataFrame | None, finish=None) -> DataFrame:
    """Orders joined with priced, numbered lines; ``finish`` runs on each route.

    Price and sku names are put together before they meet the lines: that join
    stands alone on its key, so adaptive execution can split a part most lines
    name, and the lines are shuffled by part once and by order once.
    """
    hot = t.hot_orders()
    parts = t.prices()
    if sku is not None:
        parts = lookup(parts, sku, "l_partkey", {c: c for c in SKU_COLUMNS})

    def build(split: bool) -> Callable[[DataFrame], DataFrame]:
        def run(lines: DataFrame) -> DataFrame:
            details = as_details(number_lines(lines, split, priced=True))
            extra = {"original_cents": F.col("original_cents")}
            wide = merge_wide(orders, details, detail_extra=extra)
            return wide if finish is None else finish(wide, split)

        return run

    # Lines of unknown parts stay, without price and names.
    lines = t.lines().join(parts, "l_partkey", "left")
    return by_heat(lines, "order_id", hot, build(False), build(True))


def _share(wide: DataFrame, split: bool) -> DataFrame:
    rows = wide.withColumns(
        {
            "amount_cents": F.coalesce(cents(F.col("sku_price")), F.lit(0).cast("bigint"))
            * F.col("sku_num"),
            "final_cents": cents(F.col("final_total_amount")),
        }
    )
    chunk = F.floor(F.col("order_detail_id") / CHUNK_IDS) if split else None
    shared = allocate_cents(rows, ["order_detail_id"], chunk)
    return shared.withColumn("final_detail_amount", from_cents(F.col("final_detail_cents")))


SKU_COLUMNS = ("spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")
WIDE_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "sku_price", "sku_num", "sku_name", "original_total_amount", "final_total_amount",
    "if_first_order", "province_name", "province_area_code", "user_age_group",
    "user_gender", "dt", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
    "category3_name",
]


def _order_facts(t: Tables) -> DataFrame:
    """Orders with everything the wide fact takes from them."""
    # Everything known about a user first, then one join with the orders.
    labels = {"age_group": "user_age_group", "gender_name": "user_gender"}
    people = lookup(t.homes(), t.users(), "user_id", labels)
    orders = t.orders().join(people, "user_id", "left")
    return flag_first_orders(add_date_parts(add_province(orders, t.province())))


def order_wide_join(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    wide = wide_rows(t, _order_facts(t), t.stored_skus())
    total = from_cents(F.col("original_cents"))
    return _surface(wide.withColumn("original_total_amount", total).select(*WIDE_COLUMNS))


def order_wide_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Wide rows delivered twice, kept once."""
    t = Tables(spark, folder)
    wide = wide_rows(t, t.orders(), None)
    twice = wide.withColumn("_delivery", F.explode(F.array(F.lit(0), F.lit(1))))
    once = distinct_by_key(twice.drop("_delivery"), ["order_id", "order_detail_id"])
    return _surface(
        once.select(
            "order_id", "order_detail_id", "user_id", "sku_id", "sku_num", "sku_price"
        )
    )


def order_amount_split(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    shares = wide_rows(t, t.orders(), None, _share)
    return _surface(shares.select("order_id", "order_detail_id", "final_detail_amount"))


def _shares_by_sku(t: Tables) -> DataFrame:
    """Shares summed per sku first, so that only sums meet the sku dimension."""
    shares = wide_rows(t, t.orders(), None, _share)
    return shares.groupBy("sku_id").agg(
        F.min("create_time").alias("create_time"),
        from_cents(F.sum("final_detail_cents")).alias("final_detail_amount"),
    )


def spu_amount_sum(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    named = lookup(t.plain_skus(), t.spus(), "spu_id", {"spu_name": "spu_name"})
    names = {"spu_id": "spu_id", "spu_name": "spu_name"}
    rows = lookup(_shares_by_sku(t), t.stored_skus(named), "sku_id", names)
    return spu_amounts(rows).withColumn("amount", F.col("amount").cast("double"))


def trademark_amount_sum(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    named = lookup(t.plain_skus(), t.trademarks(), "tm_id", {"tm_name": "tm_name"})
    names = {"tm_id": "tm_id", "tm_name": "tm_name"}
    rows = lookup(_shares_by_sku(t), t.stored_skus(named), "sku_id", names)
    sums = trademark_amounts(rows, F.lit(STAT_TIME))
    return sums.withColumn("amount", F.col("amount").cast("double"))


def shares_with_names(t: Tables) -> DataFrame:
    """Wide rows with their shares and the columns the marts read."""
    shares = wide_rows(t, t.orders(), None, _share)
    lines = shares.select("order_id", "order_detail_id", "create_time", "sku_id",
                          "final_detail_amount")
    names = {c: c for c in ("spu_id", "spu_name", "tm_id", "tm_name")}
    return lookup(lines, t.stored_skus(), "sku_id", names)


def idempotent_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Trademark sums written as the same batch twice, present once."""
    path = work_path(spark, "results")
    rows = trademark_amount_sum(spark, folder)
    for _attempt in range(2):
        write_result(rows, path, "trademark_amount_sum", 7)
    return read_results(spark, path)


def sliding_window_join_query(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and lines shipped within neighbouring 30-day slides."""
    t = Tables(spark, folder)
    days = 30

    def slide(ts: str):
        gap = F.datediff(F.col(ts), F.lit("1970-01-01").cast("date"))
        return F.floor(gap / days).cast("bigint")

    a = t.read("orders").select(
        F.col("o_orderkey").alias("order_id"), slide("o_orderdate").alias("order_slide")
    )
    b = t.read("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        slide("l_shipdate").alias("ship_slide"),
    )
    return sliding_window_join(a, b, "order_id", "order_slide", "ship_slide")


# Search --------------------------------------------------------------------


def match_search_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = Tables(spark, folder).read("documents").select("doc_id", "n_chars", "text")
    hits = match_search(docs, "text", SEARCH, ["n_chars", "doc_id"])
    return hits.select("doc_id", "n_chars")


def match_search_index(spark: SparkSession, folder: str) -> DataFrame:
    """The same search through an index of the documents."""
    docs = Tables(spark, folder).read("documents").select("doc_id", "n_chars", "text")
    path = work_path(spark, "index")
    build_index(docs, "text", ["n_chars", "doc_id"], path)
    return search_index(spark, path, SEARCH).select("doc_id", "n_chars")


BATCH_QUERIES: dict[str, Query] = {
    "json_parse": json_parse,
    "cdc_canal_route": cdc_canal_route,
    "cdc_maxwell_route": cdc_maxwell_route,
    "topic_fanout": topic_fanout,
    "topic_values": topic_values,
    "dau_first_visit": dau_first_visit,
    "dau_upsert_by_day": dau_upsert_by_day,
    "user_age_gender": user_age_gender,
    "sku_enrich": sku_enrich,
    "dim_lookup_by_keys": dim_lookup_by_keys,
    "dim_upsert_latest": dim_upsert_latest,
    "relation_read": relation_read,
    "order_date_parts": order_date_parts,
    "first_order_flag": first_order_flag,
    "user_state_upsert": user_state_upsert,
    "order_province": order_province,
    "order_user": order_user,
    "detail_sku": detail_sku,
    "order_wide_join": order_wide_join,
    "order_wide_dedup": order_wide_dedup,
    "order_amount_split": order_amount_split,
    "spu_amount_sum": spu_amount_sum,
    "trademark_amount_sum": trademark_amount_sum,
    "idempotent_sink": idempotent_sink,
    "sliding_window_join": sliding_window_join_query,
    "match_search": match_search_query,
    "match_search_index": match_search_index,
}
