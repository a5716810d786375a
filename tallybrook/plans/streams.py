"""The streaming jobs run over the test tables, as queries.

Tables are sent to topics first; jobs read what is there, in file topics under the
shared folder, and the query is what they left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import schemas
from tallybrook.functions import times
from tallybrook.functions.money import from_cents
from tallybrook.operators.records import parse_json, topic_rows
from tallybrook.operators.windows import Windows
from tallybrook.plans import queries as batch
from tallybrook.plans.tables import MOST_LINES, Tables
from tallybrook.session import settled, streaming_session, work_path
from tallybrook.sources.results import read_results
from tallybrook.sources.tables import read_latest, read_versions
from tallybrook.sources.topics import TopicStore, read_topic_log, send
from tallybrook.streaming import jobs
from tallybrook.streaming.warehouse import Warehouse

# A device not seen for longer than this is a returning one.
RETURN_MS = 3 * 86_400_000
_HOUR = 3_600_000


def _warehouse(spark: SparkSession, name: str) -> tuple[SparkSession, Warehouse]:
    base = work_path(spark, name)
    w = Warehouse(
        topics=TopicStore(location=f"{base}/topics"),
        tables=f"{base}/tables",
        checkpoints=f"{base}/checkpoints",
        trigger={"availableNow": True},
    )
    return streaming_session(spark), w


def _run(spark: SparkSession, w: Warehouse, *names: str) -> None:
    """Run jobs one after the other until each has read all there is."""
    for name in names:
        jobs.JOBS[name](spark, w).awaitTermination()


def _fill(w: Warehouse, rows: DataFrame, topic: str, key: str | None = None) -> None:
    send(topic_rows(rows, topic, None if key is None else F.col(key)), w.topics, "fill", 0)


def dau_stream(spark: SparkSession, folder: str) -> DataFrame:
    s, w = _warehouse(spark, "dau")
    common = F.struct(F.col("user_id").cast("string").alias("mid"), F.col("event_type").alias("ch"))
    ts = F.unix_millis(F.col("ts").cast("timestamp"))
    logs = Tables(s, folder).read("events").select(common.alias("common"), ts.alias("ts"))
    _fill(w, logs, jobs.START_TOPIC)
    _run(s, w, "dau")
    found = read_latest(spark, w.table("dau"), "mid STRING, dt STRING", ["dt", "mid"])
    return found.select(F.col("mid").cast("bigint").alias("mid"), "dt")


def cdc_stream(spark: SparkSession, folder: str) -> DataFrame:
    s, w = _warehouse(spark, "cdc")
    envelopes = batch.maxwell_envelopes(Tables(s, folder))
    rows = envelopes.select(
        F.lit(jobs.MAXWELL_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"), "value"
    )
    send(rows, w.topics, "fill", 0)
    _run(s, w, "ods_maxwell")
    sent = read_topic_log(spark, w.topics).where(F.col("topic") != jobs.MAXWELL_TOPIC)
    return sent.select("topic", "key")


def sku_dimension_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Category, trademark and spu topics, then the sku topic that takes their names."""
    s, w = _warehouse(spark, "sku")
    t = Tables(s, folder)
    _fill(w, t.categories(), "ODS_T_BASE_CATEGORY3", "id")
    _fill(w, t.trademarks().withColumnRenamed("id", "tm_id"), "ODS_T_BASE_TRADEMARK", "tm_id")
    _fill(w, t.spus(), "ODS_T_SPU_INFO", "id")
    _fill(w, t.plain_skus().drop("p_size"), "ODS_T_SKU_INFO", "id")
    _run(s, w, "dim_base_category3", "dim_base_trademark", "dim_spu_info", "dim_sku_info")
    sku = read_latest(spark, w.table("sku_info"), schemas.SKU_INFO_ENRICHED, ["id"])
    return sku.select("id", "spu_name", "tm_name", "category3_name")


def order_fact_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Orders flagged and enriched from topics; also leaves the user state."""
    s, w = _warehouse(spark, "orders")
    t = Tables(s, folder)
    _fill(w, t.province(), "ODS_T_BASE_PROVINCE", "id")
    _fill(w, t.users().drop("age_group", "gender_name"), "ODS_T_USER_INFO", "id")
    _fill(w, t.orders_with_province_id(), "ODS_T_ORDER_INFO", "id")
    _run(s, w, "dim_base_province", "dim_user_info", "dw_order")
    log = read_topic_log(spark, w.topics, jobs.ORDER_TOPIC)
    facts = parse_json(log, schemas.ORDER_INFO_ENRICHED)
    return facts.select(
        "id", "if_first_order", "create_date", "create_hour", "province_name", "user_gender"
    )


def _line_facts(wide: DataFrame) -> DataFrame:
    """What topics take of wide rows; it is read several times, so the caller stores it."""
    return wide.select(
        "order_detail_id", "order_id", "sku_id", "sku_price", "sku_num", "original_total_amount"
    )


def order_wide_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Order and line topics joined, freed of repeats and shared out; per order."""
    s, w = _warehouse(spark, "wide")
    t = Tables(s, folder)
    wide = batch.wide_rows(t, t.orders(), None).withColumn(
        "original_total_amount", from_cents(F.col("original_cents"))
    )
    with settled(s, _line_facts(wide), "lines") as wide:
        # Lines go out twice, as after a repeated delivery.
        lines = wide.select(
            F.col("order_detail_id").alias("id"),
            "order_id",
            "sku_id",
            F.col("sku_price").alias("order_price"),
            "sku_num",
            F.explode(F.array(F.lit(0), F.lit(1))).alias("delivery"),
        ).drop("delivery")
        totals = wide.select(F.col("order_id").alias("id"), "original_total_amount").distinct()
        _fill(w, t.orders().join(totals, "id"), jobs.ORDER_TOPIC, "id")
        _fill(w, lines, jobs.DETAIL_TOPIC, "order_id")
    # Both topics were written at once: let everything sent within a day meet.
    jobs.dws_wide(s, w, reach="1 day", lag="2 days").awaitTermination()
    rows = parse_json(read_topic_log(spark, w.topics, jobs.WIDE_TOPIC), schemas.LINE_SHARE)
    return rows.groupBy("order_id").agg(
        F.count("order_detail_id").alias("n_lines"),
        F.sum("final_detail_amount").cast("double").alias("paid"),
    )


def order_amount_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of lines that come in three batches, by number and in no order within one."""
    s, w = _warehouse(spark, "shares")
    t = Tables(s, folder)
    wide = batch.wide_rows(t, t.orders(), None).withColumn(
        "original_total_amount", from_cents(F.col("original_cents"))
    )
    with settled(s, _line_facts(wide), "lines") as wide:
        lines = wide.select(
            F.col("order_detail_id").alias("id"),
            "order_id",
            "sku_id",
            F.col("sku_price").alias("order_price"),
            "sku_num",
        )
        totals = wide.groupBy(F.col("order_id").alias("id")).agg(
            F.max("original_total_amount").alias("original_total_amount")
        )
        _fill(w, t.orders().join(totals, "id"), jobs.ORDER_TOPIC, "id")
        for k in range(3):
            part = lines.where(F.col("id") % MOST_LINES % 3 == k).repartition("sku_id")
            send(topic_rows(part, jobs.DETAIL_TOPIC, F.col("order_id")), w.topics, "fill", k)
            jobs.dws_wide(s, w, reach="1 day", lag="2 days").awaitTermination()
    rows = parse_json(read_topic_log(spark, w.topics, jobs.WIDE_TOPIC), schemas.LINE_SHARE)
    amount = F.col("final_detail_amount").cast("double").alias("final_detail_amount")
    return rows.select("order_id", "order_detail_id", amount)


def _wide_topic(s: SparkSession, w: Warehouse, folder: str) -> None:
    rows = batch.shares_with_names(Tables(s, folder))
    _fill(w, rows, jobs.WIDE_TOPIC)


def trademark_amount_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Running totals, read as they stand."""
    s, w = _warehouse(spark, "trademark")
    _wide_topic(s, w, folder)
    _run(s, w, "ads_trademark")
    totals = jobs.read_totals(spark, w, "trademark")
    return totals.select("tm_id", "tm_name", F.col("amount").cast("double").alias("amount"))


def spu_amount_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Running totals, read as they stand."""
    s, w = _warehouse(spark, "spu")
    _wide_topic(s, w, folder)
    _run(s, w, "ads_spu")
    totals = jobs.read_totals(spark, w, "spu")
    return totals.withColumn("amount", F.col("amount").cast("double"))


def order_wide_unmatched_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without lines and lines without their order, after both topics have gone on."""
    s, w = _warehouse(spark, "unmatched")
    t = Tables(s, folder)
    at = F.lit("2020-05-12 10:00:00").cast("timestamp")
    orders = t.read("orders").where("o_custkey % 7 <> 0").select(F.col("o_orderkey").alias("id"))
    lines = t.read("lineitem").where("l_orderkey % 5 <> 0").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").alias("order_id"),
    )
    last = s.range(1).select(F.lit(-1).cast("bigint").alias("id"), F.lit(-1).cast("bigint").alias("order_id"))
    for k, (rows, side) in enumerate([(orders, lines), (last.select("id"), last)]):
        when = at + F.expr(f"INTERVAL {3 * k} DAYS")
        for part, topic in ((rows, jobs.ORDER_TOPIC), (side, jobs.DETAIL_TOPIC)):
            messages = topic_rows(part, topic, F.col("id")).withColumn("timestamp", when)
            send(messages.withColumn("offset", F.lit(None).cast("bigint")), w.topics, "fill", k)
        jobs.dws_unmatched(s, w, lag="1 hour").awaitTermination()
    rows = parse_json(
        read_topic_log(spark, w.topics, jobs.UNMATCHED_TOPIC),
        "order_id BIGINT, order_detail_id BIGINT, reason STRING",
    )
    return rows.groupBy("order_id", "reason").agg(F.count("order_detail_id").alias("n_lines"))


def dim_delete_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Users inserted, changed and deleted, some inserted again; one delete comes too late."""
    s, w = _warehouse(spark, "deletes")
    users = Tables(s, folder).read("customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")

    def change(rows: DataFrame, kind: str, level: Column, hours: float) -> DataFrame:
        row = F.struct("id", level.alias("user_level"))
        envelope = F.struct(F.lit("user_info").alias("table"), F.lit(kind).alias("type"), F.array(row).alias("data"))
        at = F.lit("2020-05-12 10:00:00").cast("timestamp") + F.expr(f"INTERVAL {int(60 * hours)} MINUTES")
        return rows.select(
            F.lit(jobs.CANAL_TOPIC).alias("topic"),
            F.lit(None).cast("string").alias("key"),
            F.to_json(envelope).alias("value"),
            at.alias("timestamp"),
            F.lit(None).cast("bigint").alias("offset"),
        )

    segment = F.col("c_mktsegment")
    batches = [
        [change(users, "INSERT", segment, 0)],
        [
            change(users.where("id % 5 = 0"), "DELETE", segment, 1),
            change(users.where("id % 5 = 1"), "UPDATE", F.lit("changed"), 1),
        ],
        [
            change(users.where("id % 10 = 0"), "INSERT", F.lit("again"), 2),
            change(users.where("id % 10 = 1"), "DELETE", segment, 0.5),
        ],
    ]
    for k, parts in enumerate(batches):
        for i, part in enumerate(parts):
            send(part, w.topics, f"fill{i}", k)
        _run(s, w, "ods_canal", "dim_user_info")
    found = read_latest(spark, w.table("user_info"), schemas.USER_INFO_ENRICHED, ["id"])
    return found.select("id", "user_level")


def returning_device_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events of devices not seen for a while, in three batches by time."""
    s, w = _warehouse(spark, "returning")
    events = Tables(s, folder).read("events").select(
        F.col("user_id").cast("string").alias("key"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        "event_id",
    )
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    width = ((high or 0) - (low or 0)) // 3 + 1
    for k in range(3):
        part = events.where(F.floor((F.col("ts") - (low or 0)) / width) == k)
        send(topic_rows(part.drop("event_id"), jobs.START_TOPIC), w.topics, "fill", k)
        log = w.records(s, jobs.START_TOPIC, "key STRING, ts BIGINT", jobs.ARRIVAL)
        rows = log.withColumns({"at": F.col("ts"), "mid": F.col("key"), "dt": times.day(times.from_epoch_ms(F.col("ts")))})
        jobs.first_seen(s, w, "returning", rows, RETURN_MS, ["ts"], ["dt"]).awaitTermination()
    found = read_versions(spark, w.table("returning"), "mid STRING, ts BIGINT, dt STRING")
    return found.select(F.col("mid").cast("bigint").alias("mid"), "ts", "dt")


def order_detail_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Sku and order line topics; lines take the sku's names."""
    s, w = _warehouse(spark, "details")
    t = Tables(s, folder)
    _fill(w, t.categories(), "ODS_T_BASE_CATEGORY3", "id")
    _fill(w, t.trademarks().withColumnRenamed("id", "tm_id"), "ODS_T_BASE_TRADEMARK", "tm_id")
    _fill(w, t.spus(), "ODS_T_SPU_INFO", "id")
    _fill(w, t.stored_skus(t.plain_skus()), "ODS_T_SKU_INFO", "id")
    lines = t.read("lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
    )
    _fill(w, lines, "ODS_T_ORDER_DETAIL", "id")
    _run(s, w, "dim_base_category3", "dim_base_trademark", "dim_spu_info", "dim_sku_info")
    _run(s, w, "dw_detail")
    rows = parse_json(
        read_topic_log(spark, w.topics, jobs.DETAIL_TOPIC), schemas.ORDER_DETAIL_ENRICHED
    )
    return rows.select("order_id", "sku_id", "sku_num", *batch.SKU_COLUMNS)


def amount_window_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Values of events by the length of their type's name, in windows of six hours every two.

    A tenth of the events comes after all windows are closed and is not counted.
    """
    s, w = _warehouse(spark, "windows")
    events = Tables(s, folder).read("events").select(
        F.length("event_type").cast("bigint").alias("tm_id"),
        F.col("value").cast("decimal(18,2)").alias("final_detail_amount"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        (F.col("event_id") % 10 == 0).alias("late"),
    )
    newest = F.lit(events.agg(F.max("ms")).first()[0] or 0).cast("bigint")
    after = s.range(1).select(
        F.lit(-1).cast("bigint").alias("tm_id"),
        F.lit(0).cast("decimal(18,2)").alias("final_detail_amount"),
        (newest + 30 * _HOUR).alias("ms"),
    )
    parts = [events.where("NOT late").drop("late"), after, events.where("late").drop("late")]
    for k, part in enumerate(parts):
        send(topic_rows(part, jobs.WIDE_TOPIC), w.topics, "fill", k)
        jobs.ads_windows(s, w, Windows(6 * _HOUR, 2 * _HOUR, _HOUR), at="ms").awaitTermination()
    found = read_results(spark, w.table("window_amount"))
    return found.select("ending", "tm_id", F.col("amount").cast("double").alias("amount"), "n")


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dau_stream": dau_stream,
    "cdc_stream": cdc_stream,
    "sku_dimension_stream": sku_dimension_stream,
    "order_fact_stream": order_fact_stream,
    "order_detail_stream": order_detail_stream,
    "order_wide_stream": order_wide_stream,
    "order_amount_stream": order_amount_stream,
    "trademark_amount_stream": trademark_amount_stream,
    "spu_amount_stream": spu_amount_stream,
    "order_wide_unmatched_stream": order_wide_unmatched_stream,
    "dim_delete_stream": dim_delete_stream,
    "amount_window_stream": amount_window_stream,
    "returning_device_stream": returning_device_stream,
}
