"""The warehouse's streaming jobs: one function per job, each starts one query.

Arrival time (the topic's ``timestamp``) drives joins and expiry, so records that
describe old events are not treated as late.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallybrook import schemas
from tallybrook.functions import times
from tallybrook.operators.activity import VISIT_KEY, visits
from tallybrook.operators.allocation import allocate_batch, sums_after
from tallybrook.operators.cdc import DEAD_LETTER_TOPIC, route_canal, route_maxwell
from tallybrook.operators.known import first_touches
from tallybrook.operators.lookup import add_province, add_sku, add_user, enrich_sku
from tallybrook.operators.marts import SPU_MART, TRADEMARK_MART, Mart, spu_amounts, trademark_amounts
from tallybrook.operators.orders import add_date_parts, consumed_users, flag_first_orders
from tallybrook.operators.records import parse_json, topic_rows
from tallybrook.operators.users import label_users
from tallybrook.operators.wide import merge_wide, new_pairs
from tallybrook.operators.windows import Windows
from tallybrook.session import few_states, settled
from tallybrook.sources.manifests import Commit
from tallybrook.sources.tables import (
    AT,
    BATCH,
    DELETED,
    compact_parts,
    read_batch,
    read_for_keys,
    read_latest,
    read_versions,
    upsert,
    versions_for_keys,
)
from tallybrook.sources.topics import send, send_stream
from tallybrook.streaming.warehouse import Warehouse, newest

CANAL_TOPIC = "ODS_DB_CANAL"
MAXWELL_TOPIC = "ODS_DB_MAXWELL"
START_TOPIC = "START_LOG"
ORDER_TOPIC = "DW_ORDER_INFO"
DETAIL_TOPIC = "DW_ORDER_DETAIL"
WIDE_TOPIC = "DWS_ORDER_DETAIL_WIDE"
UNMATCHED_TOPIC = "DWS_UNMATCHED"
LATE_TOPIC = "ADS_LATE"

JOIN_REACH = "15 seconds"
# How far one side of a join may lag behind the other before its rows are dropped.
LAG = "6 hours"
WINDOWS = Windows(width=15_000, slide=5_000, lag=60_000)
VISIT_TTL_MS = 7 * 86_400_000
# How long after an order's last line its sums are known to later ones.
SPLIT_TTL_MS = 600_000
# How far behind the newest rows orders and lines may still meet or be repeated: twice the lag.
WIDE_TTL_MS = 12 * 3_600_000

# What orders messages of a key; kept when they are passed on.
ARRIVAL = ["timestamp", "offset"]
# Tables whose key is not called id.
KEY_FIELDS = {"base_trademark": "tm_id"}


# Change capture ------------------------------------------------------------


def ods_canal(
    spark: SparkSession, w: Warehouse, topic: str = CANAL_TOPIC, tombstones: bool = True
) -> StreamingQuery:
    """Route array envelopes; rows of deletes become tombstones, or pass like any other row."""
    routed = route_canal(
        w.messages(spark, topic),
        keep=ARRIVAL,
        key_fields=KEY_FIELDS,
        dead_letter=DEAD_LETTER_TOPIC,
        tombstones=tombstones,
    )
    number = w.numbers(spark, "ods_canal")
    return w.start(send_stream(routed, w.topics, "ods_canal", number), "ods_canal")


def ods_maxwell(
    spark: SparkSession, w: Warehouse, topic: str = MAXWELL_TOPIC, tombstones: bool = False
) -> StreamingQuery:
    """Route object envelopes; deletes become tombstones, or go nowhere."""
    routed = route_maxwell(
        w.messages(spark, topic),
        keep=ARRIVAL,
        key_fields=KEY_FIELDS,
        dead_letter=DEAD_LETTER_TOPIC,
        tombstones=tombstones,
    ).drop("type")
    number = w.numbers(spark, "ods_maxwell")
    return w.start(send_stream(routed, w.topics, "ods_maxwell", number), "ods_maxwell")


# Dimensions ----------------------------------------------------------------


@dataclass(frozen=True)
class Dimension:
    """A dimension fed by a topic.

    ``columns`` names the record's columns by position as the table has them. A dimension
    that grows with the business is kept in buckets by id (``large``), of which facts read
    only those they need.
    """

    name: str
    topic: str
    schema: str
    columns: list[str] | None = None
    prepare: Callable[[SparkSession, Warehouse, DataFrame], DataFrame] | None = None
    large: bool = False


def _sku_names(spark: SparkSession, w: Warehouse, rows: DataFrame) -> DataFrame:
    return enrich_sku(
        rows,
        w.dimension(spark, "base_category3", schemas.BASE_CATEGORY3),
        w.dimension(spark, "base_trademark", schemas.BASE_TRADEMARK),
        w.dimension(spark, "spu_info", schemas.SPU_INFO),
    )


DIMENSIONS = {
    d.name: d
    for d in (
        Dimension("base_province", "ODS_T_BASE_PROVINCE", schemas.BASE_PROVINCE),
        Dimension("base_category3", "ODS_T_BASE_CATEGORY3", schemas.BASE_CATEGORY3),
        Dimension(
            "base_trademark",
            "ODS_T_BASE_TRADEMARK",
            "tm_id BIGINT, tm_name STRING",
            columns=["id", "tm_name"],
        ),
        Dimension("spu_info", "ODS_T_SPU_INFO", schemas.SPU_INFO),
        Dimension("sku_info", "ODS_T_SKU_INFO", schemas.SKU_INFO, prepare=_sku_names, large=True),
        Dimension(
            "user_info",
            "ODS_T_USER_INFO",
            schemas.USER_INFO,
            prepare=lambda _spark, _w, rows: label_users(rows),
            large=True,
        ),
    )
}


def dimension(spark: SparkSession, w: Warehouse, dim: Dimension) -> StreamingQuery:
    """Upsert a dimension's records by id; a message without a value deletes its key's row.

    Of several versions of a row the one whose message is youngest counts, in whatever batch
    it comes.
    """
    marked = w.messages(spark, dim.topic).withColumn(DELETED, F.col("value").isNull())
    kept = [*ARRIVAL, "key", DELETED]
    rows = parse_json(marked, dim.schema, keep=kept)
    names = [c for c in rows.columns if c not in kept]
    key, kind = names[0], dict(rows.dtypes)[names[0]]
    number = w.numbers(spark, f"dim_{dim.name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        own = F.when(F.col(DELETED), F.col("key").try_cast(kind)).otherwise(F.col(key))
        known = batch.withColumns({key: own, AT: F.unix_millis("timestamp")}).drop("key")
        last = newest(known.where(F.col(key).isNotNull()), [key])
        named = last.select(*names, DELETED, AT).toDF(*(dim.columns or names), DELETED, AT)
        if dim.prepare is not None:
            named = dim.prepare(batch.sparkSession, w, named)
        keys = ["id"] if dim.large else None
        upsert(named, w.table(dim.name), number(batch_id), keys=keys)

    return w.start(rows.writeStream.foreachBatch(write), f"dim_{dim.name}")


# Facts ---------------------------------------------------------------------


def dw_order(
    spark: SparkSession, w: Warehouse, known: DataFrame | None = None
) -> StreamingQuery:
    """Flag first orders, add province and user, send on, and record user state.

    Who has ordered before is read from the user-state table as it was before the batch, in
    the buckets of the batch's users, so it outlives checkpoints and a batch tried again flags
    the same. ``known`` (``user_id, if_consumed``) adds users that the table does not have.
    Messages and user state appear together.
    """
    parsed = w.records(spark, "ODS_T_ORDER_INFO", schemas.ORDER_INFO)
    orders = add_date_parts(parsed.where(F.col("id").isNotNull()))
    number = w.numbers(spark, "dw_order")

    def write(arrived: DataFrame, batch_id: int) -> None:
        session, n = arrived.sparkSession, number(batch_id)
        commit = w.commit(session, "dw_order", n)
        if commit.done:
            commit.publish()
            return
        arrived.persist()
        try:
            if arrived.isEmpty():
                return
            state = read_for_keys(
                w.table("user_state"), schemas.USER_STATE, "user_id", arrived, "user_id", n
            )
            if known is not None:
                state = state.unionByName(known)
            batch = flag_first_orders(arrived, state)
            province = w.dimension(session, "base_province", schemas.BASE_PROVINCE)
            users = w.dimension_for(arrived, "user_id", "user_info", schemas.USER_INFO_ENRICHED)
            rows = add_user(add_province(batch, province), users)
            send(topic_rows(rows, ORDER_TOPIC, F.col("id")), w.topics, "dw_order", n, commit)
            upsert(
                consumed_users(batch), w.table("user_state"), n, keys=["user_id"], commit=commit.path
            )
            commit.finish()
        finally:
            arrived.unpersist()

    return w.start(orders.writeStream.foreachBatch(write), "dw_order")


def dw_detail(
    spark: SparkSession, w: Warehouse, on_missing: str = "null"
) -> StreamingQuery:
    """Add the sku's names and ids to order lines; keyed by order to keep them together."""
    parsed = w.records(spark, "ODS_T_ORDER_DETAIL", schemas.ORDER_DETAIL)
    details = parsed.where(F.col("id").isNotNull())
    number = w.numbers(spark, "dw_detail")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            sku = w.dimension_for(batch, "sku_id", "sku_info", schemas.SKU_INFO_ENRICHED)
            rows = topic_rows(add_sku(batch, sku, on_missing), DETAIL_TOPIC, F.col("order_id"))
            send(rows, w.topics, "dw_detail", number(batch_id))
        finally:
            batch.unpersist()

    return w.start(details.writeStream.foreachBatch(write), "dw_detail")


def wide_sides(spark: SparkSession, w: Warehouse) -> DataFrame:
    """Orders and lines as one stream of rows that name their order (``schemas.WIDE_SIDES``)."""

    def side(name: str, topic: str, schema: str, order_id: str) -> DataFrame:
        rows = w.records(spark, topic, schema, ["timestamp"])
        record = F.struct(*[c for c in rows.columns if c != "timestamp"])
        return rows.where(F.col(order_id).isNotNull()).select(
            F.col(order_id).alias("order_id"),
            F.lit(name).alias("side"),
            "id",
            F.col("timestamp").alias("arrived"),
            record.alias(name),
        )

    orders = side("orders", ORDER_TOPIC, schemas.ORDER_INFO_ENRICHED, "id")
    lines = side("lines", DETAIL_TOPIC, schemas.ORDER_DETAIL_ENRICHED, "order_id")
    return orders.unionByName(lines, allowMissingColumns=True)


def _of_side(rows: DataFrame, name: str) -> DataFrame:
    return rows.where(F.col("side") == name).select(f"{name}.*", "arrived", "known")


def dws_wide(
    spark: SparkSession,
    w: Warehouse,
    reach: str = JOIN_REACH,
    ttl_ms: int = SPLIT_TTL_MS,
    lag: str = LAG,
) -> StreamingQuery:
    """Join order and line topics, drop repeats, share out amounts, send on.

    Orders meet lines that arrive within ``reach`` of them, each pair once. A row is dropped only
    if it is more than ``lag`` behind the newest of both sides; choose it above the longest backlog
    of one partition. Rows lie in the table ``wide_sides``, of which a batch reads the buckets of
    its orders: what a batch joins is written and read in columns, not row by row in a state store.

    Lines of an order may come in several batches: what the earlier ones reached and were given
    is read from a table, in the buckets of the batch's orders, unless the last of them is more
    than ``ttl_ms`` older. Messages, rows and sums appear together.
    """
    number = w.numbers(spark, "dws_wide")
    table, progress = w.table("wide_sides"), w.table("wide_progress")

    def write(batch: DataFrame, batch_id: int) -> None:
        n = number(batch_id)
        commit = w.commit(spark, "dws_wide", n)
        if commit.done:
            commit.publish()
            return
        before = read_latest(spark, progress, schemas.PROGRESS, ["name"], before_batch=n)
        newest_of = [r.newest for r in before.collect()]  # one row per side
        if len(newest_of) == 2:  # else one side has not come yet, and nothing is late
            newest_both = F.timestamp_millis(F.lit(min(newest_of)))
            batch = batch.where(F.col("arrived") > newest_both - F.expr(f"INTERVAL {lag}"))
        upsert(batch, table, n, keys=["order_id"], commit=commit.path)
        come = read_batch(spark, table, schemas.WIDE_SIDES, n)
        at = come.select(F.col("side").alias("name"), F.unix_millis("arrived").alias("newest"))
        now = before.unionByName(at).where("newest IS NOT NULL").groupBy("name").agg(F.max("newest").alias("newest"))
        upsert(now, progress, n, commit=commit.path)
        earlier = versions_for_keys(table, schemas.WIDE_SIDES, "order_id", come, "order_id", n)
        rows = come.withColumn("known", F.lit(False)).unionByName(
            earlier.drop(BATCH).withColumn("known", F.lit(True))
        )
        pairs = new_pairs(_of_side(rows, "orders"), _of_side(rows, "lines"), reach)
        with settled(spark, pairs, "wide") as arrived:
            if not arrived.isEmpty():
                _share_out(arrived, n, commit)
        commit.finish()

    def _share_out(arrived: DataFrame, n: int, commit: Commit) -> None:
        at = F.max(F.unix_millis("order_at"))
        known = read_for_keys(
            w.table("order_sums"), schemas.ORDER_SUMS, "order_id", arrived, "order_id", n
        )
        now = arrived.groupBy(F.col("order_id").alias("_order")).agg(at.alias("_at"))
        fresh = known.join(now, F.col("order_id") == F.col("_order")).where(
            F.col("_at") <= F.col("at") + ttl_ms
        )
        with settled(spark, fresh.drop("_order", "_at", "at"), "sums") as before:
            shares, _ = allocate_batch(arrived, before)
            with settled(spark, shares, "shares") as shared:
                rows = topic_rows(shared.drop("order_at"), WIDE_TOPIC)
                send(rows, w.topics, "dws_wide", n, commit)
                after = sums_after(shared, before, {"at": at})
                upsert(after, w.table("order_sums"), n, keys=["order_id"], commit=commit.path)

    return w.start(wide_sides(spark, w).writeStream.foreachBatch(write), "dws_wide")


def dws_unmatched(
    spark: SparkSession, w: Warehouse, reach: str = JOIN_REACH, lag: str = LAG
) -> StreamingQuery:
    """Orders and lines that ``dws_wide`` drops because the other side never came.

    Once both topics are ``lag`` past a row, one that met nobody within ``reach`` goes to the
    topic ``DWS_UNMATCHED`` with the reason. The state holds ids and times only.
    """
    orders = w.records(spark, ORDER_TOPIC, "id BIGINT", ["timestamp"]).where("id IS NOT NULL")
    lines = w.records(spark, DETAIL_TOPIC, "id BIGINT, order_id BIGINT", ["timestamp"])
    near = F.expr(
        f"line_at BETWEEN order_at - INTERVAL {reach} AND order_at + INTERVAL {reach}"
    )
    both = merge_wide(
        orders.withWatermark("timestamp", lag),
        lines.where("order_id IS NOT NULL").withWatermark("timestamp", lag),
        order_extra={"order_at": F.col("timestamp")},
        detail_extra={"line_at": F.col("timestamp"), "of_order": F.col("order_id")},
        condition=near,
        how="full_outer",
    )
    number = w.numbers(spark, "dws_unmatched")

    def write(batch: DataFrame, batch_id: int) -> None:
        lonely = batch.where(F.col("order_id").isNull() | F.col("of_order").isNull())
        rows = lonely.select(
            F.coalesce("order_id", "of_order").alias("order_id"),
            "order_detail_id",
            F.when(F.col("of_order").isNull(), "no lines").otherwise("no order").alias("reason"),
            F.coalesce("order_at", "line_at").alias("arrived"),
        ).dropDuplicates(["order_id", "order_detail_id"])
        out = topic_rows(rows, UNMATCHED_TOPIC, F.col("order_id"))
        send(out, w.topics, "dws_unmatched", number(batch_id))

    with few_states(spark):
        return w.start(both.writeStream.foreachBatch(write), "dws_unmatched")


def compact_tables(
    spark: SparkSession,
    w: Warehouse,
    most: int = 64,
    split_ttl_ms: int = SPLIT_TTL_MS,
    visit_ttl_ms: int = VISIT_TTL_MS,
    windows: Windows = WINDOWS,
    wide_ttl_ms: int = WIDE_TTL_MS,
) -> dict[str, list[str]]:
    """Rewrite the parts of the jobs' tables that lie in more than ``most`` folders.

    May run beside the jobs. Sums of orders whose last line is ``split_ttl_ms`` behind the
    newest one are dropped, and so are devices last seen ``visit_ttl_ms`` before the newest
    visit, and closed windows. Orders and lines ``wide_ttl_ms`` behind the newest of both sides are
    dropped: choose it above the lag of ``dws_wide`` with its reach, and above twice that lag.
    Returns the parts rewritten of each table.
    """
    done = {}
    lives = {"order_sums": ("at", split_ttl_ms), "dau_seen": ("last", visit_ttl_ms)}
    come = read_latest(spark, w.table("ads_windows_progress"), schemas.PROGRESS, ["name"]).first()
    if come is not None:
        done["ads_windows_open"] = compact_parts(
            spark,
            w.table("ads_windows_open"),
            schemas.WINDOW_TOTAL,
            ["span", "ending", "group"],
            most=most,
            keep=F.col("ending") > come.newest - windows.lag,
        )
    sides = read_latest(spark, w.table("wide_progress"), schemas.PROGRESS, ["name"]).collect()
    if len(sides) == 2:
        done["wide_sides"] = compact_parts(
            spark,
            w.table("wide_sides"),
            schemas.WIDE_SIDES,
            ["order_id"],
            most=most,
            keep=F.unix_millis("arrived") >= min(r.newest for r in sides) - wide_ttl_ms,
            within=["side", "id", "arrived"],
        )
    for name, schema, key in (
        ("user_info", schemas.USER_INFO_ENRICHED, "id"),
        ("sku_info", schemas.SKU_INFO_ENRICHED, "id"),
        ("user_state", schemas.USER_STATE, "user_id"),
        ("order_sums", schemas.ORDER_SUMS, "order_id"),
        ("dau_seen", schemas.SEEN, "key"),
        ("spu_total", SPU_MART.schema, "key"),
        ("trademark_total", TRADEMARK_MART.schema, "key"),
        ("ads_windows_progress", schemas.PROGRESS, "name"),
        ("wide_progress", schemas.PROGRESS, "name"),
    ):
        keep = None
        if name in lives:
            at, ttl_ms = lives[name]
            newest_at = read_versions(spark, w.table(name), schema).agg(F.max(at)).first()[0]
            keep = F.col(at) >= (newest_at or 0) - ttl_ms
        done[name] = compact_parts(spark, w.table(name), schema, [key], most=most, keep=keep)
    return done


# Marts ---------------------------------------------------------------------


def ads_spu(spark: SparkSession, w: Warehouse) -> StreamingQuery:
    rows = w.records(spark, WIDE_TOPIC, schemas.SPU_AMOUNT)
    return _mart(spark, w, "spu", rows, spu_amounts, SPU_MART)


def ads_trademark(spark: SparkSession, w: Warehouse) -> StreamingQuery:
    def sums(batch: DataFrame) -> DataFrame:
        return trademark_amounts(batch, times.statement_time(F.current_timestamp()))

    rows = w.records(spark, WIDE_TOPIC, schemas.TRADEMARK_AMOUNT)
    return _mart(spark, w, "trademark", rows, sums, TRADEMARK_MART)


def _mart(
    spark: SparkSession,
    w: Warehouse,
    name: str,
    rows: DataFrame,
    sums: Callable[[DataFrame], DataFrame],
    mart: Mart,
) -> StreamingQuery:
    """Sums of every batch as results, and added to the running totals of their groups.

    Totals are one row per group in the table ``<name>_total``. A batch reads those of its own
    groups as they were before it, so one that is tried again adds nothing twice. Results and
    totals appear together, unless results go to a sink of their own.
    """
    number = w.numbers(spark, f"ads_{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        session, n = batch.sparkSession, number(batch_id)
        commit = w.commit(session, f"ads_{name}", n)
        if commit.done:
            return
        partial = sums(batch).persist()
        try:
            w.save_result(partial, f"{name}_amount", f"ads_{name}", n, commit.path)
            keyed = mart.keyed(partial)
            before = read_for_keys(w.table(f"{name}_total"), mart.schema, "key", keyed, "key", n)
            upsert(mart.merged(before, keyed), w.table(f"{name}_total"), n, keys=["key"], commit=commit.path)
            commit.finish()
        finally:
            partial.unpersist()

    return w.start(rows.writeStream.foreachBatch(write), f"ads_{name}")


def read_totals(spark: SparkSession, w: Warehouse, name: str) -> DataFrame:
    """The running totals of ``spu`` or ``trademark``: one row per group."""
    mart = {"spu": SPU_MART, "trademark": TRADEMARK_MART}[name]
    return read_latest(spark, w.table(f"{name}_total"), mart.schema, ["key"]).drop("key")


def ads_windows(
    spark: SparkSession, w: Warehouse, windows: Windows = WINDOWS, at: str | None = None
) -> StreamingQuery:
    """Amounts by trademark in sliding windows of event time, each written once, when it closes.

    Sums of open windows lie in a table by span of time, of which a batch reads the spans that
    its rows and the closing windows are in. Rows that come after all of their windows were
    closed go to the topic ``ADS_LATE`` as they are. Event time is the message's, or the field
    ``at`` (epoch ms) of the record. Everything a batch writes appears together.
    """
    name = "ads_windows"
    fields = schemas.TRADEMARK_AMOUNT + (f", {at} BIGINT" if at else "")
    rows = w.records(spark, WIDE_TOPIC, fields, keep=["timestamp", "value"])
    timed = rows.withColumn("at", F.col(at) if at else F.unix_millis("timestamp"))
    number = w.numbers(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        session, n = batch.sparkSession, number(batch_id)
        commit = w.commit(session, name, n)
        if commit.done:
            commit.publish()
            return
        batch = batch.where("at IS NOT NULL").persist()
        try:
            newest_here = batch.agg(F.max("at")).first()[0]
            if newest_here is None:
                return
            table = w.table(f"{name}_progress")
            before = read_latest(session, table, schemas.PROGRESS, ["name"], before_batch=n).first()
            closed = before.newest - windows.lag if before else None
            newest_now = max(newest_here, before.newest) if before else newest_here
            late = windows.is_late(F.col("at"), closed)
            lost = batch.where(late).select(
                F.lit(LATE_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"), "value"
            )
            partial = windows.partial(batch, "at", "tm_id", "final_detail_amount", closed)
            closing = newest_now - windows.lag
            # Spans of the batch's windows and of those that close now: two ranges of folders.
            low, high = partial.agg(F.min("span"), F.max("span")).first()
            stored = read_latest(
                session, w.table(f"{name}_open"), schemas.WINDOW_TOTAL, ["span", "ending", "group"], before_batch=n
            )
            own = F.col("span").between(*((0, -1) if low is None else (low, high)))
            ends = F.col("ending") <= closing
            spans = F.col("span") <= windows.span(F.lit(closing))
            if closed is not None:
                ends = ends & (F.col("ending") > closed)
                spans = spans & (F.col("span") >= windows.span(F.lit(closed)))
            seen = stored.where(own | spans).where(F.lit(True) if closed is None else F.col("ending") > closed)
            totals = windows.added(seen.unionByName(partial)).persist()
            done = totals.where(ends).select((F.col("ending") - windows.width).alias("starting"), "ending",
                                             F.col("group").alias("tm_id"), "amount", "n")
            w.save_result(done, "window_amount", name, n, commit.path)
            left = totals.where(own & (F.col("ending") > closing))
            upsert(left, w.table(f"{name}_open"), n, partition_by=["span"], commit=commit.path)
            now = session.createDataFrame([(name, newest_now)], schemas.PROGRESS)
            upsert(now, table, n, commit=commit.path)
            send(lost, w.topics, name, n, commit)
            commit.finish()
            totals.unpersist()
        finally:
            batch.unpersist()

    return w.start(timed.writeStream.foreachBatch(write), name)


# Activity ------------------------------------------------------------------


def dau(
    spark: SparkSession, w: Warehouse, topic: str = START_TOPIC, ttl_ms: int = VISIT_TTL_MS
) -> StreamingQuery:
    """The first arrived visit of each device and day, upserted by day of the visit.

    A device and day is known for ``ttl_ms`` after each of its visits arrived.
    """
    logs = w.records(spark, topic, schemas.START_LOG, keep=ARRIVAL)
    rows = visits(logs, keep=ARRIVAL).where(F.col("mid").isNotNull())
    keyed = rows.withColumns(
        {"key": F.concat_ws("|", *VISIT_KEY), "at": F.unix_millis("timestamp")}
    )
    return first_seen(spark, w, "dau", keyed, ttl_ms, ["offset", "ts"], ["dt"])


def first_seen(
    spark: SparkSession,
    w: Warehouse,
    name: str,
    rows: DataFrame,
    ttl_ms: int,
    order_by: list[str],
    partition_by: list[str],
) -> StreamingQuery:
    """Keep the rows whose ``key`` is not known at ``at`` (ms) in the table ``name``.

    Which keys are known is read from the table ``<name>_seen``, in the buckets of the batch's
    keys, and renewed there by every row. Both tables change together.
    """
    number = w.numbers(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        session, n = batch.sparkSession, number(batch_id)
        commit = w.commit(session, name, n)
        if commit.done:
            return
        batch.persist()
        try:
            if batch.isEmpty():
                return
            known = read_for_keys(w.table(f"{name}_seen"), schemas.SEEN, "key", batch, "key", n)
            new, after = first_touches(batch, "key", "at", ttl_ms, known, order_by)
            kept = new.drop("key", "at", *ARRIVAL)
            upsert(kept, w.table(name), n, partition_by=partition_by, commit=commit.path)
            upsert(after, w.table(f"{name}_seen"), n, keys=["key"], commit=commit.path)
            commit.finish()
        finally:
            batch.unpersist()

    return w.start(rows.writeStream.foreachBatch(write), name)


JOBS: dict[str, Callable[[SparkSession, Warehouse], StreamingQuery]] = {
    "ods_canal": ods_canal,
    "ods_maxwell": ods_maxwell,
    **{
        f"dim_{name}": (lambda spark, w, d=d: dimension(spark, w, d))
        for name, d in DIMENSIONS.items()
    },
    "dw_order": dw_order,
    "dw_detail": dw_detail,
    "dws_wide": dws_wide,
    "dws_unmatched": dws_unmatched,
    "ads_spu": ads_spu,
    "ads_trademark": ads_trademark,
    "ads_windows": ads_windows,
    "dau": dau,
}
