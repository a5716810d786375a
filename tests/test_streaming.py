"""Jobs stopped and started again, over topics that grow in between."""

import dataclasses
import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tallybrook import schemas
from tallybrook.operators.cdc import DEAD_LETTER_TOPIC
from tallybrook.operators.records import parse_json
from tallybrook.operators.windows import Windows
from tallybrook.session import streaming_session
from tallybrook.sources.manifests import Commit
from tallybrook.sources.results import read_results, write_result
from tallybrook.sources.tables import read_latest, read_versions
from tallybrook.sources.topics import TopicStore, read_topic, read_topic_log, send, to_console
from tallybrook.streaming import jobs
from tallybrook.streaming.warehouse import Warehouse

WAIT = 100


class World:
    """A warehouse of its own, messages sent to it, and jobs run until caught up."""

    def __init__(self, spark, folder, **settings):
        self.spark = streaming_session(spark)
        self.w = Warehouse(
            topics=TopicStore(location=f"{folder}/topics"),
            tables=f"{folder}/tables",
            checkpoints=f"{folder}/checkpoints",
            trigger={"availableNow": True},
            **settings,
        )
        self.sent = 0

    def send(self, topic, *records):
        rows = [(topic, str(r.get("id")), json.dumps(r)) for r in records]
        df = self.spark.createDataFrame(rows, "topic STRING, key STRING, value STRING")
        send(df.coalesce(1), self.w.topics, "test", self.sent)
        self.sent += 1

    def run(self, job, **kwargs):
        start = job if callable(job) else jobs.JOBS[job]
        query = start(self.spark, self.w, **kwargs)
        assert query.awaitTermination(WAIT), "the query did not finish"

    def log(self, topic, schema):
        return parse_json(read_topic_log(self.spark, self.w.topics, topic), schema)


def test_daily_devices_across_restarts(spark, tmp_path):
    world = World(spark, tmp_path, max_per_trigger=1)

    def log(mid, ts):
        return {"common": {"mid": mid, "ch": "web"}, "ts": ts}

    day = 86_400_000
    world.send(jobs.START_TOPIC, log("a", day), log("a", day + 1), log("b", day))
    # Far older events arrive later and are no less first visits.
    world.send(jobs.START_TOPIC, log("c", 40 * day), log("a", day + 2), log("d", 0))
    world.run("dau")
    world.send(jobs.START_TOPIC, log("a", day + 3), log("a", 2 * day), log("b", day + 5))
    world.run("dau")
    versions = read_versions(
        world.spark, world.w.table("dau"), "mid STRING, ch STRING, hr STRING, dt STRING"
    )
    got = sorted((r.dt, r.mid) for r in versions.collect())
    assert got == [
        ("1970-01-01", "d"),
        ("1970-01-02", "a"),
        ("1970-01-02", "b"),
        ("1970-01-03", "a"),
        ("1970-02-10", "c"),
    ]


def test_orders_know_earlier_batches_and_new_dimension_rows(spark, tmp_path):
    world = World(spark, tmp_path)

    def order(i, user, at):
        return {"id": i, "user_id": user, "province_id": 1, "create_time": f"2020-05-12 {at}"}

    world.send("ODS_T_BASE_PROVINCE", {"id": 1, "name": "old", "area_code": "1"})
    world.run("dim_base_province")
    known = spark.createDataFrame([(9, "1"), (8, "0")], schemas.USER_STATE)
    world.send(
        "ODS_T_ORDER_INFO",
        order(1, 5, "10:00:00"),
        order(2, 5, "09:00:00"),
        order(3, 9, "09:00:00"),
        order(4, 8, "09:00:00"),
    )
    world.run(jobs.dw_order, known=world.spark.createDataFrame(known.collect(), schemas.USER_STATE))
    world.send("ODS_T_BASE_PROVINCE", {"id": 1, "name": "new", "area_code": "1"})
    world.run("dim_base_province")
    world.send("ODS_T_ORDER_INFO", order(5, 5, "08:00:00"), order(6, 7, "08:00:00"))
    world.run(jobs.dw_order, known=world.spark.createDataFrame(known.collect(), schemas.USER_STATE))
    facts = world.log(jobs.ORDER_TOPIC, schemas.ORDER_INFO_ENRICHED).collect()
    assert {r.id: (r.if_first_order, r.province_name) for r in facts} == {
        1: ("0", "old"),
        2: ("1", "old"),
        3: ("0", "old"),
        4: ("1", "old"),
        5: ("0", "new"),
        6: ("1", "new"),
    }
    state = read_latest(world.spark, world.w.table("user_state"), schemas.USER_STATE, ["user_id"])
    assert sorted(r.user_id for r in state.collect()) == [5, 7, 8]


def test_lines_in_several_batches_share_the_whole_amount(spark, tmp_path):
    world = World(spark, tmp_path)

    def line(i, sku):
        return {"id": i, "order_id": 1, "sku_id": sku, "order_price": 10, "sku_num": 1}

    order = {"id": 1, "user_id": 5, "original_total_amount": 30, "final_total_amount": 100}
    world.send(jobs.ORDER_TOPIC, order)
    world.send(jobs.DETAIL_TOPIC, line(11, 1), line(12, 2))

    def run():
        world.run(jobs.dws_wide, reach="1 hour", ttl_ms=7_200_000)

    run()
    world.send(jobs.DETAIL_TOPIC, line(12, 2), line(13, 3))
    run()
    rows = world.log(jobs.WIDE_TOPIC, schemas.ORDER_WIDE).collect()
    shares = {r.order_detail_id: r.final_detail_amount for r in rows}
    assert len(rows) == 3
    assert sum(shares.values()) == Decimal("100.00")
    assert shares[13] == Decimal("33.34")


def test_a_lagging_pair_arrives(spark, tmp_path):
    world = World(spark, tmp_path, max_per_trigger=1)
    now = datetime(2020, 5, 12, 12)

    def at(topic, record, when):
        row = (topic, str(record["id"]), json.dumps(record), when)
        df = world.spark.createDataFrame([row], "topic STRING, key STRING, value STRING, timestamp TIMESTAMP")
        send(df, world.w.topics, "test", world.sent)
        world.sent += 1

    for i, late in ((1, 0), (2, 3600), (3, 0)):
        when = now + timedelta(seconds=10 * i - late)
        at(jobs.ORDER_TOPIC, {"id": i, "user_id": 5, "original_total_amount": 10, "final_total_amount": 9}, when)
        at(
            jobs.DETAIL_TOPIC,
            {"id": 10 + i, "order_id": i, "sku_id": 1, "order_price": 10, "sku_num": 1},
            when + timedelta(seconds=1),
        )
    world.run("dws_wide")
    rows = world.log(jobs.WIDE_TOPIC, schemas.ORDER_WIDE).collect()
    assert sorted(r.order_id for r in rows) == [1, 2, 3]


def test_the_last_of_several_updates_in_a_batch_stays(spark, tmp_path):
    world = World(spark, tmp_path)
    for version in range(3):
        rows = [
            {"table": "spu_info", "type": "update", "data": {"id": i, "spu_name": f"v{version}"}}
            for i in range(20)
        ]
        world.send(jobs.MAXWELL_TOPIC, *rows, *rows[::-1])
    world.run("ods_maxwell")
    world.run("dim_spu_info")
    spus = read_latest(world.spark, world.w.table("spu_info"), schemas.SPU_INFO, ["id"])
    assert {r.id: r.spu_name for r in spus.collect()} == {i: "v2" for i in range(20)}


def test_a_new_checkpoint_neither_replaces_nor_loses(spark, tmp_path):
    world = World(spark, tmp_path)
    for version in ("a", "b"):
        world.send("ODS_T_SPU_INFO", {"id": 1, "spu_name": version})
        world.run("dim_spu_info")
    world.send("ODS_T_SPU_INFO", {"id": 1, "spu_name": "c"})
    moved = dataclasses.replace(world.w, checkpoints=f"{tmp_path}/checkpoints2")
    jobs.JOBS["dim_spu_info"](world.spark, moved).awaitTermination()
    versions = read_versions(world.spark, world.w.table("spu_info"), schemas.SPU_INFO).collect()
    assert len(versions) == 3
    spus = read_latest(world.spark, world.w.table("spu_info"), schemas.SPU_INFO, ["id"])
    assert [r.spu_name for r in spus.collect()] == ["c"]


def test_first_orders_outlive_checkpoints_and_take_nulls(spark, tmp_path):
    world = World(spark, tmp_path)
    world.send("ODS_T_ORDER_INFO", {"id": 1, "user_id": 5}, {"id": 2, "user_id": 5, "create_time": None})
    world.run("dw_order")
    world.send("ODS_T_ORDER_INFO", {"id": 3, "user_id": 5, "create_time": "2020-05-12 10:00:00"})
    world.w = dataclasses.replace(world.w, checkpoints=f"{tmp_path}/checkpoints2")
    world.run("dw_order")
    facts = world.log(jobs.ORDER_TOPIC, schemas.ORDER_INFO_ENRICHED).collect()
    flags = {(r.id, r.if_first_order) for r in facts}
    assert {(1, "1"), (2, "0"), (3, "0")} <= flags and (3, "1") not in flags


def test_unreadable_messages_go_to_their_topic(spark, tmp_path):
    world = World(spark, tmp_path)
    world.send(jobs.MAXWELL_TOPIC, {"type": "insert", "data": {"id": 1}})
    world.run("ods_maxwell")
    lost = read_topic_log(world.spark, world.w.topics, DEAD_LETTER_TOPIC).collect()
    assert [json.loads(r.value)["data"] for r in lost] == [{"id": 1}]


def test_trademarks_are_keyed_by_their_own_id(spark, tmp_path):
    world = World(spark, tmp_path)
    row = {"table": "base_trademark", "type": "insert", "data": {"tm_id": 4, "tm_name": "x"}}
    world.send(jobs.MAXWELL_TOPIC, row)
    world.run("ods_maxwell")
    assert [r.key for r in read_topic_log(world.spark, world.w.topics, "ODS_T_BASE_TRADEMARK").collect()] == ["4"]


def test_failed_batch_is_not_counted_twice(spark, tmp_path):
    path = str(tmp_path / "sums")
    broken = []

    def sink(rows, query_id, batch_id):
        write_result(rows, path, query_id, batch_id)
        if not broken:
            broken.append(batch_id)
            raise RuntimeError("lost after writing")

    world = World(spark, tmp_path, results=sink)
    line = {"spu_id": 1, "spu_name": "a:b", "final_detail_amount": 2.5}
    world.send(jobs.WIDE_TOPIC, line, {**line, "create_time": "2020-01-01 00:00:00"})
    with pytest.raises(Exception, match="lost after writing"):
        world.run("ads_spu")
    world.run("ads_spu")
    world.send(jobs.WIDE_TOPIC, line)
    world.run("ads_spu")
    rows = sorted(read_results(world.spark, path).collect(), key=lambda r: r.batch_id)
    assert [(r.batch_id, r.spu_name, r.amount) for r in rows] == [
        (0, "a:b", Decimal("5.00")),
        (1, "a:b", Decimal("2.50")),
    ]


def test_canal_job_and_console(spark, tmp_path, capfd):
    world = World(spark, tmp_path)
    world.send(
        jobs.CANAL_TOPIC, {"table": "spu_info", "type": "INSERT", "data": [{"id": 1}, {"id": 2}]}
    )
    world.run("ods_canal")
    out = read_topic_log(world.spark, world.w.topics, "ODS_T_SPU_INFO").collect()
    assert sorted(r.key for r in out) == ["1", "2"]
    stream = read_topic(world.spark, world.w.topics, "ODS_T_SPU_INFO").select("key")
    query = to_console(stream).trigger(availableNow=True).start()
    assert query.awaitTermination(WAIT)


def test_every_job_is_named():
    assert len(jobs.JOBS) == 16


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_job_lost_at_its_commit(spark, tmp_path, monkeypatch, when):
    """Lost before the commit: neither messages nor state. After it: both, at the next start."""
    world = World(spark, tmp_path)
    world.send("ODS_T_ORDER_INFO", {"id": 1, "user_id": 5, "create_time": "2020-05-12 10:00:00"})
    step = {"before": "finish", "after": "publish"}[when]

    def lost(self):
        raise RuntimeError("lost")

    def seen():
        sent = world.log(jobs.ORDER_TOPIC, schemas.ORDER_INFO_ENRICHED)
        state = read_latest(world.spark, world.w.table("user_state"), schemas.USER_STATE, ["user_id"])
        return [r.if_first_order for r in sent.collect()], [r.user_id for r in state.collect()]

    read_topic(world.spark, world.w.topics, jobs.ORDER_TOPIC)  # makes its folder
    with monkeypatch.context() as m:
        m.setattr(Commit, step, lost)
        with pytest.raises(Exception, match="lost"):
            world.run("dw_order")
    assert seen() == (([], []) if when == "before" else ([], [5]))
    world.run("dw_order")
    assert seen() == (["1"], [5])
    world.run("dw_order")
    assert seen() == (["1"], [5])


def test_compaction_beside_the_jobs(spark, tmp_path):
    world = World(spark, tmp_path)
    for i in range(4):
        world.send("ODS_T_ORDER_INFO", {"id": i, "user_id": i % 2, "create_time": "2020-05-12 10:00:00"})
        world.run("dw_order")
        if i == 2:
            assert jobs.compact_tables(world.spark, world.w, most=0)["user_state"]
    facts = world.log(jobs.ORDER_TOPIC, schemas.ORDER_INFO_ENRICHED).collect()
    assert {r.id: r.if_first_order for r in facts} == {0: "1", 1: "1", 2: "0", 3: "0"}


def test_sums_of_old_orders_are_forgotten(spark, tmp_path):
    """Later lines share as if they were the first ones once the sums are too old."""
    world = World(spark, tmp_path)
    order = {"id": 1, "user_id": 5, "original_total_amount": 30, "final_total_amount": 100}

    def deliver(i, when):
        at = datetime(2020, 5, 12) + timedelta(seconds=when)
        line = {"id": i, "order_id": 1, "sku_id": 1, "order_price": 10, "sku_num": 1}
        for topic, record in ((jobs.ORDER_TOPIC, order), (jobs.DETAIL_TOPIC, line)):
            row = (topic, "1", json.dumps(record), at)
            df = world.spark.createDataFrame([row], "topic STRING, key STRING, value STRING, timestamp TIMESTAMP")
            send(df, world.w.topics, "test", world.sent)
            world.sent += 1
        world.run(jobs.dws_wide, ttl_ms=100_000)

    for i, when in ((1, 0), (2, 50), (3, 140), (4, 400)):
        deliver(i, when)
    rows = world.log(jobs.WIDE_TOPIC, schemas.ORDER_WIDE).collect()
    got = {r.order_detail_id: str(r.final_detail_amount) for r in rows}
    assert got == {1: "33.33", 2: "33.33", 3: "33.34", 4: "33.33"}


def test_windows_close_once_and_late_rows_are_told(spark, tmp_path):
    world = World(spark, tmp_path)
    settings = Windows(width=30, slide=10, lag=20)

    def run(*rows):
        world.send(jobs.WIDE_TOPIC, *({"tm_id": t, "final_detail_amount": a, "ms": ms} for t, a, ms in rows))
        world.run(jobs.ads_windows, windows=settings, at="ms")
        found = read_results(world.spark, world.w.table("window_amount"))
        return sorted((r.ending, r.tm_id, float(r.amount), r.n) for r in found.collect())

    assert run((1, 1.5, 5), (1, 2.5, 12), (2, 1, 12)) == []
    first = [(10, 1, 1.5, 1), (20, 1, 4.0, 2), (20, 2, 1.0, 1)]
    assert run((1, 1, 41)) == first
    # 8 is in the windows that end at 10, 20 (closed) and 30 (open); -5 in closed ones only.
    third = [(30, 1, 5.0, 3), (30, 2, 1.0, 1), (40, 1, 2.5, 1), (40, 2, 1.0, 1)]
    assert run((1, 1, 8), (1, 1, -15), (3, 7, 65)) == first + third
    late = read_topic_log(world.spark, world.w.topics, jobs.LATE_TOPIC).collect()
    assert [json.loads(r.value)["ms"] for r in late] == [-15]
    assert len(run((1, 1, 200))) == 7 + 6
    done = jobs.compact_tables(world.spark, world.w, most=0, windows=settings)
    assert done["ads_windows_open"] and done["ads_windows_progress"]
    assert len(run((1, 1, 400))) == 7 + 6 + 3


@pytest.mark.parametrize("step", ["finish", "publish"])
def test_windows_are_not_added_twice(spark, tmp_path, monkeypatch, step):
    world = World(spark, tmp_path)
    settings = Windows(width=20, slide=10, lag=0)

    def lost(self):
        raise RuntimeError("lost")

    world.send(jobs.WIDE_TOPIC, {"tm_id": 1, "final_detail_amount": 1, "ms": 5})
    with monkeypatch.context() as m:
        m.setattr(Commit, step, lost)
        with pytest.raises(Exception, match="lost"):
            world.run(jobs.ads_windows, windows=settings, at="ms")
    world.send(jobs.WIDE_TOPIC, {"tm_id": 1, "final_detail_amount": 1, "ms": 50})
    world.run(jobs.ads_windows, windows=settings, at="ms")
    world.run(jobs.ads_windows, windows=settings, at="ms")
    found = read_results(world.spark, world.w.table("window_amount")).collect()
    assert sorted((r.ending, float(r.amount)) for r in found) == [(10, 1.0), (20, 1.0)]


def test_a_batch_out_of_state_is_computed_once(spark, tmp_path, monkeypatch):
    """All uses of a batch read files, so that the step with state doesn't run for each."""
    world = World(spark, tmp_path)
    files, share = [], jobs.allocate_batch

    def seen(wide, sums):
        files.append(wide.inputFiles())
        return share(wide, sums)

    monkeypatch.setattr(jobs, "allocate_batch", seen)
    world.send(jobs.ORDER_TOPIC, {"id": 1, "user_id": 5, "original_total_amount": 10, "final_total_amount": 9})
    world.send(jobs.DETAIL_TOPIC, {"id": 2, "order_id": 1, "sku_id": 1, "order_price": 10, "sku_num": 1})
    world.run("dws_wide")
    assert files and all(files)
    assert not list(tmp_path.rglob("*/wide-*"))
    assert [r.order_detail_id for r in world.log(jobs.WIDE_TOPIC, schemas.ORDER_WIDE).collect()] == [2]


@pytest.mark.parametrize(("own", "most"), [(None, 12), ("2", 2)])
def test_partitions_of_state_follow_the_cores(spark, tmp_path, own, most):
    world = World(spark, tmp_path)
    world.spark.conf.set("spark.sql.shuffle.partitions", "60")
    if own:
        world.spark.conf.set("spark.tallybrook.state.partitions", own)
    world.run("dws_unmatched")
    world.send(jobs.ORDER_TOPIC, {"id": 1})
    world.run("dws_unmatched")
    states = [p for p in (tmp_path / "checkpoints/dws_unmatched/state/0").iterdir() if p.name.isdigit()]
    assert len(states) == most
    assert world.spark.conf.get("spark.sql.shuffle.partitions") == "60"


def test_rows_that_never_meet_are_told_after_a_restart(spark, tmp_path):
    """Also by a state that isn't counted: that took one more lookup for each row written."""
    world = World(spark, tmp_path)
    noon = datetime(2020, 5, 12, 12)

    def run(orders, lines, when):
        for topic, records in ((jobs.ORDER_TOPIC, orders), (jobs.DETAIL_TOPIC, lines)):
            rows = [(topic, str(r["id"]), json.dumps(r), when) for r in records]
            df = world.spark.createDataFrame(rows, "topic STRING, key STRING, value STRING, timestamp TIMESTAMP")
            send(df, world.w.topics, "test", world.sent)
            world.sent += 1
        query = jobs.dws_unmatched(world.spark, world.w, lag="1 hour")
        assert query.awaitTermination(WAIT)
        return [s for p in query.recentProgress for s in p["stateOperators"]]

    states = run([{"id": 1}, {"id": 2}], [{"id": 11, "order_id": 1}, {"id": 13, "order_id": 3}], noon)
    assert any(s["numRowsUpdated"] for s in states) and not any(s["numRowsTotal"] for s in states)
    run([{"id": 9}], [{"id": 19, "order_id": 9}], noon + timedelta(days=1))
    found = world.log(jobs.UNMATCHED_TOPIC, "order_id BIGINT, order_detail_id BIGINT, reason STRING").collect()
    assert sorted((r.order_id, r.order_detail_id, r.reason) for r in found) == [(2, None, "no lines"), (3, 13, "no order")]


def test_file_topics_are_packed_well(spark, tmp_path):
    world = World(spark, tmp_path)
    world.send(jobs.ORDER_TOPIC, {"id": 1, "user_id": 5, "original_total_amount": 10, "final_total_amount": 9})
    world.send(jobs.DETAIL_TOPIC, {"id": 2, "order_id": 1, "sku_id": 1, "order_price": 10, "sku_num": 1})
    world.run("dws_wide")
    for topic in (jobs.ORDER_TOPIC, jobs.WIDE_TOPIC):
        assert list((tmp_path / f"topics/topic={topic}").rglob("*.zstd.parquet"))
