"""Orders and lines that meet over several batches, from rows kept in a table."""

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tallybrook import schemas
from tallybrook.operators.allocation import allocate_batch, sums_after
from tallybrook.operators.wide import new_pairs
from tallybrook.plans import streams
from tallybrook.sources.manifests import Commit
from tallybrook.sources.tables import read_versions
from tallybrook.sources.topics import read_topic, send
from tallybrook.streaming import jobs
from tests.test_streaming import WAIT, World

NOON = datetime(2020, 5, 12, 12)
MESSAGE = "topic STRING, key STRING, value STRING, timestamp TIMESTAMP"


def order(i, **more):
    return {"id": i, "user_id": 5, "original_total_amount": 30, "final_total_amount": 100, **more}


def line(i, of, **more):
    return {"id": i, "order_id": of, "sku_id": 1, "order_price": 10, "sku_num": 1, **more}


def deliver(world, second, orders=(), lines=()):
    when = NOON + timedelta(seconds=second)
    for topic, records in ((jobs.ORDER_TOPIC, orders), (jobs.DETAIL_TOPIC, lines)):
        rows = [(topic, str(r["id"]), json.dumps(r), when) for r in records]
        if rows:
            send(world.spark.createDataFrame(rows, MESSAGE), world.w.topics, "test", world.sent)
            world.sent += 1


def run(world, **settings):
    query = jobs.dws_wide(world.spark, world.w, **{"reach": "100 seconds", "lag": "1000 seconds", **settings})
    assert query.awaitTermination(WAIT)
    return query


def sent(world):
    read_topic(world.spark, world.w.topics, jobs.WIDE_TOPIC)  # makes its folder
    rows = world.log(jobs.WIDE_TOPIC, schemas.ORDER_WIDE).collect()
    return sorted((r.order_id, r.order_detail_id) for r in rows)


def test_pairs_are_joined_in_columns(spark, tmp_path):
    """No state store is opened, which took a few lookups for every row that came."""
    world = World(spark, tmp_path)
    deliver(world, 0, [order(1)], [line(11, 1), line(11, 1)])
    query = run(world)
    assert not any(p["stateOperators"] for p in query.recentProgress)
    assert not (tmp_path / "checkpoints/dws_wide/state").exists()
    assert sent(world) == [(1, 11)]


def test_sides_meet_over_batches_within_reach(spark, tmp_path):
    world = World(spark, tmp_path)
    deliver(world, 0, [order(1)], [line(21, 2), line(31, 3)])
    run(world)
    assert sent(world) == []
    # The order of 21 comes late, that of 31 out of reach; 11 comes twice, 12 out of reach.
    deliver(world, 90, [order(2)], [line(11, 1), line(11, 1)])
    deliver(world, 101, [order(3)], [line(12, 1)])
    run(world)
    assert sent(world) == [(1, 11), (2, 21)]
    # Repeats of both sides; a pair that was out of reach may still come within it.
    deliver(world, 110, [order(1), order(2)], [line(11, 1), line(21, 2), line(31, 3)])
    run(world)
    assert sent(world) == [(1, 11), (1, 12), (2, 21), (3, 31)]
    run(world)
    assert len(sent(world)) == 4


def test_late_rows_are_dropped(spark, tmp_path):
    """Behind the side that is further behind, as far as batches before."""
    world = World(spark, tmp_path)
    deliver(world, 5000, [order(1)])
    run(world)
    deliver(world, 0, [order(2)], [line(21, 2)])  # lines had not come yet
    run(world)
    deliver(world, 3000, [], [line(91, 9)])
    run(world)
    deliver(world, 2000, [order(3)], [line(31, 3)])  # 1000 behind the lines
    deliver(world, 2001, [order(4)], [line(41, 4)])
    run(world)
    assert sent(world) == [(2, 21), (4, 41)]


@pytest.mark.parametrize("step", ["finish", "publish"])
def test_a_batch_tried_again_pairs_once(spark, tmp_path, monkeypatch, step):
    world = World(spark, tmp_path)

    def lost(self):
        raise RuntimeError("lost")

    deliver(world, 0, [order(1)], [line(11, 1)])
    with monkeypatch.context() as m:
        m.setattr(Commit, step, lost)
        with pytest.raises(Exception, match="lost"):
            run(world)
    assert sent(world) == []
    deliver(world, 10, [], [line(11, 1), line(12, 1)])
    run(world)
    run(world)
    assert sent(world) == [(1, 11), (1, 12)]
    rows = world.log(jobs.WIDE_TOPIC, schemas.ORDER_WIDE).collect()
    assert sum(r.final_detail_amount for r in rows) == Decimal("66.66")


def test_compaction_leaves_what_may_still_meet(spark, tmp_path):
    world = World(spark, tmp_path)
    deliver(world, 0, [order(1), order(2)], [line(11, 1)])
    run(world)
    deliver(world, 900, [order(3)], [line(31, 3), line(31, 3)])
    run(world)
    done = jobs.compact_tables(world.spark, world.w, most=0, wide_ttl_ms=800_000)
    assert done["wide_sides"] and done["wide_progress"]
    table = read_versions(world.spark, world.w.table("wide_sides"), schemas.WIDE_SIDES)
    assert sorted((r.side, r.id) for r in table.collect()) == [("lines", 31), ("orders", 3)]
    deliver(world, 950, [order(3)], [line(31, 3), line(32, 3), line(21, 2)])
    run(world)
    assert sent(world) == [(1, 11), (3, 31), (3, 32)]


def test_pairs_of_equal_and_null_ids(spark):
    orders = spark.createDataFrame(
        [(1, NOON, True), (1, NOON, False), (2, NOON, False), (None, NOON, False)],
        "id BIGINT, arrived TIMESTAMP, known BOOLEAN",
    )
    late = NOON + timedelta(seconds=2)
    lines = spark.createDataFrame(
        [(11, 1, NOON, True), (12, 1, NOON, False), (12, 1, NOON, True), (13, 1, late, False),
         (None, 2, NOON, False), (None, 2, NOON, False), (14, None, NOON, False)],
        "id BIGINT, order_id BIGINT, arrived TIMESTAMP, known BOOLEAN",
    )
    got = new_pairs(orders, lines, "1 second")
    assert got.columns == ["order_id", "order_at", "order_detail_id"]
    assert [(r.order_id, r.order_detail_id) for r in got.collect()] == [(2, None)]


def test_shares_are_computed_once(spark, tmp_path, monkeypatch):
    """Messages and sums come from stored shares; both ran the windows over all lines before."""
    world = World(spark, tmp_path)
    files, sums = [], jobs.sums_after

    def seen(shared, *more):
        files.extend(shared.inputFiles())
        return sums(shared, *more)

    monkeypatch.setattr(jobs, "sums_after", seen)
    deliver(world, 0, [order(1)], [line(11, 1)])
    run(world)
    assert files and all("/shares-" in f for f in files)
    assert sent(world) == [(1, 11)]


def test_sums_of_shared_rows(spark):
    wide = spark.createDataFrame(
        [
            (1, 11, Decimal(10), 1, Decimal(30), Decimal(100)),
            (1, 12, None, 1, Decimal(30), Decimal(100)),
            (2, 21, Decimal(10), 1, Decimal(0), Decimal(5)),
        ],
        "order_id BIGINT, order_detail_id BIGINT, sku_price DECIMAL(18,2), sku_num BIGINT, "
        "original_total_amount DECIMAL(18,2), final_total_amount DECIMAL(18,2)",
    )
    before = spark.createDataFrame([(1, 1, 1000, 3333)], "order_id BIGINT, lines BIGINT, cents BIGINT, given BIGINT")
    shared, left = allocate_batch(wide, before)
    again = sums_after(shared, before)
    want = [(1, 3, 2000, 6666), (2, 1, 1000, 0)]
    assert sorted(tuple(r) for r in left.collect()) == sorted(tuple(r) for r in again.collect()) == want


@pytest.mark.parametrize("name", ["order_wide_stream", "order_amount_stream"])
def test_lines_of_a_query_are_numbered_once(spark, tmp_path, monkeypatch, name):
    """Totals and each delivery of lines priced and numbered all lines anew."""
    tables = {
        "part": "SELECT 1L AS p_partkey, 'a' AS p_name, 10.0D AS p_retailprice",
        "orders": "SELECT 7L AS o_orderkey, 5L AS o_custkey, 'O' AS o_orderstatus, 100.0D AS o_totalprice, "
        "TIMESTAMP_NTZ '2020-05-12 10:00:00' AS o_orderdate",
        "lineitem": "SELECT 7L AS l_orderkey, CAST(id AS INT) AS l_linenumber, 1L AS l_partkey, 1L AS l_suppkey, "
        "1.0D AS l_quantity, 10.0D AS l_extendedprice FROM range(1, 4)",
    }
    for table, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{table}.parquet")
    read, plain = [], streams.send

    def seen(rows, *more):
        read.append(rows.inputFiles())
        plain(rows, *more)

    monkeypatch.setattr(streams, "send", seen)
    got = sorted(tuple(r) for r in streams.STREAM_QUERIES[name](spark, str(tmp_path)).collect())
    assert len(read) >= 2 and not any("lineitem.parquet" in f for files in read for f in files)
    ids = [7 * streams.MOST_LINES + i for i in (1, 2, 3)]
    # Lines whose number is divisible by 3 come first.
    shifted = [(7, ids[0], 33.33), (7, ids[1], 33.34), (7, ids[2], 33.33)]
    assert got == ([(7, 3, 100.0)] if name == "order_wide_stream" else shifted)
