import pytest
from pyspark.sql import functions as F

from tallybrook.sources.relations import jdbc_options, read_query
from tallybrook.sources.results import read_results, swap_statements, write_result, write_result_jdbc
from tallybrook.sources.tables import compact, read_latest, read_versions, upsert
from tallybrook.sources.topics import TopicStore, kafka_read_options, read_topic_log, send

SCHEMA = "id BIGINT, name STRING"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_upsert_keeps_the_latest_batch(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert read_latest(spark, path, SCHEMA, ["id"]).count() == 0
    upsert(_rows(spark, (1, "a"), (2, "b")), path, 0)
    upsert(_rows(spark, (2, "c"), (3, "d")), path, 1)
    # A second try at batch 1 leaves out a row its first try had.
    upsert(_rows(spark, (2, "c2")), path, 1)
    got = sorted(tuple(r) for r in read_latest(spark, path, SCHEMA, ["id"]).collect())
    assert got == [(1, "a"), (2, "c2")]
    before = read_latest(spark, path, SCHEMA, ["id"], before_batch=1)
    assert sorted(r.name for r in before.collect()) == ["a", "b"]
    assert read_versions(spark, path, SCHEMA).count() == 3
    compact(spark, path, path + "2", SCHEMA, ["id"])
    assert read_versions(spark, path + "2", SCHEMA).count() == 2
    again = sorted(tuple(r) for r in read_latest(spark, path + "2", SCHEMA, ["id"]).collect())
    assert again == got


def test_upsert_by_position_and_by_day(spark, tmp_path):
    path = str(tmp_path / "tm")
    rows = spark.createDataFrame([(4, "t", "2020-01-01")], "tm_id BIGINT, tm_name STRING, dt STRING")
    upsert(rows, path, 0, partition_by=["dt"], columns=["id", "name", "dt"])
    upsert(rows, path, 1, partition_by=["dt"], columns=["id", "name", "dt"])
    got = read_latest(spark, path, SCHEMA + ", dt STRING", ["dt", "id"])
    assert [tuple(r) for r in got.collect()] == [(4, "t", "2020-01-01")]
    plan = got.where("dt = '2020-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_result_replayed_once(spark, tmp_path):
    path = str(tmp_path / "result")
    rows = _rows(spark, (1, "a"), (2, "b"))
    for batch in (0, 1, 1):
        write_result(rows, path, "q", batch)
    write_result(rows, path, "other", 1)
    got = read_results(spark, path)
    assert got.count() == 6
    assert got.where("query_id = 'q' AND batch_id = 1").count() == 2


class FakeConnection:
    def __init__(self, fail=False):
        self.log, self.fail = [], fail

    def setAutoCommit(self, on):
        self.log.append(("auto", on))

    def prepareStatement(self, sql):
        self.log.append(sql)
        return self

    def setString(self, i, v):
        self.log.append((i, v))

    setLong = setString

    def executeUpdate(self):
        if self.fail:
            raise RuntimeError("lost")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


@pytest.mark.parametrize("fail", [False, True])
def test_database_result_is_one_transaction(spark, monkeypatch, fail):
    staged = []
    writer = type(_rows(spark, (1, "a")).write)
    monkeypatch.setattr(
        writer, "jdbc", lambda self, url, table, properties: staged.append((url, table))
    )
    con = FakeConnection(fail)
    args = (_rows(spark, (1, "a")), "q", 3, "jdbc:x", "sums")

    def run():
        write_result_jdbc(*args, connect=lambda *_: con)

    if fail:
        with pytest.raises(RuntimeError):
            run()
        assert con.log[-2:] == ["rollback", "close"] and "commit" not in con.log
    else:
        run()
        delete, insert = swap_statements("sums", "sums_staging_q", ["id", "name"])
        assert con.log == [
            ("auto", False), delete, (1, "q"), (2, 3), insert, "commit", "close",
        ]
    assert staged == [("jdbc:x", "sums_staging_q")]


def test_topic_rows_go_to_their_topics_once(spark, tmp_path):
    store = TopicStore(location=str(tmp_path / "topics"))
    rows = spark.createDataFrame(
        [("A", "1", "x"), ("B", "2", "y"), ("A", None, "z")],
        "topic STRING, key STRING, value STRING",
    )
    send(rows, store, "w", 0)
    send(rows, store, "w", 0)
    send(rows.where("topic = 'B'"), store, "w", 1)
    assert sorted(r.value for r in read_topic_log(spark, store, "A").collect()) == ["x", "z"]
    every = read_topic_log(spark, store).groupBy("topic").count().collect()
    assert {r.topic: r["count"] for r in every} == {"A": 2, "B": 2}


def test_kafka_options():
    store = TopicStore("kafka", options={"kafka.bootstrap.servers": "h:1"})
    assert kafka_read_options(store, "T", "latest", 10) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "T",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
    }
    with pytest.raises(ValueError):
        TopicStore("other")


def test_jdbc_options():
    opts = jdbc_options("u", query="select 1", split_by="id", bounds=(0, 9), partitions=3)
    assert opts["dbtable"] == "(select 1) q" and opts["numPartitions"] == "3"
    assert "partitionColumn" not in jdbc_options("u", table="t")
    for bad in ({}, {"table": "t", "query": "q"}, {"table": "t", "split_by": "id"}):
        with pytest.raises(ValueError):
            jdbc_options("u", **bad)


def test_relation_columns_are_lower_case(spark):
    _rows(spark, (1, "a")).select(F.col("id").alias("ID"), "name").createOrReplaceTempView("rel_t")
    assert read_query(spark, "SELECT ID, name AS NAME FROM rel_t").columns == ["id", "name"]
