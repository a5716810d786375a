"""Upsert tables in parts, compaction beside readers, and commits of several outputs."""

import pytest
from pyspark.sql import functions as F

from tallybrook.sources import manifests
from tallybrook.sources.results import read_results, write_result
from tallybrook.sources.tables import (
    bucket_of,
    compact_parts,
    exists,
    read_for_keys,
    read_latest,
    read_versions,
    remove_unused,
    state,
    upsert,
)

SCHEMA = "id BIGINT, name STRING"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def latest(spark, path):
    return sorted(tuple(r) for r in read_latest(spark, path, SCHEMA, ["id"]).collect())


def fill(spark, path, batches=4, ids=200, **how):
    for b in range(batches):
        made = spark.range(ids).select("id", F.lit(f"v{b}").alias("name"))
        upsert(made, path, b, keys=["id"], buckets=8, **how)


def test_only_the_buckets_of_a_batch_are_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    fill(spark, path)
    facts = spark.createDataFrame([(7, "x"), (None, "y"), (7, "z")], "user INT, v STRING")
    got = read_for_keys(path, SCHEMA, "id", facts, "user")
    (bucket,) = [r[0] for r in spark.range(7, 8).select(bucket_of(["id"], 8)).collect()]
    files = got.inputFiles()
    assert {f.split("bucket=")[1].split("/")[0] for f in files if "bucket=" in f} == {str(bucket)}
    assert len(files) <= 2 * 4
    assert [tuple(r) for r in got.collect()] == [(7, "v3")]
    assert len(read_versions(spark, path, SCHEMA).inputFiles()) >= 8 * 4
    nothing = read_for_keys(path, SCHEMA, "id", facts.where("user IS NULL"), "user")
    assert nothing.count() == 0 and nothing.inputFiles() == []


def test_folders_without_the_keys_are_skipped(spark, tmp_path):
    path = str(tmp_path / "t")
    for b in range(5):
        made = spark.range(100 * b, 100 * b + 100).select("id", F.lit("n").alias("name"))
        upsert(made, path, b, keys=["id"], buckets=2)
    facts = spark.range(205, 207).toDF("k")
    files = read_for_keys(path, SCHEMA, "id", facts, "k").inputFiles()
    assert {f.split("batch_id=")[1].split("/")[0] for f in files} == {"2"}
    before = read_for_keys(path, SCHEMA, "id", facts, "k", before_batch=2)
    assert before.count() == 0


def test_bucket_does_not_depend_on_the_width_of_ids(spark):
    row = spark.range(5).withColumn("i", F.col("id").cast("int"))
    assert row.where(bucket_of(["id"], 64) != bucket_of(["i"], 64)).count() == 0


@pytest.mark.parametrize("how", [{"buckets": 8, "keys": ["id"]}, {"partition_by": ["dt"]}])
def test_compaction_beside_readers_and_writers(spark, tmp_path, how):
    path, schema = str(tmp_path / "t"), SCHEMA + ", dt STRING"
    keys = ["id"] if "keys" in how else ["dt", "id"]

    def write(b):
        made = spark.range(b, 60).select("id", F.lit(f"v{b}").alias("name"), F.concat(F.lit("2020-01-0"), F.col("id") % 3 + 1).alias("dt"))
        upsert(made, path, b, **how)

    def all_latest():
        return sorted(tuple(r) for r in read_latest(spark, path, schema, keys).collect())

    for b in range(4):
        write(b)
    want = all_latest()
    reader = read_latest(spark, path, schema, keys)
    assert compact_parts(spark, path, schema, keys, most=4) == []
    assert len(compact_parts(spark, path, schema, keys, most=3)) == (8 if "keys" in how else 3)
    # Who began before goes on with the old files; who begins now opens one file a part.
    assert sorted(tuple(r) for r in reader.collect()) == want == all_latest()
    assert read_versions(spark, path, schema).count() == len(want)
    with pytest.raises(ValueError):
        read_versions(spark, path, schema, before_batch=2)
    write(3)  # tried again after it was taken in
    assert read_versions(spark, path, schema).count() == len(want)
    write(4)
    assert sum(r[1] == "v4" for r in all_latest()) == 56
    assert remove_unused(spark, path, older_than_ms=3_600_000) == 0
    assert remove_unused(spark, path, older_than_ms=0) == 4
    assert sum(r[1] == "v4" for r in all_latest()) == 56
    assert len(all_latest()) == len(want)


def test_single_parts_are_compacted(spark, tmp_path):
    path = str(tmp_path / "t")
    fill(spark, path, batches=1)
    for b in range(1, 4):
        upsert(rows(spark, (7, f"w{b}")), path, b, keys=["id"])
    want = latest(spark, path)
    assert len(compact_parts(spark, path, SCHEMA, ["id"], most=3)) == 1
    assert latest(spark, path) == want and (7, "w3") in want
    # The first folder is now read without the part that was rewritten.
    assert [f.whole for f in state(spark, path).folders] == [False, True]
    assert compact_parts(spark, path, SCHEMA, ["id"], most=0, keep=F.col("id") < 5)
    assert [r[0] for r in latest(spark, path)] == [0, 1, 2, 3, 4]


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    fill(spark, path, batches=2)
    seen = state(spark, path)
    compact_parts(spark, path, SCHEMA, ["id"], most=1)
    monkeypatch.setattr("tallybrook.sources.tables.state", lambda *_: seen)
    with pytest.raises(RuntimeError, match="somebody else"):
        compact_parts(spark, path, SCHEMA, ["id"], most=1)


def test_keys_of_a_table_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    fill(spark, path, batches=1)
    with pytest.raises(ValueError, match="has the keys"):
        upsert(rows(spark, (1, "a")), path, 1, keys=["name"])


def test_empty_batches_and_text_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(rows(spark), path, 0, keys=["name"], buckets=4)
    assert latest(spark, path) == []
    upsert(rows(spark, (1, "é"), (2, "z"), (3, None)), path, 1, keys=["name"])
    facts = spark.createDataFrame([("é",)], "n STRING")
    got = read_for_keys(path, SCHEMA, "name", facts, "n")
    assert [tuple(r) for r in got.collect()] == [(1, "é")]


def test_a_commit_shows_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    commit = manifests.Commit(spark, str(tmp_path / "commits" / "1.json"))
    messages = spark.createDataFrame([("A", "x"), ("B", "y")], "topic STRING, value STRING")
    target = str(tmp_path / "topics")
    commit.stage(messages, ["topic"], target, "writer=w/batch_id=1")
    upsert(rows(spark, (1, "a")), path, 1, keys=["id"], commit=commit.path)
    write_result(rows(spark, (5, "r")), f"{path}r", "q", 1, commit=commit.path)
    assert not commit.done and not exists(spark, path)
    with pytest.raises(ValueError, match="no results"):
        read_results(spark, f"{path}r")
    assert manifests.listed(spark, f"{target}/topic=*") == []
    # A second attempt at the batch leaves the first one's files unseen.
    upsert(rows(spark, (1, "b")), path, 1, keys=["id"], commit=commit.path)
    commit.finish()
    assert commit.done and latest(spark, path) == [(1, "b")]
    assert read_results(spark, f"{path}r").count() == 1
    assert spark.read.parquet(target).count() == 2
    commit.publish()
    assert spark.read.parquet(target).count() == 2


def test_lost_commits_are_passed_by_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    fill(spark, path, batches=2)
    upsert(rows(spark, (1, "lost")), path, 2, keys=["id"], commit=str(tmp_path / "never.json"))
    upsert(rows(spark, (2, "kept")), path, 3, keys=["id"])
    compact_parts(spark, path, SCHEMA, ["id"], most=1)
    got = dict(latest(spark, path))
    assert got[1] == "v1" and got[2] == "kept"


def test_a_reader_between_two_tries_sees_one_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    write_result(rows(spark, (1, "a"), (2, "a")), path, "q/1", 0)

    def lost(*_args, **_how):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(manifests, "put", lost)
        with pytest.raises(RuntimeError):
            write_result(rows(spark, (1, "b")), path, "q/1", 0)
    assert sorted(r.name for r in read_results(spark, path).collect()) == ["a", "a"]
    write_result(rows(spark, (1, "b")), path, "q/1", 0)
    got = read_results(spark, path).collect()
    assert [(r.name, r.query_id, r.batch_id) for r in got] == [("b", "q/1", 0)]


def test_manifests_appear_once(spark, tmp_path):
    path = str(tmp_path / "m" / "a.json")
    assert manifests.put(spark, path, {"x": 1})
    assert not manifests.put(spark, path, {"x": 2})
    assert manifests.newest(spark, path) == {"x": 1}
    assert manifests.put(spark, path, {"x": 33}, replace=True)
    assert manifests.newest(spark, path) == {"x": 33}
    assert len(manifests.listed(spark, f"{tmp_path}/m/*")) == 1
